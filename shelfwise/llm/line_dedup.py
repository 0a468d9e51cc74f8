"""Lines repeated across documents, counted in levelled sorted runs.

A run is a table of (line key digest, documents), bucketed and sorted by digest. A batch reduces
its lines to one row a digest, merge-anti-joins the runs to learn which digests are new, and adds
itself as a run of level 0. When a level holds ``fanout`` runs they are merged (counts added) into
one run of the next level. Every run is written to a folder of its own; a manifest row commits each
change and the newest version counts, so what a lost driver left half done is never read. The bucket
count is kept with the runs.

Defined cases: a null or empty text is one empty line; keys shorter than ``least_chars`` never
count; each row counts as a document of its own; a text whose lines all go becomes empty; an empty
table gives an empty result.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import stored
from shelfwise.scratch import scratch_path, written

RUN = "line_key STRING, docs BIGINT, fresh BOOLEAN"
SPACES = " \t\n\x0b\x0c\r"
# A key with over a thousandth of all (document, key) pairs is looked up apart; under a thousand are.
HOT_PART = 1000


def line_keys(text: Column, least_chars: int) -> Column:
    """A digest for each line, null for lines whose key is too short to count."""
    folded = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)

    def digest(line: Column) -> Column:
        key = F.btrim(line, F.lit(SPACES))
        return F.when(F.char_length(key) >= least_chars, F.md5(key))

    return F.transform(F.split(folded, "\n"), digest)


def key_counts(docs: DataFrame, least_chars: int = 1, text: str = "text") -> DataFrame:
    """``line_key`` and in how many rows of ``docs`` it is found."""
    each = F.explode(F.array_compact(F.array_distinct(line_keys(F.col(text), least_chars))))
    return docs.select(each.alias("line_key")).groupBy("line_key").agg(F.count("*").alias("docs"))


class LineRuns:
    """The levelled runs under ``path``, new or kept from earlier sessions."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, fanout: int = 4):
        self.spark = spark
        self.path = path or scratch_path(spark, "line-runs")
        self.buckets = stored.settled_buckets(spark, self.path, buckets)
        self.fanout = fanout
        self._log = f"{self.path}/manifest"
        rows = stored.small_rows(spark, self._log, "version INT, level INT, run STRING")
        self.version = max((r["version"] for r in rows), default=0)
        held = [(r["level"], r["run"]) for r in rows if r["version"] == self.version]
        self.levels: list[tuple[int, str]] = sorted(held)

    def _commit(self, levels: list[tuple[int, str]]) -> None:
        self.version += 1
        held = [F.struct(F.lit(n).alias("level"), F.lit(r).alias("run")) for n, r in levels]
        rows = self.spark.range(1, numPartitions=1).select(F.lit(self.version).alias("version"), F.inline(F.array(*held)))
        rows.write.mode("append").parquet(self._log)
        self.levels = levels

    def _run(self, path: str) -> DataFrame:
        return self.spark.table(stored.attach(self.spark, path, RUN, "line_key", self.buckets))

    def _store(self, rows: DataFrame, level: int) -> tuple[int, str]:
        path = f"{self.path}/level-{level}-{uuid.uuid4().hex}"
        name = stored.attach(self.spark, path, RUN, "line_key", self.buckets)
        stored.append(rows.select("line_key", "docs", "fresh"), name, "line_key", self.buckets)
        return level, path

    def _merged(self, runs: list[str]) -> DataFrame:
        """The runs' counts added up by merge joins of their sorted buckets."""
        found = self._run(runs[0])
        for run in runs[1:]:
            more = self._run(run).select("line_key", F.col("docs").alias("more_docs"), F.col("fresh").alias("more_fresh"))
            found = found.join(more, "line_key", "full").select(
                "line_key",
                (F.coalesce("docs", F.lit(0)) + F.coalesce("more_docs", F.lit(0))).alias("docs"),
                (F.coalesce("fresh", F.lit(False)) | F.coalesce("more_fresh", F.lit(False))).alias("fresh"),
            )
        return found

    def add(self, counts: DataFrame) -> None:
        """Merge-anti-join a batch's counts against the runs, add it as a run, compact full levels."""
        fresh = counts.select("line_key")
        for _, run in self.levels:
            fresh = fresh.join(self._run(run).filter("fresh").select("line_key"), "line_key", "left_anti")
        known = counts.join(fresh.withColumn("new", F.lit(True)), "line_key", "left")
        known = known.withColumn("fresh", F.coalesce("new", F.lit(False)))
        self._commit([*self.levels, self._store(known, 0)])
        level = 0
        while len(full := [r for n, r in self.levels if n == level]) >= self.fanout:
            merged = self._store(self._merged(full), level + 1)
            self._commit([x for x in self.levels if x[0] != level] + [merged])
            level += 1

    def totals(self) -> DataFrame:
        """``line_key`` and ``docs`` over all batches."""
        if not self.levels:
            return self.spark.range(0).select(F.lit("").alias("line_key"), F.lit(0).cast("bigint").alias("docs"))
        return self._merged([r for _, r in self.levels]).drop("fresh")


def drop_lines(docs: DataFrame, totals: DataFrame, least_docs: int, least_chars: int = 1) -> DataFrame:
    """``docs`` (doc_id, text) with ``n_lines``, ``n_dropped`` and ``kept_text``.

    Lines meet the repeated keys in one shuffled join by key; the few hot keys are answered by a
    broadcast and their lines carry a key of their own there. A document's flags then meet its text
    by doc_id and text hash; documents that lose nothing carry no flags.
    """
    repeated = written(totals.filter(F.col("docs") >= least_docs), "repeated-lines")
    pairs = totals.agg(F.sum("docs")).first()[0] or 0
    hot = repeated.filter(F.col("docs") * HOT_PART > F.lit(pairs)).select("line_key", F.lit(True).alias("hot"))
    cold = repeated.filter(F.col("docs") * HOT_PART <= F.lit(pairs))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(text).alias("text_key"), "text")
    lines = keyed.select("doc_id", "text_key", F.posexplode(line_keys(F.col("text"), least_chars)).alias("pos", "line_key"))
    found = (
        lines.join(F.broadcast(hot), "line_key", "left")
        .withColumn(
            "probe",
            F.when(F.col("hot") | F.col("line_key").isNull(), F.concat_ws(":", F.lit(""), "text_key", "pos")).otherwise(
                F.col("line_key")
            ),
        )
        .join(cold.select(F.col("line_key").alias("probe"), F.lit(True).alias("cold")), "probe", "left")
        .select("doc_id", "text_key", "pos", F.coalesce("hot", "cold", F.lit(False)).alias("gone"))
    )
    flags = (
        found.groupBy("doc_id", "text_key")
        .agg(F.max("gone").alias("any"), F.sort_array(F.collect_set(F.struct("pos", "gone"))).alias("flags"))
        .filter("any")
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("flags.gone").alias("flags"))
    )
    joined = keyed.join(flags, keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["text_key"] == F.col("_key")), "left")
    split = F.split(text, "\n")
    kept = F.filter(split, lambda _, i: ~F.element_at(F.col("flags"), i + 1))
    return joined.select(
        "doc_id",
        F.size(split).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(F.filter("flags", lambda gone: gone)), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("flags").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def drop_repeated_lines(
    docs: DataFrame, least_docs: int = 10, least_chars: int = 1, batches: int = 4, runs: LineRuns | None = None
) -> DataFrame:
    """Every document without the lines found in at least ``least_docs`` documents.

    The documents' counts are taken in one pass and enter the runs in ``batches`` batches by a hash
    of the document; as many as the runs' ``fanout`` or more are compacted on the way.
    """
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    each = F.explode(F.array_compact(F.array_distinct(line_keys(F.col("text"), least_chars))))
    counts = written(
        docs.select(batch.alias("batch"), each.alias("line_key")).groupBy("batch", "line_key").agg(F.count("*").alias("docs")),
        "line-counts",
    )
    runs = runs or LineRuns(docs.sparkSession)
    for n in range(batches):
        runs.add(counts.filter(F.col("batch") == n).drop("batch"))
    return drop_lines(docs, written(runs.totals(), "line-totals"), least_docs, least_chars)
