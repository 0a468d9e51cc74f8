"""Exact duplicates by a persistent digest index.

The index holds one row for each text ever seen, in a Parquet table bucketed and sorted by digest. A
batch is digested, reduced to one row a digest where it lies (partial aggregation, so a text that
fills a third of all rows is a few rows when shuffled) and merge-anti-joined with the index on its
buckets; what remains is appended. The copies of known texts are added up in a second table of the
same buckets. A table enters in batches of falling doc_id, so that the row met first, which the
anti-join protects, is the one with the largest doc_id.

Defined cases: a null text is the empty text; texts are compared unchanged, whatever their length; of
equal texts the largest doc_id stays, a null doc_id only if no copy has another; rows that repeat both
doc_id and text are one document: they are marked alike, and ``without_duplicates`` keeps one of them;
columns of any name are kept and do not clash; an empty table gives an empty result and index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import stored
from shelfwise.scratch import scratch_path, written

COLUMNS, COPIES = "digest STRING, keep_id BIGINT, first_size BIGINT", "digest STRING, copies BIGINT"
# A digest held by over a thousandth of the rows is looked up apart; there are under a thousand.
HOT_PART = 1000


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``digest`` of every row."""
    return docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest")
    )


class DigestIndex:
    """The tables of known texts and of their later copies under ``path``, new or from earlier sessions."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "digests")
        self.buckets = stored.settled_buckets(spark, self.path, buckets)
        self.name = stored.attach(spark, f"{self.path}/texts", COLUMNS, "digest", self.buckets)
        self.copies = stored.attach(spark, f"{self.path}/copies", COPIES, "digest", self.buckets)

    def rows(self) -> DataFrame:
        """``digest``, the document met first and the size of the group so far."""
        more = self.spark.table(self.copies).groupBy("digest").agg(F.sum("copies").alias("copies"))
        size = (F.col("first_size") + F.coalesce("copies", F.lit(0))).alias("group_size")
        return self.spark.table(self.name).join(more, "digest", "left").select("digest", "keep_id", size)

    def add(self, batch: DataFrame) -> DataFrame:
        """Append what ``batch`` (``doc_id``, ``digest``) holds of unknown texts; gives those rows."""
        counts = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        groups, known = written(counts, "digest-groups"), self.spark.table(self.name).select("digest")
        fresh = written(groups.join(known, "digest", "left_anti"), "fresh-digests")
        again = groups.join(known, "digest", "left_semi").select("digest", F.col("group_size").alias("copies"))
        stored.append(again, self.copies, "digest", self.buckets)
        stored.append(fresh.withColumnRenamed("group_size", "first_size"), self.name, "digest", self.buckets)
        return fresh

    def add_falling(self, rows: DataFrame, batches: int = 2) -> None:
        """Add written ``rows`` in batches of falling doc_id; nulls come last. Cuts only set the batches' sizes."""
        shares = [1 - (n + 1) / batches for n in range(batches - 1)]
        found = rows.agg(F.percentile_approx("doc_id", shares or [0.5])).first()[0] if shares else None
        above = F.lit(False)
        for cut in sorted(set(found or []), reverse=True):
            here = F.coalesce(F.col("doc_id") >= cut, F.lit(False))
            self.add(rows.filter(here & ~above))
            above = here
        self.add(rows.filter(~above))


def with_groups(batch: DataFrame, index: DataFrame) -> DataFrame:
    """``batch`` with the index row of its digest.

    Rows of the few hot digests are answered by a broadcast of at most ``HOT_PART`` rows and then
    carry a key of their own, so the shuffled join deals them out evenly.
    """
    total = batch.count()
    found = [F.col("digest").alias("probe"), F.col("keep_id"), F.col("group_size")]
    hot = index.filter(F.col("group_size") * HOT_PART > F.lit(total)).select(
        F.col("digest"), F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size")
    )
    return (
        batch.join(F.broadcast(hot), "digest", "left")
        .withColumn(
            "probe",
            F.when(F.col("hot_size").isNull(), F.col("digest")).otherwise(
                F.concat(F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
            ),
        )
        .join(index.select(*found), "probe", "left")
        .select(
            "doc_id",
            "digest",
            F.when(F.col("hot_size").isNull(), F.col("keep_id")).otherwise(F.col("hot_id")).alias("keep_id"),
            F.coalesce("hot_size", "group_size").alias("group_size"),
        )
    )


def mark_duplicates(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row for each document: its group, the document that stays, and whether it is that one.

    With a new index (the default) groups are those of ``docs``; with one that holds earlier
    batches, a text known from them keeps its earlier document and its copies are added up.
    """
    spark = docs.sparkSession
    batch = written(digests(docs), "digests")
    index = index or DigestIndex(spark)
    index.add_falling(batch)
    groups = written(index.rows(), "digest-groups")
    return with_groups(batch, groups).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one a text, with all their columns."""
    index = DigestIndex(docs.sparkSession)
    index.add_falling(written(digests(docs), "digests"))
    name = "document_key"
    while name in docs.columns:
        name += "_"
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    keyed = docs.withColumn(name, F.concat_ws(":", digest, F.col("doc_id").cast("bigint").cast("string")))
    keep = docs.sparkSession.table(index.name).select(F.concat_ws(":", "digest", F.col("keep_id").cast("string")).alias(name))
    return keyed.join(keep, name, "left_semi").dropDuplicates([name]).select(*docs.columns)
