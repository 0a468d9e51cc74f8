"""The queries of these operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    ball_tree,
    decontaminate,
    exact_dedup,
    interpolated_lm,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    sharding,
    token_alignment,
    token_counts,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
)
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its group of equal texts; the largest doc_id of a group stays."""
    marked = exact_dedup.mark_duplicates(documents(spark, folder))
    return marked.withColumnRenamed("digest", "text_sha256")


@query()
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 40 shards, and its shard once there are 41."""
    return sharding.assign_shards(documents(spark, folder), sharding.ShardTree.even(4, 2, 5))


@query(
    """
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents),
    keyed AS (
        SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    gone AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
    flagged AS (SELECT k.*, g.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN gone g ON k.key = g.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM flagged GROUP BY doc_id
    """
)
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines found in ten documents or more."""
    kept = line_dedup.drop_repeated_lines(documents(spark, folder), least_docs=10, least_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its licence phrases and notices."""
    return license_scan.scan_licenses(documents(spark, folder))


@query()
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its hit words and the benchmark items whose windows occur in it."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.judged(decontaminate.find_contamination(documents(spark, folder), items))
    listed = F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document in a sequence of at most 2048 ids."""
    return packing.pack(documents(spark, folder))


@query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from four folds of five."""
    return language_id.identify(documents(spark, folder))


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learned from four folds of five."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.score_documents(documents(spark, folder), labels).drop("segments")


@query()
def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the smallest doc_id it reaches by links of similar shingle sets."""
    return ngram_join.similar_groups(documents(spark, folder))


@query()
def op5_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log-probability, learned from nine folds of ten."""
    return interpolated_lm.score_documents(documents(spark, folder))


@query()
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's bytes and tokens, and whether it has more than 512."""
    return token_counts.count_tokens(documents(spark, folder))


@query()
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's groups and links between two tokenizers, and how its links stand in the corpus."""
    return token_alignment.align(documents(spark, folder))


@query(
    """
    WITH terms AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
    wanted AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
    lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
    corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
    times AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM times, corpus GROUP BY term, n_docs),
    parts AS (
        SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS part
        FROM times JOIN weights USING (term) JOIN lengths USING (doc_id), corpus),
    scores AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM wanted JOIN parts USING (term) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """
)
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ball_tree.search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
