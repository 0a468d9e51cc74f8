"""Ready-made queries over the provided tables, each with the SQL it must agree with.

Every query reads its whole tables. ``documents`` and ``part`` stand for item records: see
``products`` and ``parts``. Where no SQL is given the result comes from an iterative fit.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.arrays import argmax, element, head
from shelfwise.functions.keys import digest
from shelfwise.functions.labels import label_code, label_key, label_name
from shelfwise.functions.text import combine_flat, combine_listed, combine_spaced, tokens, word_count
from shelfwise.operators import metrics
from shelfwise.operators.classify import fit_text_classifier, load_model, loss_of_row, save_model, with_code
from shelfwise.operators.encode import encode, unknown_share
from shelfwise.operators.features import fit_projection, fit_scale, id_features
from shelfwise.operators.numbering import batches, shuffled_numbers
from shelfwise.operators.pretrained import encode_pretrained
from shelfwise.operators.profile import (
    box_statistics,
    collected,
    collected_in_order,
    distinct_count,
    examples,
    group_count,
    row_count,
    top_groups,
    truncation,
)
from shelfwise.operators.project import keep_columns, text_and_label, with_label, with_text, without
from shelfwise.operators.sampling import sample_exact, sample_share, shuffled, with_exact_split, with_split
from shelfwise.operators.sketches import merged_sketches, quartiles, rank_error, value_sketches
from shelfwise.operators.validate import REASON, with_domain_check, with_reason
from shelfwise.operators.vocabulary import (
    piece_vocabulary,
    ranked,
    token_counts,
    word_vocabulary,
)
from shelfwise.operators.wide import fit_wide_projection
from shelfwise.plans.baseline import HINGE, MARGIN, linear_baseline
from shelfwise.plans.epochs import train_by_epochs
from shelfwise.plans.etl import run_etl
from shelfwise.plans.explore import explore
from shelfwise.plans.predict import answer, predict, request_text
from shelfwise.plans.preprocess import preprocess
from shelfwise.plans.train import train_and_evaluate
from shelfwise.schema import KEY, LABEL, PRODUCT, REQUEST, TEXT
from shelfwise.scratch import scratch_path, written
from shelfwise.sources.json_lines import MALFORMED, json_fields, read_json_lines, write_json_lines
from shelfwise.sources.tables import read_table, write_table
from shelfwise.streaming.scoring import request_stream, start_answering, start_scoring, start_writing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Label domain of the documents used as records.
LANGUAGES = ["de", "en", "es", "fr"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


# --- the provided tables as records -------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", spread=spread)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for work on their texts, which costs much per row."""
    return table(spark, folder, "documents", spread=True)


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as records: the lines of a text are its description, the language is the label."""
    none = F.array().cast("array<string>")
    chars = F.col("n_chars").cast("string")
    return documents(spark, folder).select(
        F.col("doc_id").cast("string").alias("asin"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.col("source").alias("brand"),
        F.split("text", "\n").alias("description"),
        F.array(F.concat(F.lit("length "), chars), F.col("source")).alias("feature"),
        F.array("lang", "source").alias("category"),
        none.alias("also_buy"),
        none.alias("also_view"),
        none.alias("image"),
        chars.alias("price"),
        F.col("lang").alias(LABEL),
    )


PRODUCTS_SQL = """
products AS (
  SELECT CAST(doc_id AS VARCHAR) AS asin, source || ' ' || lang AS title, source AS brand,
         string_split(text, chr(10)) AS description,
         ['length ' || CAST(n_chars AS VARCHAR), source] AS feature,
         [lang, source] AS category, CAST(n_chars AS VARCHAR) AS price, lang AS main_cat
  FROM documents)"""

FLAT_SQL = "concat_ws(' | ', asin, title, array_to_string(description, ' | '), array_to_string(feature, ' | '), brand)"


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as records: the words of a name are its description, the type is the label."""
    none = F.array().cast("array<string>")
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("asin"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.split("p_name", " ").alias("description"),
        F.array(F.concat(F.lit("size "), F.col("p_size").cast("string"))).alias("feature"),
        F.array("p_type").alias("category"),
        none.alias("also_buy"),
        none.alias("also_view"),
        none.alias("image"),
        F.col("p_size").cast("string").alias("price"),
        F.col("p_type").alias(LABEL),
    )


PARTS_SQL = """
parts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS asin, p_name AS title, p_brand AS brand,
         string_split(p_name, ' ') AS description, ['size ' || CAST(p_size AS VARCHAR)] AS feature,
         [p_type] AS category, CAST(p_size AS VARCHAR) AS price, p_type AS main_cat
  FROM part)"""


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as preprocessed rows: key, text and label."""
    return documents(spark, folder).select(
        "doc_id", F.col("text").alias(TEXT), F.col("lang").alias(LABEL)
    )


TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"
WORDS_SQL = r"len(regexp_extract_all({}, '[^\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+'))"


def _guess(words: Column) -> Column:
    """A plain rule that stands for a classifier: a few words that give a language away."""
    has = lambda *ws: F.arrays_overlap(words, F.array(*[F.lit(w) for w in ws]))
    return (
        F.when(has("und", "der"), "de").when(has("el", "los"), "es").when(has("le", "des"), "fr").otherwise("en")
    )


def guesses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their actual and a guessed label."""
    return documents(spark, folder).select(
        "doc_id", F.col("lang").alias("actual"), _guess(tokens(F.col("text"))).alias("predicted")
    )


GUESSES_SQL = f"""
guesses AS (
  SELECT doc_id, lang AS actual,
         CASE WHEN list_has_any(words, ['und', 'der']) THEN 'de'
              WHEN list_has_any(words, ['el', 'los']) THEN 'es'
              WHEN list_has_any(words, ['le', 'des']) THEN 'fr' ELSE 'en' END AS predicted
  FROM (SELECT doc_id, lang, {TOKENS_SQL} AS words FROM documents))"""


def _digest_sql(key: str, seed: int = 42, epoch: int = 0) -> str:
    return f"md5('{seed}|{epoch}|' || CAST({key} AS VARCHAR))"


def _as_text(items: str) -> Column:
    """An array of numbers as text, to compare it across engines."""
    return F.col(items).cast("string").alias(items)


# --- scans, sources, sinks -------------------------------------------------------------------


@query(
    f"""WITH {PRODUCTS_SQL}
SELECT asin, title, brand, price, main_cat, array_to_string(description, '/') AS description,
       CAST(len(feature) AS BIGINT) AS features FROM products"""
)
def json_lines_read(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json-lines")
    write_json_lines(products(spark, folder), path)
    return read_json_lines(spark, path, PRODUCT).select(
        "asin", "title", "brand", "price", LABEL,
        F.array_join("description", "/").alias("description"), F.size("feature").cast("bigint").alias("features"),
    )


_LINE_SQL = """'{"asin":"' || CAST(event_id AS VARCHAR) || '","title":"' || event_type || '"'"""


def _lines_with_faults(spark: SparkSession, folder: str) -> str:
    """Events as JSON lines of which those of type ``error`` lack their closing brace."""
    line = F.concat(
        F.lit('{"asin":"'), F.col("event_id").cast("string"), F.lit('","title":"'), F.col("event_type"), F.lit('"'),
        F.when(F.col("event_type") == "error", "").otherwise("}"),
    )
    path = scratch_path(spark, "lines")
    table(spark, folder, "events").select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path


@query(
    f"""SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS asin,
       CASE WHEN event_type <> 'error' THEN event_type END AS title,
       CASE WHEN event_type = 'error' THEN {_LINE_SQL} END AS malformed
FROM events"""
)
def malformed_lines_kept(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_json_lines(spark, _lines_with_faults(spark, folder), PRODUCT, keep_malformed=True)
    return lines.select("asin", "title", MALFORMED)


@query("SELECT CAST(event_id AS VARCHAR) AS asin, event_type AS title FROM events WHERE event_type <> 'error'")
def malformed_lines_dropped(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_json_lines(spark, _lines_with_faults(spark, folder), PRODUCT, mode="DROPMALFORMED")
    return lines.select("asin", "title")


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def parquet_read(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")


@query(f"WITH {PRODUCTS_SQL} SELECT asin, {FLAT_SQL} AS combined_text, main_cat FROM products")
def parquet_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "texts")
    write_table(preprocess(parts(spark, folder)), path)
    write_table(preprocess(products(spark, folder)), path)
    return read_table(spark, path)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields_parsed(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select("event_id", json_fields(F.col("props"), "k bigint")["k"].alias("k"))


# --- projections, filters, validation ----------------------------------------------------------


@query(
    f"""WITH {PARTS_SQL} SELECT asin, title, array_to_string(description, '/') AS description,
       array_to_string(feature, '/') AS feature, main_cat FROM parts"""
)
def columns_kept(spark: SparkSession, folder: str) -> DataFrame:
    raw = without(parts(spark, folder), "brand")
    kept = keep_columns(raw, ["asin", "title", "description", "feature", "brand", "main_cat"])
    return kept.withColumns({c: F.array_join(c, "/") for c in ("description", "feature")})


@query(f"WITH {PARTS_SQL} SELECT asin, {FLAT_SQL} AS combined_text, main_cat FROM parts")
def text_and_label_kept(spark: SparkSession, folder: str) -> DataFrame:
    return text_and_label(with_text(keep_columns(parts(spark, folder))))


@query("SELECT doc_id, lang FROM documents")
def columns_dropped(spark: SparkSession, folder: str) -> DataFrame:
    return without(table(spark, folder, "documents"), "text", "source", "n_chars")


@query("SELECT doc_id AS asin FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 10")
def label_filter_preview(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_label(table(spark, folder, "documents"), "en", "lang")
    return rows.select(F.col("doc_id").alias("asin")).orderBy("asin").limit(10)


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en'")
def label_filter(spark: SparkSession, folder: str) -> DataFrame:
    return with_label(table(spark, folder, "documents"), "en", "lang").select("doc_id", "lang", "source")


@query(
    """SELECT doc_id, concat_ws(' | ', nullif(source, 'src1'), nullif(lang, 'en'), CAST(n_chars AS VARCHAR)) AS joined
FROM documents"""
)
def nulls_skipped(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(
        "doc_id", F.nullif("source", F.lit("src1")).alias("source"), F.nullif("lang", F.lit("en")).alias("lang"),
        "n_chars",
    )
    return rows.select("doc_id", combine_flat("source", "lang", "n_chars").alias("joined"))


_REQUESTS_SQL = """
requests AS (
  SELECT CAST(p_partkey AS VARCHAR) AS asin, nullif(p_brand, 'Brand#2') AS brand,
         nullif(p_type, 'PROMO') AS kind, p_size > 40 AS long
  FROM part)"""


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as requests of which some lack a field."""
    return (
        parts(spark, folder)
        .withColumn("brand", F.nullif("brand", F.lit("Brand#2")))
        .withColumn("feature", F.array(F.nullif(LABEL, F.lit("PROMO"))))
        .withColumn("description", F.when(~(F.regexp_extract("price", r"\d+", 0).cast("int") > 40), F.col("description")))
        .drop(LABEL)
    )


@query(
    f"""WITH {_REQUESTS_SQL}
SELECT asin, nullif(concat_ws('; ', CASE WHEN brand IS NULL THEN 'brand is missing' END,
                              CASE WHEN long THEN 'description is missing' END,
                              CASE WHEN kind IS NULL THEN 'feature holds a null' END), '') AS reject_reason
FROM requests"""
)
def requests_checked(spark: SparkSession, folder: str) -> DataFrame:
    return with_reason(requests(spark, folder)).select("asin", REASON)


@query("SELECT doc_id, source, source IN ('src0', 'src1', 'src2', 'src3') AS in_domain FROM documents")
def labels_checked(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "source")
    return with_domain_check(rows, "source", ["src0", "src1", "src2", "src3"])


# --- scalar functions --------------------------------------------------------------------------


@query(f"WITH {PRODUCTS_SQL} SELECT asin, {FLAT_SQL} AS combined_text FROM products")
def text_flat(spark: SparkSession, folder: str) -> DataFrame:
    rows = products(spark, folder)
    return rows.select("asin", combine_flat("asin", "title", "description", "feature", "brand").alias(TEXT))


def _listed_sql(items: str) -> str:
    """An array as Python prints it, for texts whose only unprintable characters are tab and newline."""
    escaped = r"replace(replace(replace(replace(x, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')"
    return f"""'[' || coalesce(array_to_string(list_transform({items}, lambda x:
      CASE WHEN contains(x, '''') AND NOT contains(x, '"') THEN '"' || {escaped} || '"'
           ELSE '''' || replace({escaped}, '''', '\\''') || '''' END), ', '), '') || ']'"""


@query(
    f"""WITH {PRODUCTS_SQL}
SELECT asin, concat_ws(' | ', asin, title, {_listed_sql('description')}, {_listed_sql('feature')}, brand) AS combined_text
FROM products"""
)
def text_listed(spark: SparkSession, folder: str) -> DataFrame:
    kept = keep_columns(products(spark, folder))
    return kept.select("asin", combine_listed(kept).alias(TEXT))


@query(
    f"""WITH whole AS (SELECT page_id, [html, url] AS items FROM pages)
SELECT page_id, concat_ws(' | ', CAST(page_id AS VARCHAR), {_listed_sql('items')}) AS combined_text FROM whole"""
)
def text_listed_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Raw pages hold quotes, tabs and line ends: the escaping rules at work."""
    whole = table(spark, folder, "pages").select("page_id", F.array("html", "url").alias("items"))
    return whole.select("page_id", combine_listed(whole, ["page_id", "items"]).alias(TEXT))


@query(
    f"""WITH {PRODUCTS_SQL}
SELECT asin, concat_ws(' ', title, array_to_string(description, ' '), brand, array_to_string(feature, ' '),
                       array_to_string(category, ' ')) AS text FROM products"""
)
def text_spaced(spark: SparkSession, folder: str) -> DataFrame:
    rows = products(spark, folder)
    return rows.select("asin", combine_spaced("title", "description", "brand", "feature", "category").alias("text"))


@query(f"SELECT doc_id, CAST({WORDS_SQL.format('text')} AS BIGINT) AS words FROM documents")
def words_counted(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", word_count(F.col("text")).cast("bigint").alias("words"))


@query(
    f"WITH {PRODUCTS_SQL} SELECT asin, description[1] AS first, description[2] AS second FROM products"
)
def array_elements(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.col("description")
    return products(spark, folder).select("asin", element(lines, 0).alias("first"), element(lines, 1).alias("second"))


@query(f"WITH {PRODUCTS_SQL} SELECT asin, array_to_string(description[1:2], '/') AS first_two FROM products")
def array_heads(spark: SparkSession, folder: str) -> DataFrame:
    return products(spark, folder).select("asin", F.array_join(head(F.col("description"), 2), "/").alias("first_two"))


@query(
    """SELECT doc_id, CAST(list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS BIGINT) AS code, lang AS name
FROM documents"""
)
def label_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = table(spark, folder, "documents").select("doc_id", label_code(F.col("lang"), LANGUAGES).alias("code"))
    return coded.withColumn("name", label_name(F.col("code"), LANGUAGES))


@query(
    """SELECT DISTINCT replace(replace(replace(p_brand || ' & ' || p_type || ', ' || p_name, '&', 'and'), ', ', '_'), ' ', '_')
       AS label_key FROM part"""
)
def label_keys(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat("p_brand", F.lit(" & "), "p_type", F.lit(", "), "p_name")
    return table(spark, folder, "part").select(label_key(name).alias("label_key")).distinct()


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best FROM embeddings")
def best_scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", argmax(F.col("embedding")).alias("best"))


@query("SELECT concat_ws(' | ', CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR), p_name) AS joined FROM part")
def numbers_as_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", "p_size", "p_name")
    return rows.select(combine_listed(rows).alias("joined"))


# --- text encoding -------------------------------------------------------------------------------

_WORD_IDS_SQL = f"""
counts AS (SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS_SQL}) AS token FROM documents) GROUP BY token),
ranks AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 3 AS id FROM counts WHERE n >= 2)"""


@query(f"WITH {_WORD_IDS_SQL} SELECT token, n, id FROM ranks")
def word_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(token_counts(documents(spark, folder), "text", min_count=2))


@query(
    f"""WITH {_WORD_IDS_SQL},
placed AS (
  SELECT doc_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos
  FROM (SELECT doc_id, {TOKENS_SQL} AS words FROM documents)),
found AS (
  SELECT doc_id, list(coalesce(id, 1) ORDER BY pos)[1:510] AS ids
  FROM placed LEFT JOIN ranks USING (token) GROUP BY doc_id),
framed AS (
  SELECT doc_id, lang, list_concat([2], coalesce(ids, []), [3]) AS ids FROM documents LEFT JOIN found USING (doc_id))
SELECT doc_id, lang AS main_cat,
       CAST(list_concat(ids, list_transform(range(512 - len(ids)), lambda i: 0)) AS VARCHAR) AS input_ids,
       CAST(list_concat(list_transform(ids, lambda i: 1),
                        list_transform(range(512 - len(ids)), lambda i: 0)) AS VARCHAR) AS attention_mask
FROM framed"""
)
def words_encoded(spark: SparkSession, folder: str) -> DataFrame:
    rows = texts(spark, folder)
    known = word_vocabulary(rows, min_count=2)
    encoded = encode(rows, known, 512, "word")
    return encoded.select("doc_id", LABEL, _as_text("input_ids"), _as_text("attention_mask"))


SQL["words_encoded_by_join"] = SQL["words_encoded"]


@query(SQL["words_encoded_by_join"])
def words_encoded_by_join(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the route for vocabularies too large to send."""
    rows = texts(spark, folder)
    known = word_vocabulary(rows, min_count=2)
    encoded = encode(rows, known, 512, "word", route="join")
    return encoded.select("doc_id", LABEL, _as_text("input_ids"), _as_text("attention_mask"))


PIECES = 8_000

_CLASS = r"!-/:-@\[-`{-~\p{P}"

# Words as the encoder splits and folds them, then their counted pieces, characters first.
_PIECE_IDS_SQL = f"""
placed AS MATERIALIZED (
  SELECT doc_id, lower(strip_accents(unnest(words))) AS f, generate_subscripts(words, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[{_CLASS}]|[^{_CLASS}\\t\\n\\r\\p{{Z}}]+') AS words FROM documents)),
counts AS (SELECT f AS w, count(*) AS n FROM placed GROUP BY f HAVING length(f) <= 100),
starts AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM counts),
runs AS (SELECT w, n, i, unnest(range(1, least(6, length(w) - i + 1) + 1)) AS len FROM starts),
pieces AS (
  SELECT CASE WHEN i > 1 THEN '##' ELSE '' END || substr(w, i, len) AS token, n FROM runs
  UNION ALL SELECT w, n FROM counts WHERE length(w) > 6
  UNION ALL SELECT CASE WHEN i > 1 THEN '' ELSE '##' END || substr(w, i, 1), 0 FROM starts),
piece_counts AS (SELECT token, CAST(sum(n) AS BIGINT) AS n, length(regexp_replace(token, '^##(.)', '\\1')) = 1 AS single FROM pieces GROUP BY token),
numbered AS (SELECT token, single, row_number() OVER (ORDER BY single DESC, n DESC, token) + 3 AS id FROM piece_counts),
vocabulary AS MATERIALIZED (SELECT token, id FROM numbered WHERE single OR id < {PIECES})"""


@query(
    f"""WITH {_PIECE_IDS_SQL}
SELECT token, id FROM vocabulary
UNION ALL SELECT unnest(['[PAD]', '[UNK]', '[CLS]', '[SEP]']), unnest([0, 1, 2, 3])"""
)
def piece_ids(spark: SparkSession, folder: str) -> DataFrame:
    return piece_vocabulary(documents(spark, folder), "text", PIECES)


PIECES_FOUND_SQL = f"""WITH RECURSIVE {_PIECE_IDS_SQL},
folded AS MATERIALIZED (SELECT DISTINCT f FROM placed),
spots AS (SELECT f, unnest(range(1, length(f) + 1)) AS i FROM folded WHERE length(f) <= 100),
cuts AS (SELECT f, i, unnest(range(1, length(f) - i + 2)) AS len FROM spots),
best AS MATERIALIZED (
  SELECT f, i, max(len) AS len, arg_max(id, len) AS id
  FROM cuts JOIN vocabulary ON token = CASE WHEN i > 1 THEN '##' ELSE '' END || substr(f, i, len)
  GROUP BY f, i),
walk AS (
  SELECT f, CAST(1 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS ids FROM folded
  UNION ALL
  SELECT walk.f, walk.i + best.len, list_append(walk.ids, best.id)
  FROM walk JOIN best ON walk.f = best.f AND walk.i = best.i),
done AS (SELECT f, ids FROM walk WHERE i = length(f) + 1),
found AS (
  SELECT doc_id, flatten(list(coalesce(ids, [1]) ORDER BY pos))[1:510] AS ids
  FROM placed LEFT JOIN done USING (f) GROUP BY doc_id)"""

PIECES_ENCODED_SQL = f"""{PIECES_FOUND_SQL},
framed AS (
  SELECT doc_id, lang, list_concat([2], coalesce(ids, []), [3]) AS ids FROM documents LEFT JOIN found USING (doc_id))
SELECT doc_id, lang AS main_cat,
       CAST(list_concat(ids, list_transform(range(512 - len(ids)), lambda i: 0)) AS VARCHAR) AS input_ids,
       CAST(len(ids) AS BIGINT) AS used
FROM framed"""


def _pieces(spark: SparkSession, folder: str, route: str | None = None) -> DataFrame:
    rows = texts(spark, folder)
    known = piece_vocabulary(rows, TEXT, PIECES)
    encoded = encode(rows, known, 512, "piece", route=route)
    used = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, m: a + m)
    return encoded.select("doc_id", LABEL, _as_text("input_ids"), used.alias("used"))


@query(PIECES_ENCODED_SQL)
def pieces_encoded(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder)


@query(PIECES_ENCODED_SQL)
def pieces_encoded_by_join(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the route for vocabularies too large to send."""
    return _pieces(spark, folder, "join")


@query()
def texts_encoded_pretrained(spark: SparkSession, folder: str) -> DataFrame:
    """Every document by a public tokenizer's file, framed by its own first and last ids."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = encode_pretrained(texts(spark, folder), path, start=49406, end=49407, pad=49407)
    used = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, m: a + m)
    return encoded.select("doc_id", LABEL, _as_text("input_ids"), used.alias("used"))


@query(
    f"""{PIECES_FOUND_SQL}
SELECT CAST(sum(len(ids)) AS BIGINT) AS ids, CAST(sum(len(list_filter(ids, lambda i: i = 1))) AS BIGINT) AS unknown,
       sum(len(list_filter(ids, lambda i: i = 1))) / sum(len(ids)) AS share, unknown = 0 AS all_known FROM found"""
)
def piece_unknowns(spark: SparkSession, folder: str) -> DataFrame:
    """How many ids are unknown where the vocabulary was counted on the same texts: none."""
    rows = texts(spark, folder)
    found = unknown_share(encode(rows, piece_vocabulary(rows, TEXT, PIECES)))
    return found.withColumn("all_known", F.col("unknown") == 0)


@query(
    """SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS width, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))), 6) AS total
FROM embeddings"""
)
def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", "label", id_features(F.col("embedding")).alias("features")
    )
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0).cast("double"), lambda a, v: a + v)
    return vectors.select("vec_id", "label", F.size(values).cast("bigint").alias("width"), F.round(total, 6).alias("total"))


@query(
    f"""SELECT lang AS main_cat, count(*) AS rows, round(avg(n), 6) AS mean_tokens, CAST(max(n) AS BIGINT) AS max_tokens,
       round(avg(CASE WHEN n > 510 THEN 1.0 ELSE 0.0 END), 6) AS truncated_share
FROM (SELECT lang, len({TOKENS_SQL}) AS n FROM documents) GROUP BY lang"""
)
def truncation_by_label(spark: SparkSession, folder: str) -> DataFrame:
    found = truncation(texts(spark, folder))
    return found.withColumns({c: F.round(c, 6) for c in ("mean_tokens", "truncated_share")})


# --- aggregations --------------------------------------------------------------------------------


@query("SELECT count(*) AS rows FROM documents")
def rows_counted(spark: SparkSession, folder: str) -> DataFrame:
    return row_count(table(spark, folder, "documents"))


@query(
    """SELECT count(*) AS with_null, count(source) AS without_null
FROM (SELECT DISTINCT nullif(source, 'src3') AS source FROM documents)"""
)
def labels_distinct(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(F.nullif("source", F.lit("src3")).alias("source"))
    return distinct_count(rows, "source")


@query("SELECT p_type AS main_cat, count(*) AS count FROM part GROUP BY p_type ORDER BY p_type")
def label_counts(spark: SparkSession, folder: str) -> DataFrame:
    return group_count(parts(spark, folder)).orderBy(LABEL)


_PIECE_SQL = f"CAST('0x' || substr({_digest_sql('doc_id')}, 1, 8) AS BIGINT)"


@query(
    f"""WITH sizes AS (SELECT lang, CAST(ceil(count(source) / 100) AS BIGINT) AS pieces FROM documents GROUP BY lang)
SELECT lang, {_PIECE_SQL} % pieces AS piece, pieces, array_to_string(list_sort(list(source)), ',') AS items
FROM documents JOIN sizes USING (lang) GROUP BY ALL"""
)
def groups_collected(spark: SparkSession, folder: str) -> DataFrame:
    pieces = collected(table(spark, folder, "documents"), "source", "doc_id", "lang", rows_per_piece=100)
    return pieces.withColumn("items", F.array_join("items", ","))


@query(
    f"""WITH sized AS (SELECT lang, CAST({WORDS_SQL.format('text')} AS BIGINT) AS w FROM documents),
boxes AS (SELECT lang, count(*) AS n, quantile_cont(w, 0.25) AS q1, quantile_cont(w, 0.5) AS median,
                 quantile_cont(w, 0.75) AS q3 FROM sized GROUP BY lang)
SELECT lang AS main_cat, n, q1, median, q3,
       least(CAST(min(w) FILTER (WHERE w BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), q1) AS whisker_low,
       greatest(CAST(max(w) FILTER (WHERE w BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), q3) AS whisker_high,
       count(*) FILTER (WHERE w NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM sized JOIN boxes USING (lang) GROUP BY lang, n, q1, median, q3"""
)
def word_count_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return box_statistics(texts(spark, folder), word_count(F.col(TEXT)))


@query(
    """SELECT 'all' AS main_cat, CAST(place // 100 AS BIGINT) AS piece, CAST(ceil(total / 100) AS BIGINT) AS pieces,
       array_to_string(list_sort(list(source)), ',') AS items
FROM (SELECT source, row_number() OVER (ORDER BY source) - 1 AS place, count(*) OVER () AS total
      FROM documents WHERE source IS NOT NULL)
GROUP BY ALL"""
)
def one_group_collected(spark: SparkSession, folder: str) -> DataFrame:
    """The sources of all documents as one list, in pieces."""
    rows = table(spark, folder, "documents").select(F.lit("all").alias(LABEL), "source")
    pieces = collected_in_order(rows, "source", rows_per_piece=100)
    return pieces.withColumn("items", F.array_join("items", ","))


@query(
    """SELECT lang AS main_cat, count(text) AS n, TRUE AS q1_close, TRUE AS median_close, TRUE AS q3_close
FROM documents GROUP BY lang HAVING count(text) > 0"""
)
def word_boxes_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of word counts by language from stored sketches of each source.

    A quartile is close if its rank in the whole table is off by at most twice the stated rank error.
    """
    sized = documents(spark, folder).select(F.col("lang").alias(LABEL), "source", word_count(F.col("text")).alias("words"))
    path = scratch_path(spark, "sketches")
    write_table(value_sketches(sized, F.col("words"), LABEL, "source"), path)
    boxes = quartiles(merged_sketches(read_table(spark, path), LABEL)).withColumnRenamed(LABEL, "label")
    counts = sized.groupBy(LABEL, "words").agg(F.count(F.lit(1)).alias("rows"))
    near = []
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        below, upto = (F.sum(F.when(c, F.col("rows")).otherwise(0)) for c in (F.col("words") < F.col(name), F.col("words") <= F.col(name)))
        error = F.lit(2 * rank_error()) * F.col("n")
        near.append(((below <= share * F.col("n") + error) & (upto >= share * F.col("n") - error)).alias(f"{name}_close"))
    joined = counts.join(boxes, F.col(LABEL).eqNullSafe(F.col("label")))
    return joined.groupBy(LABEL, "n", "q1", "median", "q3").agg(*near).drop("q1", "median", "q3")


_SPLIT_SQL = f"""CASE WHEN {_digest_sql('doc_id')} < 'a3d70a3d' THEN 'train'
       WHEN {_digest_sql('doc_id')} < 'cccccccd' THEN 'val' ELSE 'test' END"""


@query(
    f"""SELECT lang AS label, count(*) AS count FROM documents WHERE {_digest_sql('doc_id')} < 'a3d70a3d' GROUP BY lang"""
)
def train_label_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_split(texts(spark, folder), "doc_id").filter(F.col("split") == "train")
    return group_count(rows.select(F.col(LABEL).alias("label")), "label")


@query("SELECT count(*) AS rows, round(sum(value), 4) AS total_loss, round(avg(value), 9) AS mean_loss FROM events")
def losses_averaged(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("value"), 4).alias("total_loss"),
        F.round(F.avg("value"), 9).alias("mean_loss"),
    )


@query(
    f"""WITH {PRODUCTS_SQL}
SELECT main_cat, count(*) AS count, round(avg({WORDS_SQL.format(FLAT_SQL)}), 6) AS mean_words
FROM products GROUP BY main_cat ORDER BY main_cat"""
)
def text_length_by_label(spark: SparkSession, folder: str) -> DataFrame:
    rows = preprocess(products(spark, folder))
    words = word_count(F.col(TEXT))
    return (
        rows.groupBy(LABEL)
        .agg(F.count(F.lit(1)).alias("count"), F.round(F.avg(words), 6).alias("mean_words"))
        .orderBy(LABEL)
    )


# --- numbering -----------------------------------------------------------------------------------


@query(
    """SELECT p_type AS main_cat, CAST(list(p_partkey ORDER BY p_partkey) AS VARCHAR) AS examples
FROM (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS r FROM part)
WHERE r <= 10 GROUP BY p_type"""
)
def label_examples(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(F.col("p_type").alias(LABEL), "p_partkey")
    return examples(rows, "p_partkey", 10, ["p_partkey"]).select(LABEL, _as_text("examples"))


def _batch_sql(table_name: str, key: str, size: int, epoch: int = 0) -> str:
    return f"""CAST(floor((row_number() OVER (ORDER BY {_digest_sql(key, 42, epoch)}, {key}) - 1) / {size}) AS BIGINT)"""


@query(f"SELECT doc_id, {_batch_sql('documents', 'doc_id', 8, 1)} AS batch FROM documents")
def mini_batches(spark: SparkSession, folder: str) -> DataFrame:
    return batches(table(spark, folder, "documents").select("doc_id"), "doc_id", 8, epoch=1)


def _training_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Events in batches of 4 as training steps: the value is the loss, clicks are guessed."""
    rows = table(spark, folder, "events").select(
        "event_id", F.col("value").alias("loss"), F.col("event_type").alias("actual"), F.lit("click").alias("predicted")
    )
    return metrics.batch_scores(batches(rows, "event_id", 4), loss="loss")


_STEPS_SQL = f"""
numbered AS (SELECT {_batch_sql('events', 'event_id', 4)} AS batch, value, event_type FROM events),
steps AS (SELECT batch, avg(value) AS loss, avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) AS accuracy
          FROM numbered GROUP BY batch)"""


@query(
    f"""WITH {_STEPS_SQL},
running AS (SELECT batch, max(batch) OVER () AS last_batch,
                   avg(loss) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS loss,
                   avg(accuracy) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS accuracy FROM steps)
SELECT batch AS step, round(loss, 9) AS loss, round(accuracy, 9) AS accuracy FROM running
WHERE (batch + 1) % 100 = 0 OR batch = last_batch"""
)
def running_step_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.running_means(_training_steps(spark, folder), "loss", "accuracy")
    return _rounded(found, "loss", "accuracy")


@query(
    f"""WITH {_STEPS_SQL} SELECT count(*) AS batches, round(avg(loss), 9) AS loss, round(avg(accuracy), 9) AS accuracy
FROM steps"""
)
def epoch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.mean_of_batches(_training_steps(spark, folder), "loss", "accuracy")
    return _rounded(found, "loss", "accuracy")


# --- sorts, limits, samples, splits --------------------------------------------------------------


@query("SELECT source AS main_cat, count(*) AS count FROM documents GROUP BY source ORDER BY count DESC, source LIMIT 5")
def top_labels(spark: SparkSession, folder: str) -> DataFrame:
    return top_groups(table(spark, folder, "documents").select(F.col("source").alias(LABEL)), 5)


@query(
    f"""SELECT doc_id, row_number() OVER (ORDER BY {_digest_sql('doc_id', 42, 2)}, doc_id) AS place FROM documents"""
)
def seeded_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id")
    return shuffled(shuffled_numbers(rows, "doc_id", epoch=2, name="place"), "doc_id", epoch=2)


@query(f"SELECT doc_id, lang FROM documents WHERE {_digest_sql('doc_id')} < '4ccccccd'")
def sample_of_share(spark: SparkSession, folder: str) -> DataFrame:
    return sample_share(table(spark, folder, "documents").select("doc_id", "lang"), 0.3, "doc_id")


@query(
    f"""SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY {_digest_sql('doc_id')}) AS r,
       count(*) OVER () AS total FROM documents) WHERE r <= round_even(0.2 * total, 0)"""
)
def sample_of_size(spark: SparkSession, folder: str) -> DataFrame:
    return sample_exact(table(spark, folder, "documents").select("doc_id", "lang"), 0.2, "doc_id")


@query(f"SELECT doc_id, {_SPLIT_SQL} AS split FROM documents")
def split_by_share(spark: SparkSession, folder: str) -> DataFrame:
    return with_split(table(spark, folder, "documents").select("doc_id"), "doc_id")


@query(
    f"""SELECT doc_id, CASE WHEN r <= ceil(0.2 * total) THEN 'test'
       WHEN r <= ceil(0.2 * total) + ceil(0.2 * (total - ceil(0.2 * total))) THEN 'val' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY {_digest_sql('doc_id')}) AS r, count(*) OVER () AS total FROM documents)"""
)
def split_by_size(spark: SparkSession, folder: str) -> DataFrame:
    return with_exact_split(table(spark, folder, "documents").select("doc_id"), "doc_id")


# --- classification ------------------------------------------------------------------------------


@query()
def text_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Fit, save, load, then score the test rows: key, label and prediction."""
    rows = with_split(texts(spark, folder), "doc_id")
    train, val, test = (rows.filter(F.col("split") == s) for s in ("train", "val", "test"))
    fitted = fit_text_classifier(train, val, LANGUAGES, features=1 << 14, strengths=(0.01, 0.001), iterations=10)
    path = scratch_path(spark, "model")
    save_model(fitted.model, path)
    scored = load_model(path).transform(with_code(test, LANGUAGES))
    return scored.select("doc_id", LABEL, "predicted", F.round(loss_of_row(), 4).alias("loss"))


_LONG_SQL = "long AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)"


@query(
    f"""WITH {_LONG_SQL}, spread AS (SELECT pos, stddev_pop(CAST(x AS DOUBLE)) AS s FROM long GROUP BY pos)
SELECT vec_id, CAST(pos AS BIGINT) AS pos, round(CAST(x AS DOUBLE) / s, 6) AS scaled FROM long JOIN spread USING (pos)"""
)
def features_scaled(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", id_features(F.col("embedding")).alias("features"))
    scaled = fit_scale(rows).transform(rows)
    long = scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("pos", "x"))
    return long.select("vec_id", (F.col("pos") + 1).cast("bigint").alias("pos"), F.round("x", 6).alias("scaled"))


@query()
def features_projected(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", id_features(F.col("embedding")).alias("features"))
    scaled = fit_scale(rows).transform(rows)
    projected = fit_projection(scaled, 2).transform(scaled)
    values = F.transform(vector_to_array("projected"), lambda v: F.round(v, 4))
    return projected.select("vec_id", F.get(values, F.lit(0)).alias("first"), F.get(values, F.lit(1)).alias("second"))


def _linear(spark: SparkSession, folder: str, **options) -> DataFrame:
    labels = [str(i) for i in range(10)]
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").alias("input_ids"), F.col("label").cast("string").alias(LABEL)
    )
    return linear_baseline(rows, labels=labels, key="vec_id", **options).predictions


@query()
def margin_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _linear(spark, folder, **MARGIN)


@query()
def hinge_baseline(spark: SparkSession, folder: str) -> DataFrame:
    # The vectors have 64 columns, fewer than the usual number of components.
    return _linear(spark, folder, **{**HINGE, "components": 32})


def _stored_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of all documents, written and read back."""
    import public_tokenizers

    path = scratch_path(spark, "encoded")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    write_table(encode_pretrained(texts(spark, folder), tokenizer, start=49406, end=49407, pad=0), path)
    return read_table(spark, path)


@query(
    """SELECT CAST(k AS BIGINT) AS components, count(*) AS rows, TRUE AS orthonormal, TRUE AS close
FROM documents, (VALUES (2), (100)) AS asked(k) GROUP BY k"""
)
def ids_projected(spark: SparkSession, folder: str) -> DataFrame:
    """Two and a hundred components of the 512 ids by the range finder.

    ``close``: what the axes leave out is at most a hundredth more than the best axes leave out, by
    the matrix of column products.
    """
    rows = _stored_ids(spark, folder).select(id_features(F.col("input_ids")).alias("features"))
    scaled = written(fit_scale(rows).transform(rows).select("scaled"), "scaled")
    squares = fit_projection(scaled, 512).values ** 2
    found = []
    for k in (2, 100):
        projection = fit_wide_projection(scaled, k, tolerance=1e-3).projection
        left, least = squares.sum() - (projection.values**2).sum(), squares[k:].sum()
        level = abs(projection.axes.T @ projection.axes - np.eye(k)).max() < 1e-9
        flags = F.lit(k).cast("bigint").alias("components"), F.lit(bool(level)).alias("orthonormal")
        found.append(F.struct(*flags, F.lit(bool(left <= 1.01 * least)).alias("close")))
    return row_count(scaled).select("rows", F.inline(F.array(*found)))


def _on_ids(spark: SparkSession, folder: str, **options) -> DataFrame:
    """A baseline on the stored ids of all documents: test rows of each label, and what must hold of its predictions."""
    stored = _stored_ids(spark, folder)
    tested = linear_baseline(stored, labels=LANGUAGES, key="doc_id", **options).predictions
    flags = tested.groupBy("actual").agg(
        F.count(F.lit(1)).alias("support"),
        F.count_if(F.col("predicted").isin(LANGUAGES)).alias("named"),
        F.count_if(F.col("actual") == F.col("predicted")).alias("hits"),
    )
    right = F.sum("hits").over(Window.partitionBy()) / F.sum("support").over(Window.partitionBy())
    return flags.select(
        F.col("actual").alias("label"),
        "support",
        (F.col("named") == F.col("support")).alias("all_named"),
        (right > 1 / len(LANGUAGES)).alias("beats_chance"),
    )


_SUPPORTS_SQL = f"""SELECT lang AS label, count(*) AS support, TRUE AS all_named, TRUE AS beats_chance
FROM (SELECT lang, row_number() OVER (ORDER BY {_digest_sql('doc_id')}) AS r, count(*) OVER () AS total FROM documents)
WHERE r <= ceil(0.2 * total) GROUP BY lang"""


@query(_SUPPORTS_SQL)
def margin_on_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of labels on two components of the 512 ids."""
    return _on_ids(spark, folder, **MARGIN)


@query(_SUPPORTS_SQL)
def hinge_on_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Labels against the rest on a hundred components of the 512 ids."""
    return _on_ids(spark, folder, **HINGE)


@query(
    """SELECT user_id AS candidate, round(avg(value), 6) AS loss FROM events GROUP BY user_id
ORDER BY avg(value), user_id LIMIT 1"""
)
def best_epoch(spark: SparkSession, folder: str) -> DataFrame:
    """Users stand for candidates, their mean value for the validation loss."""
    scores = table(spark, folder, "events").groupBy(F.col("user_id").alias("candidate")).agg(F.avg("value").alias("loss"))
    return metrics.best_candidate(scores).withColumn("loss", F.round("loss", 6))


# --- metrics ---------------------------------------------------------------------------------------

_SCORES_SQL = """
sides AS (
  SELECT actual AS label, 1 AS support, 0 AS named, CASE WHEN actual = predicted THEN 1 ELSE 0 END AS hits FROM pairs
  UNION ALL SELECT predicted, 0, 1, 0 FROM pairs),
sums AS (SELECT label, CAST(sum(support) AS BIGINT) AS support, sum(named) AS named, sum(hits) AS hits
         FROM sides GROUP BY label),
scores AS (
  SELECT label, support, hits,
         CASE WHEN named = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / named END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / support END AS recall,
         CAST(2 * hits AS DOUBLE) / (named + support) AS f1
  FROM sums)"""


def _rounded(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    f"""WITH {GUESSES_SQL}, pairs AS (SELECT * FROM guesses), {_SCORES_SQL}
SELECT round(sum(hits) / sum(support), 9) AS accuracy, round(sum(f1 * support) / sum(support), 9) AS f1,
       round(sum(precision * support) / sum(support), 9) AS precision,
       round(sum(recall * support) / sum(support), 9) AS recall FROM scores"""
)
def weighted_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.summary(guesses(spark, folder)), "accuracy", "f1", "precision", "recall")


@query(
    f"""WITH {GUESSES_SQL}
SELECT round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM guesses"""
)
def plain_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.accuracy(guesses(spark, folder)), "accuracy")


@query(
    f"""WITH {GUESSES_SQL}, known AS (SELECT unnest(['de', 'en', 'es', 'fr', 'none']) AS label),
cells AS (SELECT a.label AS actual, p.label AS predicted, count(doc_id) AS n
          FROM known a CROSS JOIN known p LEFT JOIN guesses g ON g.actual = a.label AND g.predicted = p.label
          GROUP BY a.label, p.label),
sums AS (SELECT actual, sum(n) AS total FROM cells GROUP BY actual)
SELECT actual, predicted, n, round(CASE WHEN total = 0 THEN 0 ELSE CAST(n AS DOUBLE) / total END, 9) AS share,
       round(CASE WHEN total = 0 THEN 0 ELSE CAST(n AS DOUBLE) / total END * 100, 7) AS percent
FROM cells JOIN sums USING (actual)"""
)
def confusion_table(spark: SparkSession, folder: str) -> DataFrame:
    cells = metrics.confusion(guesses(spark, folder), labels=[*LANGUAGES, "none"])
    return _rounded(_rounded(cells, "share"), "percent", digits=7)


@query(
    f"""WITH pairs AS (SELECT quality AS actual, toxic AS predicted FROM labels), {_SCORES_SQL}
SELECT CAST(label AS VARCHAR) AS label, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, support FROM scores
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 9), round(sum(hits) / sum(support), 9),
       round(sum(hits) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
       CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
       round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
       CAST(sum(support) AS BIGINT) FROM scores"""
)
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.report(table(spark, folder, "labels"), "quality", "toxic"), "precision", "recall", "f1")


@query(
    f"""WITH {GUESSES_SQL},
numbered AS (SELECT {_batch_sql('guesses', 'doc_id', 32)} AS batch, actual, predicted FROM guesses),
scores AS (SELECT batch, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS accuracy FROM numbered GROUP BY batch)
SELECT count(*) AS batches, round(avg(accuracy), 9) AS accuracy FROM scores"""
)
def batch_mean_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    rows = batches(guesses(spark, folder), "doc_id", 32)
    return _rounded(metrics.mean_of_batches(metrics.batch_scores(rows), "accuracy"), "accuracy")


@query(
    """WITH long AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
rows AS (SELECT vec_id, max(CASE WHEN pos = label + 1 THEN exp(CAST(x AS DOUBLE)) END) / sum(exp(CAST(x AS DOUBLE))) AS p
         FROM long GROUP BY vec_id)
SELECT count(*) AS rows, round(avg(-ln(p)), 9) AS loss FROM rows"""
)
def mean_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings stand for raw class scores, their label for the actual class."""
    loss = metrics.cross_entropy(metrics.softmax_at(F.col("embedding"), F.col("label")))
    return table(spark, folder, "embeddings").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(loss), 9).alias("loss")
    )


# --- streams and whole jobs ------------------------------------------------------------------------


@query(
    f"""WITH {_REQUESTS_SQL}
SELECT asin, concat_ws(' | ', asin, p_name, replace(p_name, ' ', ' | '), p_type, p_brand) AS combined_text
FROM requests JOIN part ON asin = CAST(p_partkey AS VARCHAR)
WHERE brand IS NOT NULL AND kind IS NOT NULL AND NOT long"""
)
def stream_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Requests arriving as gzipped JSON files: check, combine, append, all as a stream."""
    source, target, state = (scratch_path(spark, f"stream-{n}") for n in ("in", "out", "state"))
    write_json_lines(requests(spark, folder), source)
    found = request_text(request_stream(spark, source)).select(KEY, TEXT)
    start_writing(found, target, state).awaitTermination()
    return read_table(spark, target)


def _small_model(spark: SparkSession, folder: str):
    rows = with_split(preprocess(products(spark, folder), include_key=False), KEY)
    train, val = (rows.filter(F.col("split") == s) for s in ("train", "val"))
    return fit_text_classifier(train, val, LANGUAGES, features=1 << 12, strengths=(0.01,), iterations=5).model


_OUTCOMES_SQL = f"""WITH {_REQUESTS_SQL},
checked AS (
  SELECT asin, nullif(concat_ws('; ', CASE WHEN brand IS NULL THEN 'brand is missing' END,
                                CASE WHEN long THEN 'description is missing' END,
                                CASE WHEN kind IS NULL THEN 'feature holds a null' END), '') AS reject_reason
  FROM requests)
SELECT asin, reject_reason, CASE WHEN reject_reason IS NULL THEN TRUE END AS known_label FROM checked"""


def _outcomes(answered: DataFrame, refused: DataFrame) -> DataFrame:
    """One row for each request: the reason of its rejection, or whether its label is a known one."""
    known = answered.select(KEY, F.lit(None).cast("string").alias(REASON), F.col(LABEL).isin(LANGUAGES).alias("known_label"))
    return known.unionByName(refused.select(KEY, REASON, F.lit(None).cast("boolean").alias("known_label")))


@query(_OUTCOMES_SQL)
def requests_answered(spark: SparkSession, folder: str) -> DataFrame:
    """Every request is scored or rejected with a reason."""
    return _outcomes(*answer(requests(spark, folder), _small_model(spark, folder), include_key=False))


@query(_OUTCOMES_SQL)
def stream_answered(spark: SparkSession, folder: str) -> DataFrame:
    """The same for requests that arrive as files; a batch that is run again adds nothing."""
    source, target, refused, state = (scratch_path(spark, f"answers-{n}") for n in ("in", "out", "refused", "state"))
    asked, model = requests(spark, folder), _small_model(spark, folder)
    write_table(asked, source, rows_per_file=5_000)
    stream = request_stream(spark, source, asked.schema, "parquet", files_per_batch=4)
    start_answering(stream, model, target, refused, state, include_key=False).awaitTermination()
    return _outcomes(read_table(spark, target), read_table(spark, refused))


@query()
def table_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predict(products(spark, folder).drop(LABEL), _small_model(spark, folder), include_key=False)


@query()
def stream_predictions(spark: SparkSession, folder: str) -> DataFrame:
    source, target, state = (scratch_path(spark, f"scoring-{n}") for n in ("in", "out", "state"))
    write_table(products(spark, folder).drop(LABEL), source)
    stream = request_stream(spark, source, REQUEST, "parquet")
    start_scoring(stream, _small_model(spark, folder), target, state, include_key=False).awaitTermination()
    return read_table(spark, target)


@query(
    f"""WITH {PRODUCTS_SQL}
SELECT asin, concat_ws(' | ', title, {_listed_sql('description')}, {_listed_sql('feature')}, brand) AS combined_text, main_cat
FROM products"""
)
def preprocess_job(spark: SparkSession, folder: str) -> DataFrame:
    return preprocess(products(spark, folder), "listed", include_key=False)


@query(
    f"""WITH {PRODUCTS_SQL}
SELECT asin, {FLAT_SQL} AS combined_text, main_cat FROM products WHERE {_digest_sql('asin')} < '80000000'"""
)
def etl_job(spark: SparkSession, folder: str) -> DataFrame:
    source, target = scratch_path(spark, "etl-in"), scratch_path(spark, "etl-out")
    write_json_lines(products(spark, folder), source)
    run_etl(spark, source, target, fraction=0.5)
    return read_table(spark, target)


@query(
    SQL["words_encoded"].replace(
        "WITH ", f"WITH {PRODUCTS_SQL},\ndocuments AS (SELECT asin AS doc_id, main_cat AS lang, {FLAT_SQL} AS text FROM products),\n", 1
    ).replace("doc_id, lang AS main_cat", "doc_id AS asin, lang AS main_cat")
)
def etl_encoded(spark: SparkSession, folder: str) -> DataFrame:
    """All records from JSON lines to ids and masks, stored and read back."""
    source, target = scratch_path(spark, "etl-lines"), scratch_path(spark, "etl-ids")
    rows = products(spark, folder)
    write_json_lines(rows, source)
    run_etl(spark, source, target, word_vocabulary(preprocess(rows), min_count=2), rejected=f"{target}-malformed", level="word")
    return read_table(spark, target).select("asin", LABEL, _as_text("input_ids"), _as_text("attention_mask"))


@query(
    f"""SELECT {_LINE_SQL} AS malformed, count(*) OVER () AS malformed_lines, (SELECT count(*) FROM events) AS all_lines
FROM events WHERE event_type = 'error'"""
)
def etl_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Malformed lines, kept apart from the rows, and the counts that loading gives back."""
    target, refused = scratch_path(spark, "etl-events"), scratch_path(spark, "etl-malformed")
    done = run_etl(spark, _lines_with_faults(spark, folder), target, rejected=refused)
    counts = F.lit(done.malformed).cast("bigint").alias("malformed_lines"), F.lit(done.lines).cast("bigint").alias("all_lines")
    return read_table(spark, refused).select(MALFORMED, *counts)


@query()
def training_job(spark: SparkSession, folder: str) -> DataFrame:
    """Scores per label on the test split, from table to report."""
    done = train_and_evaluate(
        texts(spark, folder), LANGUAGES, key="doc_id", features=1 << 12, strengths=(0.01, 0.001), iterations=10
    )
    return _rounded(done.report, "precision", "recall", "f1", digits=3)


@query(
    f"""WITH train AS (SELECT count(*) AS n FROM documents WHERE ({_SPLIT_SQL}) = 'train'),
largest AS (SELECT max(n) / sum(n) AS share FROM (SELECT count(*) AS n FROM documents GROUP BY lang))
SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS epoch, CAST(least(8, ceil(n / ceil(n / 8))) AS BIGINT) AS steps, n AS rows,
       CAST(1 AS BIGINT) AS chosen_epochs, TRUE AS least_loss_chosen, TRUE AS beats_majority FROM train, largest"""
)
def epochs_trained(spark: SparkSession, folder: str) -> DataFrame:
    """Three epochs of eight mini-batches: what SQL knows of them, and whether the choice and the model are sound."""
    done = train_by_epochs(texts(spark, folder), LANGUAGES, key="doc_id")
    least = F.min("val_loss").over(Window.partitionBy())
    largest = table(spark, folder, "documents").groupBy("lang").count().agg(F.max("count") / F.sum("count")).first()[0]
    sound = F.lit(done.summary.first()["accuracy"] > largest)
    return done.epochs.select(
        "epoch",
        "steps",
        "rows",
        F.sum(F.col("chosen").cast("bigint")).over(Window.partitionBy()).alias("chosen_epochs"),
        (~F.col("chosen") | (F.col("val_loss") == least)).alias("least_loss_chosen"),
        sound.alias("beats_majority"),
    )


@query(
    """SELECT main_cat, array_to_string(list(price ORDER BY asin), ',') AS examples
FROM (SELECT p_type AS main_cat, CAST(p_size AS VARCHAR) AS price, CAST(p_partkey AS VARCHAR) AS asin,
             row_number() OVER (PARTITION BY p_type ORDER BY CAST(p_partkey AS VARCHAR)) AS r FROM part)
WHERE r <= 10 GROUP BY main_cat"""
)
def explore_job(spark: SparkSession, folder: str) -> DataFrame:
    raw = parts(spark, folder)
    return explore(raw, preprocess(raw))["price_examples"].withColumn("examples", F.array_join("examples", ","))
