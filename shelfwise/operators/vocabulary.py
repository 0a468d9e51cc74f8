"""Vocabularies: ``(token, id)`` tables, built by Spark or read from a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import folded, rough_words, tokens
from shelfwise.operators.numbering import sorted_numbers
from shelfwise.schema import TEXT
from shelfwise.scratch import written

PAD, UNKNOWN, START, END = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
SPECIAL = (PAD, UNKNOWN, START, END)
CONTINUES = "##"
# Fixed value: longer words are unknown in the word-piece scheme.
LONGEST_WORD = 100


def token_counts(df: DataFrame, text: str = TEXT, min_count: int = 1) -> DataFrame:
    """``(token, n)``; tasks count before the shuffle, so frequent tokens travel once per task."""
    return (
        df.select(F.explode(tokens(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )


def ranked(counts: DataFrame, max_size: int | None = None) -> DataFrame:
    """``(token, n, id)`` in descending frequency, ids after the special tokens.

    ``max_size`` is the size of the vocabulary, special tokens included. Ranks come from a parallel
    range sort of the counted tokens, a table far smaller than the texts. A sort with a limit would
    send up to ``max_size`` rows of every task to a single one.
    """
    numbered = sorted_numbers(counts, F.desc("n"), F.asc("token"), name="__rank")
    if max_size is not None:
        numbered = numbered.filter(F.col("__rank") <= max_size - len(SPECIAL))
    first = len(SPECIAL) - 1
    return numbered.select("token", "n", (F.col("__rank") + first).cast("bigint").alias("id"))


def _with_special(spark: SparkSession, entries: DataFrame) -> DataFrame:
    special = spark.createDataFrame(list(zip(SPECIAL, range(len(SPECIAL)))), "token string, id bigint")
    return written(special.unionByName(entries.select("token", "id")), "vocabulary")


def word_vocabulary(
    df: DataFrame, text: str = TEXT, min_count: int = 1, max_size: int | None = None
) -> DataFrame:
    """``(token, id)`` of words, written once so that every later use sees the same ids."""
    return _with_special(df.sparkSession, ranked(token_counts(df, text, min_count), max_size))


def folded_word_counts(df: DataFrame, text: str = TEXT) -> DataFrame:
    """``(word, n)`` as the encoder sees texts: split into its words, these without case and accents.

    Words are counted as they stand first; only distinct ones are folded.
    """
    split = df.select(F.explode(rough_words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return split.select(folded(F.col("word")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))


def piece_counts(df: DataFrame, text: str = TEXT, longest: int = 6) -> DataFrame:
    """``(token, n)`` of candidate word pieces of the encoder's words; distinct words are written once.

    Whole words, every run of at most ``longest`` characters at the start of a word, and every such
    run further in, marked as continuing. Candidates come from distinct words and carry their count.
    Every character is a candidate in both forms, with a count of 0 in a form that does not occur, so
    that any word of known characters can be cut.
    """
    # A word grows some fifty-fold here: spread the words by number, not by their present size. They are written
    # before any is left out, since a condition on folded words would move to where texts are split, and fold all.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = written(folded_word_counts(df, text).repartition(spread), "folded-words").filter(F.length("word").between(1, LONGEST_WORD))
    size, at, length = F.length("word"), F.col("at"), F.col("length")
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest), size - at + 1))
    other = F.array(F.lit(None).cast("int"))  # stands for the other form of the character
    mark = F.when((at > 1) == length.isNotNull(), F.lit(CONTINUES)).otherwise(F.lit(""))
    runs = (
        words.select("word", "n", F.explode(F.sequence(F.lit(1), size)).alias("at"))
        .select("word", "n", "at", F.explode(F.concat(lengths, other)).alias("length"))
        .select(
            F.when(length.isNull(), 0).otherwise(F.col("n")).cast("bigint").alias("n"),
            F.concat(mark, F.substr(F.col("word"), at, F.coalesce(length, F.lit(1)))).alias("token"),
        )
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )
    # A longer word is no run of any other (``#`` stands alone), so it is counted already.
    return runs.unionByName(words.filter(size > longest).select(F.col("word").alias("token"), "n"))


def _most_frequent(counts: DataFrame, size: int, always: Column) -> DataFrame:
    """Rows of ``always`` and at least the ``size`` others of highest ``n``, all with ``n`` above those left out.

    Counts are sorted into at most a few hundred steps, of which the driver sees how many rows each has.
    """
    step = F.floor(8 * F.log2(F.col("n") + 1))
    sizes = {r["step"]: r["count"] for r in counts.filter(~always).groupBy(step.alias("step")).count().collect()}
    least, held = 0, 0
    for least in sorted(sizes, reverse=True):
        held += sizes[least]
        if held >= size:
            break
    return counts.filter(always | (step >= least))


def piece_vocabulary(
    df: DataFrame, text: str = TEXT, max_size: int | None = 30_522, longest: int = 6
) -> DataFrame:
    """``(token, id)`` of word pieces: all single characters, then the others by frequency.

    Characters are kept whatever ``max_size`` says, which bounds the others; so no word that the
    vocabulary was counted on (up to the encoder's longest) is unknown to it.
    """
    single = F.length(F.regexp_replace("token", f"^{CONTINUES}(?=.)", "")) == 1
    counts = written(piece_counts(df, text, longest).withColumn("single", single), "piece-counts")
    if max_size is not None:
        counts = _most_frequent(counts, max_size, F.col("single"))
    numbered = sorted_numbers(counts, F.desc("single"), F.desc("n"), F.asc("token"), name="__rank")
    if max_size is not None:
        numbered = numbered.filter(F.col("single") | (F.col("__rank") <= max_size - len(SPECIAL)))
    first = len(SPECIAL) - 1
    return _with_special(df.sparkSession, numbered.select("token", (F.col("__rank") + first).cast("bigint").alias("id")))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(token, id)`` from a file with one token per line, the line number from 0 being the id.

    This is how trained word-piece vocabularies are shipped; a vocabulary is one small file, and a path
    that holds several is refused, as their ids would overlap.
    """
    lines = spark.read.text(path, wholetext=True)
    if lines.count() != 1:
        raise ValueError(f"{path} is not one vocabulary file")
    listed = F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")
    return lines.select(F.posexplode(listed).alias("id", "token")).select("token", F.col("id").cast("bigint"))


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    vocabulary.write.mode("overwrite").parquet(path)
