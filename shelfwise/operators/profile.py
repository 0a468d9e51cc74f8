"""Counts, top lists, examples and text-length statistics per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.keys import digest, leading_number
from shelfwise.functions.text import token_count
from shelfwise.operators.numbering import sorted_numbers, with_row_ids
from shelfwise.schema import LABEL, TEXT
from shelfwise.scratch import sized_for_join


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def distinct_count(df: DataFrame, column: str = LABEL) -> DataFrame:
    """Distinct values, with null as a value and without.

    Distinct values are reduced before the count, so a value with most of the rows costs nothing extra.
    """
    return df.select(column).distinct().agg(
        F.count(F.lit(1)).alias("with_null"), F.count(column).alias("without_null")
    )


def approx_distinct(df: DataFrame, column: str = LABEL, error: float = 0.02) -> DataFrame:
    """Estimated distinct non-null values from a fixed-size sketch, for columns with very many."""
    return df.agg(F.approx_count_distinct(column, error).alias("without_null"))


def group_count(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*(by or (LABEL,))).agg(F.count(F.lit(1)).alias("count"))


def top_groups(df: DataFrame, k: int, by: str = LABEL) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value."""
    return group_count(df, by).orderBy(F.desc("count"), by).limit(k)


def examples(df: DataFrame, value: str, n: int, order: Sequence[str], by: str = LABEL) -> DataFrame:
    """The first ``n`` non-null values per group as one list, in the given order.

    Each task keeps ``n`` rows per group before the shuffle, so a group of any size stays small.
    """
    first = W.partitionBy(by).orderBy(*order)
    return (
        df.filter(F.col(value).isNotNull())
        .select(by, value, *[c for c in order if c not in (by, value)])
        .withColumn("__rank", F.row_number().over(first))
        .filter(F.col("__rank") <= n)
        .groupBy(by)
        .agg(F.sort_array(F.collect_list(F.struct("__rank", F.col(value).alias("__value")))).alias("__ranked"))
        .select(by, F.transform("__ranked", lambda r: r["__value"]).alias("examples"))
    )


def collected(df: DataFrame, value: str, key: str, by: str = LABEL, rows_per_piece: int = 100_000) -> DataFrame:
    """All non-null values per group, as sorted lists of about ``rows_per_piece`` values.

    A group is cut into as many pieces as its size asks for, so every value is kept and no task
    holds a large group whole. Columns: group, ``piece``, ``pieces``, ``items``.
    """
    present = df.filter(F.col(value).isNotNull()).select(by, value, key)
    sizes = present.groupBy(F.col(by).alias("__by")).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_piece).alias("pieces")
    )
    sizes = sized_for_join(sizes, "group-sizes")
    return (
        present.join(sizes, F.col(by).eqNullSafe(F.col("__by")))
        .withColumn("piece", leading_number(digest(key)) % F.col("pieces"))
        .groupBy(by, "piece", "pieces")
        .agg(F.sort_array(F.collect_list(value)).alias("items"))
    )


def collected_in_order(df: DataFrame, value: str, by: str = LABEL, rows_per_piece: int = 100_000) -> DataFrame:
    """All non-null values per group, as consecutive pieces of one sorted list.

    Rows are numbered in the order of group and value, rows that agree in both by a row id, so even one
    value in all rows is spread over tasks. Every piece but a group's last has ``rows_per_piece`` values;
    pieces in the order of their numbers (from 0) are the list. Columns: group, ``piece``, ``pieces``,
    ``items``; a group without values has no piece.
    """
    present = with_row_ids(df.filter(F.col(value).isNotNull()).select(by, value), "__row")
    numbered = sorted_numbers(present, F.asc(by), F.asc(value), F.asc("__row"), name="__number")
    groups = numbered.groupBy(F.col(by).alias("__by")).agg(
        F.min("__number").alias("__first"), F.ceil(F.count(F.lit(1)) / rows_per_piece).alias("pieces")
    )
    groups = sized_for_join(groups, "group-starts")
    return (
        numbered.join(groups, F.col(by).eqNullSafe(F.col("__by")))
        .withColumn("piece", F.floor((F.col("__number") - F.col("__first")) / rows_per_piece))
        .groupBy(by, "piece", "pieces")
        .agg(F.sort_array(F.collect_list(value)).alias("items"))
    )


def box_statistics(df: DataFrame, value: Column, by: str = LABEL) -> DataFrame:
    """Box-plot figures of an integer measure per group.

    Rows are first counted per group and value, on the map side; everything after reads that small
    table. Whiskers reach the last value within 1.5 box heights; values beyond are outliers.
    """
    counts = df.groupBy(by, value.alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    # Null measures count for nothing. They are not filtered out: such a filter would sink below the
    # count and compute the measure a second time.
    known = F.when(F.col("__value").isNotNull(), F.col("__n")).otherwise(F.lit(0))
    boxes = counts.groupBy(F.col(by).alias("__by")).agg(
        F.sum(known).alias("n"),
        F.percentile("__value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("__n")).alias("__q"),
    )
    boxes = boxes.filter(F.col("n") > 0).select(
        "__by", "n", *[F.get("__q", F.lit(i)).alias(q) for i, q in enumerate(("q1", "median", "q3"))]
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("__value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(boxes, F.col(by).eqNullSafe(F.col("__by")))
        .groupBy(by, "n", "q1", "median", "q3")
        .agg(
            # A whisker never ends inside the box.
            F.least(F.min(F.when(inside, F.col("__value"))).cast("double"), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, F.col("__value"))).cast("double"), F.col("q3")).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("__n")).otherwise(F.lit(0))).alias("outliers"),
        )
    )


def box_statistics_approx(df: DataFrame, value: Column, by: str = LABEL, accuracy: int = 10_000) -> DataFrame:
    """Quartiles from fixed-size sketches, for measures with very many distinct values."""
    quartiles = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    return (
        df.groupBy(by)
        .agg(F.count(value).alias("n"), quartiles.alias("__q"))
        .select(by, "n", *[F.get("__q", F.lit(i)).alias(q) for i, q in enumerate(("q1", "median", "q3"))])
    )


def truncation(df: DataFrame, max_length: int = 512, text: str = TEXT, by: str = LABEL) -> DataFrame:
    """Per group: rows, mean tokens and the share of rows that lose tokens to the length limit."""
    sized = df.select(by, token_count(F.col(text)).alias("__n"))
    return sized.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("__n").alias("mean_tokens"),
        F.max("__n").cast("bigint").alias("max_tokens"),
        F.avg(F.when(F.col("__n") > max_length - 2, 1.0).otherwise(0.0)).alias("truncated_share"),
    )
