"""Quantile sketches per group that are stored, merged and read as box statistics.

A sketch has a bounded size whatever its rows. Sketches of parts of a table (days, files, sources) are
stored and merged later, so a new part is read alone and old ones are never read again for quartiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.schema import LABEL
from shelfwise.scratch import sized_for_join

#: Size parameter of a sketch; see ``rank_error``.
ACCURACY = 2048
# The factor and power of the sketches' published rank error, and what a box shows.
_FACTOR, _POWER = 2.296, 0.9723
_QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))


def rank_error(accuracy: int = ACCURACY) -> float:
    """By how much the rank of a quantile may be off, as a share of the rows, in 99 of 100 cases.

    With fewer rows than ``accuracy`` quantiles are exact.
    """
    return _FACTOR / accuracy**_POWER


def value_sketches(df: DataFrame, value: Column, *by: str, accuracy: int = ACCURACY) -> DataFrame:
    """One sketch of a numeric measure per group: groups, ``n``, ``sketch``.

    Built on the map side, so a group of any size sends one sketch a task. Nulls and NaN are left out;
    a group without other values has no row.
    """
    number = value.cast("double")
    known = df.select(*by, F.when(~F.isnan(number), number).alias("__value"))
    made = known.groupBy(*by).agg(
        F.count("__value").alias("n"), F.kll_sketch_agg_double("__value", F.lit(accuracy)).alias("sketch")
    )
    return made.filter(F.col("n") > 0)


def merged_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of finer groups, or of several tables, merged to those of ``by``."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quartiles(sketches: DataFrame, by: str = LABEL) -> DataFrame:
    """Group, ``n``, ``q1``, ``median`` and ``q3`` of merged sketches: values that occur, never between two."""
    at = [F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name) for name, share in _QUARTILES]
    return sketches.select(by, "n", *at)


def sketched_boxes(df: DataFrame, value: Column, sketches: DataFrame, by: str = LABEL) -> DataFrame:
    """Box-plot figures of ``df`` with the quartiles of ``sketches``; columns as ``box_statistics`` has them.

    Whiskers and outliers come from one more pass that keeps three numbers a group and task, so
    measures with very many distinct values cost no more than others. Whiskers reach the last value
    within 1.5 box heights, and never end inside the box; rows of groups without a sketch are left out.
    """
    boxes = quartiles(merged_sketches(sketches, by), by).withColumnRenamed(by, "__by")
    boxes = sized_for_join(boxes, "boxes")
    number = value.cast("double")
    known = df.select(by, F.when(~F.isnan(number), number).alias("__value"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("__value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        known.join(boxes, F.col(by).eqNullSafe(F.col("__by")))
        .groupBy(by, "n", "q1", "median", "q3")
        .agg(
            F.least(F.min(F.when(inside, F.col("__value"))), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, F.col("__value"))), F.col("q3")).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
