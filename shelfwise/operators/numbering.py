"""Row numbers over a whole table without a task that sees the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.keys import content, digest
from shelfwise.scratch import written

# 65,536 digest ranges. Digests of distinct keys are uniform: at 10**11 rows a range holds 1.5 million.
_RANGE_DIGITS = 4
# A range far above its even share, and large, means that one key has very many rows.
_HOT_ROWS = 1_000_000
_HOT_FACTOR = 8


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Give rows without a unique key one, fixed by writing the table once."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), "row-ids")


def shuffled_numbers(
    df: DataFrame, keys: str | Sequence[str], seed: int = 42, epoch: int = 0, name: str = "row_number"
) -> DataFrame:
    """Number rows from 1 in digest order of their key.

    Rows are ranked inside fixed digest ranges, in parallel; a range starts after the rows of the
    ranges before it. The range sizes come from a key-only scan with partial aggregation, run at once:
    a table of at most 65,536 rows whatever the data, which bounds its broadcast and the window that
    sums it. Then rows are shuffled once, evenly over the ranges.

    Rows with equal keys are numbered in the order of their content, so that numbers never depend on the
    partitioning. If the sizes show a key with very many rows, those that agree in content too are told
    apart by a row id and the rows are sorted by range instead, so that no task gets all of them; rows
    get the same numbers either way.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    hashed = digest(names, seed, epoch)
    ranged = F.substring(hashed, 1, _RANGE_DIGITS)
    sizes = written(df.groupBy(ranged.alias("__range")).agg(F.count(F.lit(1)).alias("__n")), "range-sizes")
    found = sizes.agg(F.max("__n").alias("largest"), F.sum("__n").alias("rows")).first()
    if (found["largest"] or 0) > max(_HOT_ROWS, _HOT_FACTOR * (found["rows"] or 0) / 16**_RANGE_DIGITS):
        told_apart = with_row_ids(df.withColumns({"__digest": hashed, "__content": content(df)}), "__row")
        order = [F.asc(c) for c in ("__digest", *names, "__content", "__row")]
        return sorted_numbers(told_apart, *order, name=name).drop("__digest", "__content", "__row")
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = W.partitionBy("__range").orderBy("__digest", *names, "__content")
    return (
        df.withColumns({"__digest": hashed, "__range": ranged, "__content": content(df)})
        .withColumn("__inside", F.row_number().over(inside))
        .join(F.broadcast(starts), "__range")
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop("__digest", "__content", "__range", "__inside", "__start")
    )


def sorted_numbers(df: DataFrame, *order: Column, name: str = "row_number") -> DataFrame:
    """Number rows from 1 in the order of columns that identify a row.

    Range partitions are sorted and written once; the position inside a partition comes from
    Spark's own monotonic ids and the start of a partition from the sizes of those before it. The
    table of starts has one row per partition, which bounds its broadcast.
    """
    position = F.monotonically_increasing_id()
    fixed = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__position", position), "sorted"
    )
    # Documented layout: partition in the upper 31 bits, position in the lower 33.
    split = fixed.withColumn("__part", F.shiftright("__position", 33)).withColumn(
        "__inside", F.col("__position").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        split.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    return (
        split.join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + F.col("__inside") + 1)
        .drop("__position", "__part", "__inside", "__start")
    )


def batches(
    df: DataFrame, keys: str | Sequence[str], size: int, seed: int = 42, epoch: int = 0, name: str = "batch"
) -> DataFrame:
    """Number mini-batches of ``size`` rows from 0 over the shuffled order; the last may be short."""
    numbered = shuffled_numbers(df, keys, seed, epoch, "__number")
    return numbered.withColumn(name, F.floor((F.col("__number") - 1) / size)).drop("__number")
