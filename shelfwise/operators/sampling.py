"""Repeatable shuffles, samples and splits keyed by row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.keys import content, cut_point, digest
from shelfwise.operators.numbering import shuffled_numbers
from shelfwise.scratch import written

_DIGEST_LENGTH = 32
_STEP = 4

# The shares of the nested 80/20 split.
SHARES = (("train", 0.64), ("val", 0.16), ("test", 0.20))


def shuffled(df: DataFrame, keys: str | Sequence[str], seed: int = 42, epoch: int = 0) -> DataFrame:
    """Rows in a pseudo-random order that differs by epoch and never by partitioning.

    Rows with equal keys are ordered by their content.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.orderBy(digest(names, seed, epoch), *names, content(df))


def sample_share(
    df: DataFrame, fraction: float, keys: str | Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Each row with probability ``fraction``; 1.0 or more keeps the table as it is.

    With a key the same rows come back on any partitioning; without one this is Spark's own sample.
    A filter only: no shuffle.
    """
    if fraction >= 1.0:
        return df
    if keys is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(digest(keys, seed) < cut_point(fraction))


def split_name(hashed: Column, shares: Sequence[tuple[str, float]] = SHARES) -> Column:
    """The split a digest falls into; the last one takes the rest."""
    reached, name = 0.0, None
    for split, share in shares[:-1]:
        reached += share
        inside = hashed < cut_point(reached)
        name = F.when(inside, split) if name is None else name.when(inside, split)
    last = F.lit(shares[-1][0])
    return last if name is None else name.otherwise(last)


def with_split(
    df: DataFrame,
    keys: str | Sequence[str],
    shares: Sequence[tuple[str, float]] = SHARES,
    seed: int = 42,
    target: str = "split",
) -> DataFrame:
    """Add the split of each row. A projection only: disjoint, complete and repeatable."""
    if not math.isclose(sum(s for _, s in shares), 1.0, abs_tol=1e-9):
        raise ValueError("shares must add up to 1")
    return df.withColumn(target, split_name(digest(keys, seed), shares))


class KeyNotUnique(ValueError):
    """Several rows share the key at which a table was to be cut."""


def exact_cuts(df: DataFrame, hashed: Column, sizes: Sequence[int]) -> list[str]:
    """For each size, the digest up to which exactly that many rows fall.

    A selection instead of a sort: each round counts rows per digest prefix (partial aggregation over
    key columns only, at most 65,536 groups per cut) and fetches one row per cut, then narrows to
    that prefix. 10**9 rows need two or three rounds. No row of the table moves.
    """
    cuts: dict[int, str] = {}
    open_cuts: dict[int, tuple[str, int]] = {s: ("", s) for s in set(sizes) if s > 0}
    digests = df.select(hashed.alias("__digest"))
    for width in range(_STEP, _DIGEST_LENGTH + 1, _STEP):
        if not open_cuts:
            break
        parents = {p for p, _ in open_cuts.values()}
        parent = F.substring("__digest", 1, width - _STEP)
        counts = (
            digests.filter(parent.isin(list(parents)))
            .groupBy(parent.alias("__parent"), F.substring("__digest", 1, width).alias("__prefix"))
            .agg(F.count(F.lit(1)).alias("__n"))
        )
        upto = W.partitionBy("__parent").orderBy("__prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
        reached = counts.withColumn("__upto", F.sum("__n").over(upto))
        hit = F.lit(False)
        for prefix, rest in open_cuts.values():
            hit = hit | (
                (F.col("__parent") == prefix)
                & (F.col("__upto") >= rest)
                & (F.col("__upto") - F.col("__n") < rest)
            )
        rows = reached.filter(hit).collect()
        narrowed = {}
        for size, (prefix, rest) in open_cuts.items():
            row = next(
                (r for r in rows if r["__parent"] == prefix and r["__upto"] - r["__n"] < rest <= r["__upto"]), None
            )
            if row is None:
                raise ValueError(f"the table has fewer than {size} rows")
            if rest == row["__n"] + (row["__upto"] - row["__n"]):
                # The cut lies at the end of this prefix; 'g' follows every hex digit.
                cuts[size] = row["__prefix"] + "g"
            else:
                narrowed[size] = (row["__prefix"], rest - (row["__upto"] - row["__n"]))
        open_cuts = narrowed
    if open_cuts:
        raise KeyNotUnique("rows with equal keys cannot be cut apart by key")
    return [cuts.get(s, "") for s in sizes]


def _exact_classes(
    df: DataFrame, keys: str | Sequence[str], seed: int, sizes: Sequence[int]
) -> tuple[DataFrame, list[Column]]:
    """The table and one condition per size, true for exactly that many of its rows in digest order.

    With a unique key the conditions compare digests and the table stays as it is. Where equal keys
    straddle a cut, rows are numbered and written once, so that later readers agree on them.
    """
    hashed = digest(keys, seed)
    try:
        return df, [hashed < cut for cut in exact_cuts(df, hashed, sizes)]
    except KeyNotUnique:
        fixed = written(shuffled_numbers(df, keys, seed, name="__number"), "numbered")
        return fixed, [F.col("__number") <= size for size in sizes]


def sample_exact(df: DataFrame, fraction: float, keys: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``round(fraction * rows)`` rows, the first ones in digest order."""
    rows, [taken] = _exact_classes(df, keys, seed, [round(fraction * df.count())])
    return rows.filter(taken).select(*df.columns)


def with_exact_split(
    df: DataFrame,
    keys: str | Sequence[str],
    test_share: float = 0.2,
    val_share: float | None = 0.2,
    seed: int = 42,
    target: str = "split",
) -> DataFrame:
    """Add the split so that sizes are exact.

    ``ceil(test_share * rows)`` rows are test, then ``ceil(val_share * rest)`` are validation; the
    others train. ``val_share=None`` makes train and test only.
    """
    total = df.count()
    test = math.ceil(test_share * total)
    val = math.ceil(val_share * (total - test)) if val_share is not None else 0
    rows, [in_test, in_val] = _exact_classes(df, keys, seed, [test, test + val])
    name = F.when(in_test, "test")
    if val_share is not None:
        name = name.when(in_val, "val")
    return rows.withColumn(target, name.otherwise("train")).select(*df.columns, target)
