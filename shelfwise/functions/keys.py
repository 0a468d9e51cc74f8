"""Digests of row keys: the one source of randomness.

A digest depends on the seed and the key columns only, never on partitions or task attempts, so
samples, splits and shuffles repeat after a repartition, a retry or a lost executor. The digest is
a hex text whose text order is its number order; shares become plain comparisons with a constant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 8


def digest(keys: str | Sequence[str], seed: int = 42, epoch: int = 0) -> Column:
    """Hex digest of the key columns of a row.

    A null key differs from an empty one. In composite keys each part carries its length, so that
    parts of different lengths never run into each other.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    parts = [F.col(n).cast("string") for n in names]
    if len(parts) > 1:
        sized = [F.concat(F.char_length(p).cast("string"), F.lit(":"), p) for p in parts]
        parts = [F.coalesce(p, F.lit("-")) for p in sized]
    # concat_ws leaves a null out with its separator
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(epoch)), *parts))


def content(df: DataFrame) -> Column:
    """A 64-bit hash of all columns of a row that can be hashed, which orders rows with equal keys.

    Rows with equal content can stand for each other. Maps and variants cannot be hashed and are left out.
    """
    columns = [F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    # the hash skips nulls, so (null, 1) would equal (1, null)
    return F.xxhash64(*columns, F.array(*[c.isNull() for c in columns]))


def cut_point(share: float) -> str:
    """The hex text below which a ``share`` of all digests falls."""
    if not 0.0 <= share <= 1.0:
        raise ValueError(f"share {share} is not between 0 and 1")
    steps = round(share * 16**DIGITS)
    # 'g' follows every hex digit, so the whole share takes every row.
    return "g" if steps == 16**DIGITS else f"{steps:0{DIGITS}x}"


def leading_number(hashed: Column, digits: int = DIGITS) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")
