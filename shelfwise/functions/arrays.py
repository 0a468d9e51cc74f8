"""Array and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element(items: Column, index: int) -> Column:
    """The element at a position counted from 0; null outside the array."""
    return F.get(items, F.lit(index))


def head(items: Column, n: int) -> Column:
    """At most the first ``n`` elements."""
    return F.slice(items, 1, n)


def argmax(scores: Column) -> Column:
    """Position of the greatest score counted from 0; the first one wins a tie."""
    return F.array_position(scores, F.array_max(scores)) - F.lit(1).cast("bigint")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where ``whole`` is 0 or null."""
    zero = F.lit(0.0).cast("double")
    return F.when(F.coalesce(whole, F.lit(0)) == 0, zero).otherwise(part.cast("double") / whole)


def percent(share: Column) -> Column:
    return share * F.lit(100)
