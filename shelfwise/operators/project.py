"""Projections of item records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import combine_flat, combine_listed
from shelfwise.schema import KEPT, KEY, LABEL, TEXT


def keep_columns(df: DataFrame, wanted: Sequence[str] | None = KEPT) -> DataFrame:
    """The wanted columns that exist, in the wanted order; ``None`` keeps everything."""
    if wanted is None:
        return df
    return df.select(*[c for c in wanted if c in df.columns])


def with_text(df: DataFrame, style: str = "flat", include_key: bool = True, target: str = TEXT) -> DataFrame:
    """Add the combined text.

    ``flat`` flattens arrays (one format for training and serving), ``listed`` prints arrays as
    lists, ``spaced`` joins by blanks. ``include_key=False`` leaves the record id out of the text.
    """
    names = [c for c in df.columns if c != LABEL and (include_key or c != KEY)]
    if style == "listed":
        return df.withColumn(target, combine_listed(df, names))
    if style not in ("flat", "spaced"):
        raise ValueError(f"unknown text style {style}")
    return df.withColumn(target, combine_flat(*names, separator=" " if style == "spaced" else " | "))


def text_and_label(df: DataFrame, keys: Sequence[str] = (KEY,), text: str = TEXT) -> DataFrame:
    """Row key, combined text and label; a missing key or label column is left out."""
    return df.select(*[c for c in (*keys, text, LABEL) if c in df.columns])


def without(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def with_label(df: DataFrame, label: str, column: str = LABEL) -> DataFrame:
    """Rows of one label; the comparison reaches the scan."""
    return df.filter(F.col(column) == label)
