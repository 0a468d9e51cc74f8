"""Folds of documents by a checksum of their ids, and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: str, folds: int) -> Column:
    """CRC-32 of the key as text, modulo ``folds``; a null key is the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


#: Labels whose shares may be listed in the plan.
MOST_LABELS = 200


def bounded_sample(rows: DataFrame, label: str, key: str, most_rows: int) -> DataFrame:
    """About ``most_rows`` rows of each label (all rows of smaller ones), chosen by a hash of the key.

    The labels' shares are written into the filter, so no row is moved; over ``MOST_LABELS`` labels
    are an error.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("n")).limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"over {MOST_LABELS} labels: the model would outgrow what may be sent to tasks")
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(7), key), 11).cast("double") / F.lit(float(2**53))
    chosen = F.lit(False)
    for r in counts:
        chosen = chosen | ((F.col(label) == F.lit(r[label])) & (drawn < most_rows / r["n"]))
    return rows.filter(chosen)


def row_key() -> Column:
    """A hash of a document's id and text: the same for repeated rows only."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` with all columns, but for the rows whose key is in ``gone`` (``row_key``)."""
    return docs.join(gone, F.xxhash64(docs["doc_id"], docs["text"]) == gone["row_key"], "left_anti")
