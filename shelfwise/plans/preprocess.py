"""Records to model input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfwise.operators.encode import encode
from shelfwise.operators.project import keep_columns, text_and_label, with_text
from shelfwise.schema import KEPT


def preprocess(
    df: DataFrame,
    style: str = "flat",
    vocabulary: DataFrame | None = None,
    include_key: bool = True,
    columns: Sequence[str] | None = KEPT,
    max_length: int = 512,
    level: str = "piece",
) -> DataFrame:
    """Keep the wanted columns, combine the text and, with a vocabulary, encode it.

    The row key stays beside the text, so that samples and splits can be repeated. The label is
    optional. Without a vocabulary this is one projection on top of the scan.
    """
    text = text_and_label(with_text(keep_columns(df, columns), style, include_key))
    if vocabulary is None:
        return text
    return encode(text, vocabulary, max_length, level)
