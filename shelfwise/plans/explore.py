"""Tables that describe a set of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import word_count
from shelfwise.operators.profile import (
    box_statistics,
    distinct_count,
    examples,
    group_count,
    row_count,
    truncation,
)
from shelfwise.schema import KEY, LABEL, TEXT


def explore(raw: DataFrame, texts: DataFrame, max_length: int = 512) -> dict[str, DataFrame]:
    """Lazy tables about raw records and their combined texts; only what is used is computed."""
    tables = {
        "rows": row_count(raw),
        "distinct_labels": distinct_count(raw),
        "label_counts": group_count(raw).orderBy(LABEL),
        "word_boxes": box_statistics(texts, word_count(F.col(TEXT))),
        "truncation": truncation(texts, max_length),
    }
    for column, n in ((KEY, 2), ("price", 10), ("image", 10)):
        if column in raw.columns:
            tables[f"{column}_examples"] = examples(raw, column, n, [KEY])
    return tables
