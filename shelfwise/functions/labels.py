"""Label codes, names, keys and domain checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.schema import LABEL, LABELS


def _known(labels: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in labels])


def label_code(name: Column, labels: Sequence[str] = LABELS) -> Column:
    """Position of a label in the fixed list; an unknown or missing label fails the job."""
    position = F.array_position(_known(labels), name)
    return F.when(position > 0, position - 1).otherwise(
        F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(name, F.lit("null")))).cast("bigint")
    )


def label_name(code: Column, labels: Sequence[str] = LABELS) -> Column:
    """Label at a position; null outside the list."""
    return F.get(_known(labels), code.cast("int"))


def label_key(name: Column) -> Column:
    """Identifier-like form of a label."""
    # Order matters: a comma and its blank become one underscore.
    steps = (("&", "and"), (", ", "_"), (" ", "_"))
    for old, new in steps:
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def in_domain(name: Column, labels: Sequence[str] = LABELS) -> Column:
    return F.coalesce(name.isin(list(labels)), F.lit(False))


def label_encoder(labels: Sequence[str] = LABELS, source: str = LABEL, target: str = "label") -> StringIndexerModel:
    """MLlib transformer with codes in list order; an unknown label fails the job."""
    return StringIndexerModel.from_labels(list(labels), inputCol=source, outputCol=target, handleInvalid="error")


def label_decoder(labels: Sequence[str] = LABELS, source: str = "prediction", target: str = LABEL) -> IndexToString:
    return IndexToString(inputCol=source, outputCol=target, labels=list(labels))
