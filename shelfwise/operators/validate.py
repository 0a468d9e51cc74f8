"""Checks of incoming requests and outgoing labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.labels import in_domain
from shelfwise.schema import LABEL, LABELS, REQUEST

REASON = "reject_reason"


def _fault(field: T.StructField, present: bool) -> Column:
    absent = F.lit(f"{field.name} is missing")
    if not present:
        return absent
    value = F.col(f"`{field.name}`")
    fault = F.when(value.isNull(), absent)
    if isinstance(field.dataType, T.ArrayType):
        fault = fault.when(F.exists(value, lambda v: v.isNull()), F.lit(f"{field.name} holds a null"))
    return fault


def with_reason(df: DataFrame, schema: T.StructType = REQUEST) -> DataFrame:
    """Add the reasons for which a row is no complete request; null for a good row."""
    faults = [_fault(f, f.name in df.columns) for f in schema.fields]
    text = F.concat_ws("; ", *faults)
    return df.withColumn(REASON, F.when(text != "", text))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def with_domain_check(df: DataFrame, column: str = LABEL, labels: Sequence[str] = LABELS) -> DataFrame:
    """Add whether the label is one of the known ones; null counts as unknown."""
    return df.withColumn("in_domain", in_domain(F.col(column), labels))
