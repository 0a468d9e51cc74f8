"""Requests to predicted labels, as a table or a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from shelfwise.operators.classify import score
from shelfwise.operators.project import keep_columns, with_text
from shelfwise.operators.validate import accepted, rejected, with_reason
from shelfwise.schema import KEPT, KEY, LABEL


def request_text(requests: DataFrame, include_key: bool = True) -> DataFrame:
    """Accepted requests with their text in the format used for training."""
    kept = keep_columns(accepted(with_reason(requests)), [c for c in KEPT if c != LABEL])
    return with_text(kept, "flat", include_key)


def predict(requests: DataFrame, model: PipelineModel, include_key: bool = True) -> DataFrame:
    """``asin, main_cat`` for each accepted request; one pass, no shuffle."""
    found = score(request_text(requests, include_key), model, keep=(KEY,))
    return found.withColumnRenamed("predicted", LABEL)


def answer(requests: DataFrame, model: PipelineModel, include_key: bool = True) -> tuple[DataFrame, DataFrame]:
    """Predictions of the accepted requests, and the rejected ones, whole, with their reasons.

    Every request is in one of the two tables, as often as it was asked.
    """
    return predict(requests, model, include_key), rejected(with_reason(requests))
