"""Sample, split, fit, choose and evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.classify import fit_text_classifier
from shelfwise.operators.metrics import confusion, report, summary
from shelfwise.operators.profile import group_count
from shelfwise.operators.sampling import sample_share, with_split
from shelfwise.schema import KEY, LABEL, LABELS, TEXT


@dataclass(frozen=True)
class Training:
    """The chosen model and its result tables."""

    model: PipelineModel
    candidates: DataFrame
    predictions: DataFrame
    summary: DataFrame
    confusion: DataFrame
    report: DataFrame
    train_labels: DataFrame


def train_and_evaluate(
    df: DataFrame,
    labels: Sequence[str] = LABELS,
    key: str = KEY,
    text: str = TEXT,
    label: str = LABEL,
    fraction: float = 1.0,
    seed: int = 42,
    **fit_options,
) -> Training:
    """Train on 64 % of the rows, choose on 16 %, test on 20 %.

    Splits are filters on a key digest, so nothing is shuffled or stored for them.
    """
    rows = with_split(sample_share(df, fraction, key, seed), key, seed=seed)
    train, val, test = (rows.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
    fitted = fit_text_classifier(train, val, labels, text, label, **fit_options)
    tested = fitted.model.transform(test).select(key, F.col(label).alias("actual"), "predicted")
    return Training(
        model=fitted.model,
        candidates=fitted.scores,
        predictions=tested,
        summary=summary(tested),
        confusion=confusion(tested, labels=labels),
        report=report(tested),
        train_labels=group_count(train, label),
    )
