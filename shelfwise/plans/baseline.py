"""Linear baselines on encoded ids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.labels import label_name
from shelfwise.operators.classify import with_code
from shelfwise.operators.features import fit_projection, fit_scale, id_features
from shelfwise.operators.margins import fit_margins
from shelfwise.operators.metrics import accuracy, confusion, report
from shelfwise.operators.sampling import sample_exact, with_exact_split
from shelfwise.schema import KEY, LABEL, LABELS

# Projected width, penalty and scheme of the two baselines.
MARGIN = {"components": 2, "strength": None, "scheme": "pairs"}
HINGE = {"components": 100, "strength": 1e-4, "scheme": "rest"}


@dataclass(frozen=True)
class Baseline:
    predictions: DataFrame
    accuracy: DataFrame
    confusion: DataFrame
    report: DataFrame


def linear_baseline(
    encoded: DataFrame,
    components: int = 2,
    strength: float | None = None,
    labels: Sequence[str] = LABELS,
    key: str = KEY,
    label: str = LABEL,
    ids: str = "input_ids",
    fraction: float = 1.0,
    test_share: float = 0.2,
    seed: int = 42,
    iterations: int = 50,
    scheme: str = "rest",
) -> Baseline:
    """Sample, split, scale, project, fit and test, as for any encoded table.

    The mask is not used. The projected training rows, a few numbers each, are written once for the
    fits; all labels (``scheme`` ``rest``) or pairs of labels (``pairs``) are fitted together.
    """
    rows = encoded.select(key, label, ids)
    if fraction < 1.0:
        rows = sample_exact(rows, fraction, key, seed)
    coded = with_code(with_exact_split(rows, key, test_share, None, seed), labels, label)
    vectors = coded.select(key, label, "label", "split", id_features(F.col(ids)).alias("features"))
    train = vectors.filter(F.col("split") == "train")
    scale = fit_scale(train)
    scaled = scale.transform(train)
    projection = fit_projection(scaled, components)
    model = fit_margins(projection.transform(scaled), len(labels), "projected", "label", scheme, strength, iterations)
    test = projection.transform(scale.transform(vectors.filter(F.col("split") == "test")))
    tested = model.transform(test).select(
        key, F.col(label).alias("actual"), label_name(F.col("prediction"), labels).alias("predicted")
    )
    return Baseline(tested, accuracy(tested), confusion(tested), report(tested))
