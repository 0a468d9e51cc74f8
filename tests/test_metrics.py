import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import metrics

LABELS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def pairs():
    """Mostly one label; ``d`` is only predicted, ``c`` never."""
    chance = random.Random(2)
    actual = ["a"] * 120 + ["b"] * 50 + ["c"] * 10
    return [(i, y, chance.choice([y if y != "c" else "a", "b", "d"])) for i, y in enumerate(actual)]


@pytest.fixture(scope="module")
def df(spark, pairs):
    return spark.createDataFrame(pairs, "id int, actual string, predicted string")


def by_hand(pairs, label):
    hits = sum(y == p == label for _, y, p in pairs)
    named = sum(p == label for _, _, p in pairs)
    support = sum(y == label for _, y, _ in pairs)
    precision, recall = (hits / named if named else 0.0), (hits / support if support else 0.0)
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return precision, recall, f1, support


def test_scores_per_label(df, pairs):
    found = {r["label"]: r for r in metrics.label_scores(df).collect()}
    assert set(found) == set(LABELS)
    for label in LABELS:
        got = found[label]
        assert (got["precision"], got["recall"], got["f1"], got["support"]) == pytest.approx(by_hand(pairs, label))


def test_summary_and_report(df, pairs):
    each = [by_hand(pairs, n) for n in LABELS]
    weighted = [sum(e[i] * e[3] for e in each) / len(pairs) for i in range(3)]
    right = sum(y == p for _, y, p in pairs) / len(pairs)
    got = metrics.summary(df).first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"]) == pytest.approx((right, *weighted))
    assert metrics.accuracy(df).first()["accuracy"] == pytest.approx(right)
    lines = {r["label"]: r for r in metrics.report(df).collect()}
    assert lines["macro avg"]["f1"] == pytest.approx(sum(e[2] for e in each) / 4)
    assert lines["weighted avg"]["precision"] == pytest.approx(weighted[0])
    assert lines["accuracy"]["support"] == len(pairs) and len(lines) == 7


@pytest.mark.parametrize("labels", [None, [*LABELS, "never"]])
def test_confusion_covers_every_pair(df, pairs, labels):
    cells = {(r["actual"], r["predicted"]): r for r in metrics.confusion(df, labels=labels).collect()}
    known = labels or LABELS
    assert len(cells) == len(known) ** 2
    for y in known:
        row = [cells[y, p] for p in known]
        assert [r["n"] for r in row] == [sum((a, b) == (y, p) for _, a, b in pairs) for p in known]
        total = sum(r["n"] for r in row)
        assert sum(r["share"] for r in row) == pytest.approx(1.0 if total else 0.0)
        assert sum(r["percent"] for r in row) == pytest.approx(100.0 if total else 0.0)


def test_short_last_batch_weighs_as_much(spark):
    rows = [(0, "a", "a")] * 4 + [(1, "a", "b")]
    df = spark.createDataFrame(rows, "batch int, actual string, predicted string")
    got = metrics.mean_of_batches(metrics.batch_scores(df), "accuracy").first()
    assert (got["batches"], got["accuracy"]) == (2, 0.5)


@pytest.mark.parametrize("steps", [1, 100, 101, 730])
def test_running_means_across_chunks(spark, steps):
    chance = random.Random(steps)
    losses = [chance.random() for _ in range(steps)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(losses)], "batch long, loss double").repartition(6)
    got = metrics.running_means(df, "loss", every=100, blocks_per_chunk=2).orderBy("step").collect()
    ends = sorted({*range(99, steps, 100), steps - 1})
    assert [r["step"] for r in got] == ends
    assert [r["loss"] for r in got] == pytest.approx([sum(losses[: e + 1]) / (e + 1) for e in ends])


def test_cross_entropy(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.5], 1), ([1000.0, 0.0, 0.0], 0)], "s array<double>, y int")
    got = [r[0] for r in df.select(metrics.cross_entropy(metrics.softmax_at(F.col("s"), F.col("y")))).collect()]
    whole = sum(math.exp(v) for v in (1.0, 2.0, 0.5))
    assert got == pytest.approx([-math.log(math.exp(2.0) / whole), 0.0])


def test_best_candidate(spark):
    rows = [(1, 0.5), (2, 0.3), (3, 0.3), (4, float("nan")), (5, None)]
    df = spark.createDataFrame(rows, "candidate int, loss double")
    assert metrics.best_candidate(df).first()["candidate"] == 2


def test_rows_without_probability_have_no_loss(spark):
    df = spark.createDataFrame([(0.5,), (None,), (0.0,)], "p double")
    losses = [r[0] for r in df.select(metrics.cross_entropy(F.col("p"))).collect()]
    assert losses[1] is None and abs(losses[0] - 0.6931471805599453) < 1e-12 and losses[2] > 34
