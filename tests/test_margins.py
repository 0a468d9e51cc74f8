import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from shelfwise.operators.features import id_features
from shelfwise.operators.margins import ROUNDED, Margins, fit_margins


def frame(spark, labels, values):
    rows = [(None if c is None else int(c), None if v is None else [float(x) for x in v]) for c, v in zip(labels, values)]
    df = spark.createDataFrame(rows, "label int, v array<double>")
    return df.select("label", F.when(F.col("v").isNotNull(), id_features(F.coalesce("v", F.array(F.lit(0.0))))).alias("projected"))


def objective(weights, x, side, strength):
    return np.maximum(1 - side * (x @ weights[:-1] + weights[-1]), 0).mean() + strength / 2 * (weights[:-1] ** 2).sum()


@pytest.fixture(scope="module")
def clouds():
    chance = np.random.default_rng(3)
    labels = chance.integers(0, 4, 400)
    centres = np.array([[0, 0, 0], [3, 0, 1], [0, 3, 0], [3, 3, 2]])
    return labels, centres[labels] + chance.normal(size=(400, 3))


@pytest.mark.parametrize("strength", [0.01, None])
def test_objectives_are_as_low_as_mllib_finds_them(spark, clouds, strength):
    labels, x = clouds
    df = frame(spark, labels, x).coalesce(2)
    found = fit_margins(df, 4, strength=strength, iterations=25)
    weight = strength or 1 / len(labels)
    for c in (3,):
        one = LinearSVC(featuresCol="projected", regParam=weight, maxIter=40, standardization=False)
        model = one.fit(df.withColumn("label", (F.col("label") == c).cast("double")))
        theirs = objective(np.append(model.coefficients.toArray(), model.intercept), x, np.where(labels == c, 1, -1), weight)
        ours = objective(found.weights[c], x, np.where(labels == c, 1, -1), weight)
        assert ours <= 1.02 * theirs + ROUNDED
    assert (np.diff(found.history, axis=0) <= 1e-12).all()


def test_pairs_see_their_own_rows(spark, clouds):
    labels, x = clouds
    df = frame(spark, labels, x).coalesce(2)
    found = fit_margins(df, 5, scheme="pairs", strength=0.01)
    assert list(zip(found.first.tolist(), found.second.tolist())) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
    mine = (labels == 1) | (labels == 3)
    alone = fit_margins(frame(spark, np.where(labels[mine] == 1, 0, 1), x[mine]), 2, scheme="pairs", strength=0.01)
    side = np.where(labels[mine] == 1, 1, -1)
    a, b = (objective(w, x[mine], side, 0.01) for w in (found.weights[4], alone.weights[0]))
    assert abs(a - b) < 1e-3
    scored = found.transform(df)
    assert scored.filter(F.col("prediction") == F.col("label")).count() > 0.8 * len(labels)
    votes = np.array([[sum((found.weights[p, :-1] @ r + found.weights[p, -1] >= 0) == (c == f) for p, (f, s) in enumerate(zip(found.first, found.second)) if c in (f, s)) for c in range(5)] for r in x[:50]])
    assert found.decide(x[:50]).tolist() == votes.argmax(axis=1).tolist()


def test_one_job_an_iteration(spark, clouds):
    labels, x = clouds
    df = frame(spark, labels, x).coalesce(2)
    context = spark.sparkContext
    jobs = []
    for iterations in (2, 4):
        context.setJobGroup(f"margins-{iterations}", "")
        fit_margins(df, 4, scheme="pairs", iterations=iterations, tolerance=0)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"margins-{iterations}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    # adaptive execution runs the exchange of the one reduction as a job of its own
    assert jobs[1] - jobs[0] <= 2 * 2


def test_odd_input(spark, clouds, tmp_path, monkeypatch):
    labels, x = clouds
    df = frame(spark, [*labels, None, 2], [*x, x[0], None]).repartition(20)
    found = fit_margins(df, 4, strength=0.01, iterations=5)
    same = fit_margins(frame(spark, labels, x).coalesce(1), 4, strength=0.01, iterations=5)
    np.testing.assert_allclose(found.weights, same.weights, rtol=1e-6)
    assert found.transform(df).filter("prediction IS NULL").count() == 1
    found.save(spark, str(tmp_path / "m"))
    again = Margins.load(spark, str(tmp_path / "m"))
    assert again.decide(x).tolist() == found.decide(x).tolist()
    lonely = fit_margins(frame(spark, [2, 2], x[:2]), 4, scheme="pairs", iterations=3)
    assert lonely.decide(x[:5]).tolist() == [2] * 5
    with pytest.raises(ValueError, match="no rows"):
        fit_margins(df.limit(0), 4)
    with pytest.raises(ValueError, match="codes"):
        fit_margins(df, 2)
    with pytest.raises(ValueError, match="scheme"):
        fit_margins(df, 4, scheme="all")
    monkeypatch.setattr("shelfwise.operators.margins.MOST_CELLS", 10)
    with pytest.raises(ValueError, match="problems"):
        fit_margins(df, 4)
