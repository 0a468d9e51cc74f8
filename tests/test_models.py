import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise.catalog import LANGUAGES, products, texts
from shelfwise.operators.classify import fit_margin_classifier, fit_text_classifier, load_model, save_model, score
from shelfwise.operators.features import Projection, fit_projection, fit_scale, id_features
from shelfwise.operators.sampling import with_split
from shelfwise.plans.baseline import linear_baseline
from shelfwise.operators.validate import REASON
from shelfwise.plans.predict import answer, predict
from shelfwise.plans.preprocess import preprocess
from shelfwise.plans.train import train_and_evaluate
from shelfwise.schema import KEY, LABEL, REQUEST
from shelfwise.sources.json_lines import write_json_lines
from shelfwise.sources.tables import read_table
from shelfwise.streaming.scoring import request_stream, start_answering, start_scoring, write_answers


@pytest.fixture(scope="module")
def matrix(spark):
    values = np.random.default_rng(0).normal(size=(60, 5)) * [1, 5, 0.1, 2, 0] + [3, 0, 1, -1, 7]
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(values)], "i int, v array<double>")
    return values, df.select("i", id_features(F.col("v")).alias("features")).repartition(4)


def columns(df, name):
    rows = df.select("i", vector_to_array(name).alias("v")).orderBy("i").collect()
    return np.array([r["v"] for r in rows])


def test_scaling_equals_numpy_and_keeps_constant_columns(matrix):
    values, df = matrix
    deviation = values.std(axis=0)
    expected = values / np.where(deviation > 1e-9, deviation, 1.0)
    np.testing.assert_allclose(columns(fit_scale(df).transform(df), "scaled"), expected, rtol=1e-9)


def test_projection_equals_numpy(spark, matrix, tmp_path):
    values, df = matrix
    projection = fit_projection(df, 2, "features")
    u, s, vt = np.linalg.svd(values, full_matrices=False)
    np.testing.assert_allclose(projection.values, s[:2], rtol=1e-9)
    got = columns(projection.transform(df, "features", "p"), "p")
    np.testing.assert_allclose(np.abs(got), np.abs(values @ vt[:2].T), rtol=1e-6)
    projection.save(spark, str(tmp_path / "axes"))
    again = Projection.load(spark, str(tmp_path / "axes"))
    np.testing.assert_allclose(again.axes, projection.axes)
    np.testing.assert_allclose(again.values, projection.values)


def test_width_is_checked(spark, monkeypatch, matrix):
    monkeypatch.setattr("shelfwise.operators.features.MOST_COLUMNS", 4)
    with pytest.raises(ValueError, match="columns"):
        fit_projection(matrix[1], 2, "features")


def test_margin_classifier_separates(spark):
    rows = [(float(c), [c * 4.0 + d, (c % 2) * 4.0 - d]) for c in range(3) for d in (0.0, 0.3, 0.6, 0.9)]
    df = spark.createDataFrame(rows, "label double, v array<double>").select("label", id_features(F.col("v")).alias("projected"))
    df = df.coalesce(1)
    found = fit_margin_classifier(df, strength=0.001, iterations=8).transform(df)
    assert found.filter(F.col("prediction") == F.col("label")).count() >= 10


@pytest.fixture(scope="module")
def fitted(spark, folder):
    rows = with_split(preprocess(products(spark, folder), include_key=False), KEY)
    train, val = (rows.filter(F.col("split") == s) for s in ("train", "val"))
    return fit_text_classifier(train, val, LANGUAGES, features=1 << 12, strengths=(0.1, 0.001), iterations=8)


def test_the_best_candidate_is_kept(fitted):
    rows = {r["strength"]: r["loss"] for r in fitted.scores.collect()}
    assert len(rows) == 2 and rows[fitted.strength] == min(rows.values())


def test_stream_equals_batch_and_saved_equals_fitted(spark, folder, fitted, tmp_path):
    path, source, target = (str(tmp_path / n) for n in ("model", "in", "out"))
    save_model(fitted.model, path)
    model = load_model(path)
    asked = products(spark, folder).drop(LABEL)
    broken = asked.limit(5).withColumn("asin", F.concat(F.lit("bad"), "asin")).withColumn("title", F.lit(None).cast("string"))
    batch = {r[KEY]: r[LABEL] for r in predict(asked.unionByName(broken), fitted.model, include_key=False).collect()}
    assert len(batch) == asked.count() and set(batch.values()) <= set(LANGUAGES)
    write_json_lines(asked.unionByName(broken).repartition(3), source)
    requests = request_stream(spark, source, REQUEST, files_per_batch=1)
    run = lambda: start_scoring(requests, model, target, str(tmp_path / "state"), include_key=False)
    run().awaitTermination()
    rows = read_table(spark, target).collect()
    assert len(rows) == len(batch) and {r[KEY]: r[LABEL] for r in rows} == batch
    # A second run finds nothing new.
    run().awaitTermination()
    assert read_table(spark, target).count() == len(rows)


def test_every_request_is_answered_once(spark, folder, fitted, tmp_path):
    asked = products(spark, folder).drop(LABEL)
    broken = asked.limit(5).withColumn("title", F.lit(None).cast("string"))
    everything = asked.unionByName(broken).unionByName(broken)
    good, refused = answer(everything, fitted.model, include_key=False)
    assert good.count() == asked.count() and refused.count() == 10
    assert {r[REASON] for r in refused.collect()} == {"title is missing"} and set(asked.columns) < set(refused.columns)
    empty = answer(everything.limit(0), fitted.model)
    assert empty[0].count() == empty[1].count() == 0
    source, out, bad, state = (str(tmp_path / n) for n in ("in", "out", "bad", "state"))
    everything.repartition(3).write.parquet(source)
    stream = request_stream(spark, source, everything.schema, "parquet", files_per_batch=1)
    for _ in range(2):  # the second run finds nothing new
        start_answering(stream, fitted.model, out, bad, state, include_key=False).awaitTermination()
        assert read_table(spark, out).count() == asked.count() and read_table(spark, bad).count() == 10
    first = spark.read.parquet(sorted((tmp_path / "in").glob("*.parquet"))[0].as_uri())
    for _ in range(2):  # the same batch again, whole or after one of its writes
        write_answers(first, 90, fitted.model, out, bad, include_key=False)
        found = read_table(spark, out).filter("batch = 90").count() + read_table(spark, bad).filter("batch = 90").count()
        assert found == first.count()


def test_counted_vocabulary_features(spark, folder):
    rows = with_split(texts(spark, folder), "doc_id")
    train, val = (rows.filter(F.col("split") == s) for s in ("train", "val"))
    fit = fit_text_classifier(train, val, LANGUAGES, strengths=(0.01,), iterations=3, vocabulary_size=500)
    assert score(val, fit.model, keep=("doc_id",)).columns == ["doc_id", "predicted"]


def test_training_beats_the_majority(spark, folder):
    done = train_and_evaluate(texts(spark, folder), LANGUAGES, key="doc_id", features=1 << 12, strengths=(0.01,), iterations=10)
    total = done.predictions.count()
    largest = done.predictions.groupBy("actual").count().agg(F.max("count")).first()[0]
    assert done.summary.first()["accuracy"] > largest / total
    assert done.confusion.count() == 16 and done.candidates.count() == 1
    assert done.train_labels.agg(F.sum("count")).first()[0] + total < spark.read.parquet(f"{folder}/documents.parquet").count()
    assert "weighted avg" in {r["label"] for r in done.report.collect()}


def test_linear_baseline(spark):
    chance = np.random.default_rng(1)
    rows = [(i, "ab"[i % 2], (chance.normal(size=6) + (i % 2) * 4).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "asin int, main_cat string, input_ids array<double>")
    done = linear_baseline(df, 2, 0.01, ["a", "b"], fraction=0.5, iterations=5)
    assert done.predictions.count() == 6 and done.accuracy.first()["accuracy"] >= 0.5
    assert done.report.count() >= 4 and done.confusion.count() >= 1
