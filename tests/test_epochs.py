import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.catalog import LANGUAGES, texts
from shelfwise.plans.epochs import State, epoch_means, hashed_terms, train_by_epochs


def test_run_by_hand(spark, folder, tmp_path):
    """The same steps on whole arrays, from the rows' own batches."""
    rows = texts(spark, folder)
    done = train_by_epochs(rows, LANGUAGES, key="doc_id", epochs=2, steps=3, terms=64, rate=0.1, states=str(tmp_path / "s"))
    steps = done.steps.orderBy("epoch", "batch").collect()
    assert [(r["epoch"], r["batch"], r["step"]) for r in steps] == [(e, b, 3 * (e - 1) + b) for e in (1, 2) for b in range(3)]
    first = steps[0]
    assert abs(first["loss"] - np.log(len(LANGUAGES))) < 1e-9  # nothing is known before the first step
    epochs = {r["epoch"]: r for r in done.epochs.collect()}
    assert sum(r["chosen"] for r in epochs.values()) == 1
    best = min(epochs.values(), key=lambda r: (r["val_loss"], r["epoch"]))
    assert best["chosen"]
    for e, r in epochs.items():
        mine = [s for s in steps if s["epoch"] == e]
        assert r["steps"] == 3 and r["rows"] == sum(s["n"] for s in mine)
        assert abs(r["loss"] - np.mean([s["loss"] for s in mine])) < 1e-12
    # the state that is tested is the chosen one, as stored
    stored = State.load(spark, str(tmp_path / "s"), best["epoch"])
    np.testing.assert_array_equal(stored.weights, done.state.weights)
    held = rows.select("doc_id", hashed_terms(F.col("combined_text"), 64).alias("terms"))
    held = {r["doc_id"]: r["terms"] for r in held.collect()}
    for r in done.predictions.limit(40).collect():
        terms = held[r["doc_id"]]
        raw = stored.weights[terms].sum(axis=0) / np.sqrt(max(len(terms), 1)) + stored.weights[-1]
        assert r["predicted"] == LANGUAGES[int(raw.argmax())]
    # running means and means of batches come from this run
    running = {r["step"]: r["loss"] for r in done.running.collect()}
    for step, loss in running.items():
        assert abs(loss - np.mean([s["loss"] for s in steps if s["step"] <= step])) < 1e-9
    assert epoch_means(done).first()["batches"] == 6


def test_partitioning_changes_nothing_and_odd_rows_pass(spark, folder):
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "!", "fr"), (-3, "!", "fr")], "doc_id bigint, combined_text string, main_cat string")
    rows = texts(spark, folder).select("doc_id", "combined_text", "main_cat").unionByName(odd)
    kept = []
    for parts in (1, 7):
        done = train_by_epochs(rows.repartition(parts), LANGUAGES, key="doc_id", epochs=2, steps=2, terms=128)
        kept.append((done.state.weights, {r["doc_id"]: r["predicted"] for r in done.predictions.collect()}))
    np.testing.assert_allclose(kept[0][0], kept[1][0], rtol=1e-6, atol=1e-9)
    assert kept[0][1] == kept[1][1]
    with pytest.raises(ValueError, match="fewer"):
        train_by_epochs(rows, LANGUAGES, terms=1 << 24)
