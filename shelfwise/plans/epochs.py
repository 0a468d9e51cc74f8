"""Training by epochs of mini-batches, with a stored state per epoch and a choice by validation loss.

The model is a multinomial logistic regression on hashed terms. Every epoch deals the training rows
into mini-batches by a shuffle of its own; a step is one aggregation over the rows of one batch, which
are found by their folder. The state goes on from step to step and from epoch to epoch, is written
after each epoch, and the best one is read back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.labels import label_code, label_name
from shelfwise.functions.text import tokens
from shelfwise.operators.metrics import best_candidate, mean_of_batches, running_means, summary
from shelfwise.operators.numbering import batches
from shelfwise.operators.sampling import with_split
from shelfwise.operators.sums import array_sum
from shelfwise.schema import KEY, LABEL, LABELS, TEXT
from shelfwise.scratch import scratch_path, written

#: The state is sent to the tasks at each step: labels times terms at most, 64 MB.
MOST_CELLS = 1 << 23
_DECAY, _FLOOR = 0.9, 1e-8


@dataclass(frozen=True)
class State:
    """Weights of terms (last row: intercepts) by labels, and the running mean of squared gradients."""

    weights: np.ndarray
    squares: np.ndarray

    def save(self, spark: SparkSession, path: str, epoch: int) -> None:
        rows = [(i, w.tobytes(), s.tobytes()) for i, (w, s) in enumerate(zip(self.weights.T, self.squares.T))]
        held = spark.createDataFrame(rows, "label int, weights binary, squares binary")
        held.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    @staticmethod
    def load(spark: SparkSession, path: str, epoch: int) -> State:
        rows = spark.read.parquet(f"{path}/epoch={epoch}").orderBy("label").collect()
        return State(*(np.array([np.frombuffer(r[n]) for r in rows]).T.copy() for n in ("weights", "squares")))


@dataclass(frozen=True)
class Trained:
    """Tables of the run: mini-batches, running means, epochs with the chosen one, test rows and their scores."""

    steps: DataFrame
    running: DataFrame
    epochs: DataFrame
    predictions: DataFrame
    summary: DataFrame
    state: State


def hashed_terms(text: Column, terms: int) -> Column:
    """Places of a text's terms among ``terms`` hashed ones; null has none."""
    found = F.coalesce(tokens(text), F.array().cast("array<string>"))
    return F.transform(found, lambda t: F.pmod(F.xxhash64(t), F.lit(terms)).cast("int"))


def _scores(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chances of the labels for each row; the rows' terms, their row and their weight in it."""
    lists = batch.column(batch.schema.get_field_index("terms"))
    terms = lists.flatten().to_numpy()
    counts = lists.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(counts)), counts)
    share = 1 / np.sqrt(np.maximum(counts, 1))[row]
    raw = np.stack([np.bincount(row, weights[terms, k] * share, len(counts)) for k in range(weights.shape[1])], axis=1)
    raw += weights[-1]
    chance = np.exp(raw - raw.max(axis=1, keepdims=True))
    return chance / chance.sum(axis=1, keepdims=True), terms, row, share


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield batch.slice(at, 512)


def _measured(rows: DataFrame, weights: np.ndarray, with_gradient: bool) -> tuple[np.ndarray, float, float, float]:
    """Summed gradient, rows, summed loss and right predictions of rows with ``label`` and ``terms``."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)
    cells = weights.size if with_gradient else 0

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        weights, total = sent.value, np.zeros(cells + 3)
        gradient = total[:cells].reshape(-1, weights.shape[1])
        for batch in _pieces(batches):
            chance, terms, row, share = _scores(batch, weights)
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            own = chance[np.arange(len(label)), label]
            total[cells:] += len(label), -np.log(np.maximum(own, 1e-15)).sum(), (chance.argmax(axis=1) == label).sum()
            if with_gradient:
                chance[np.arange(len(label)), label] -= 1
                for k in range(weights.shape[1]):
                    gradient[:-1, k] += np.bincount(terms, chance[row, k] * share, len(gradient) - 1)
                gradient[-1] += chance.sum(axis=0)
        return total

    total = array_sum(rows.select("label", "terms"), partial, cells + 3)
    sent.unpersist()
    return total[:cells].reshape(-1, weights.shape[1]), *total[cells:].tolist()


def train_by_epochs(
    df: DataFrame,
    labels: Sequence[str] = LABELS,
    key: str = KEY,
    text: str = TEXT,
    label: str = LABEL,
    epochs: int = 3,
    steps: int = 8,
    rate: float = 0.05,
    terms: int = 1 << 14,
    seed: int = 42,
    states: str | None = None,
    report_every: int = 2,
) -> Trained:
    """Train on 64 % of the rows in ``steps`` mini-batches an epoch, choose on 16 %, test on 20 %.

    The chosen epoch is the one with the least mean validation loss, the earlier on ties; its stored
    state, not the last one, scores the test rows. Batches depend on keys, seed and epoch alone, so a
    repartitioned table gives the same run up to the rounding of sums. ``states`` names the folder
    of the states.
    """
    if len(labels) * (terms + 1) > MOST_CELLS:
        raise ValueError("labels times terms: hash to fewer terms")
    spark = df.sparkSession
    coded = with_split(df, key, seed=seed).select(
        key, F.col(label).alias("actual"), label_code(F.col(label), labels).cast("int").alias("label"),
        hashed_terms(F.col(text), terms).alias("terms"), "split",
    )
    path = scratch_path(spark, "split-rows")
    coded.write.partitionBy("split").parquet(path)
    rows = spark.read.schema(coded.schema).parquet(path)
    train, val, test = (rows.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
    size = max(1, -(-train.count() // steps))
    states = states or scratch_path(spark, "states")
    state = State(*(np.zeros((terms + 1, len(labels))) for _ in range(2)))
    taken, tried = [], []
    for epoch in range(1, epochs + 1):
        dealt = batches(train, key, size, seed, epoch)
        folder = scratch_path(spark, "batches")
        dealt.write.partitionBy("batch").parquet(folder)
        stored = spark.read.schema(dealt.schema).parquet(folder)
        weights, squares = state.weights.copy(), state.squares.copy()
        for at in range(steps):
            gradient, n, loss, right = _measured(stored.filter(F.col("batch") == at), weights, True)
            if not n:
                continue
            gradient /= n
            squares = _DECAY * squares + (1 - _DECAY) * gradient**2
            weights -= rate * gradient / (np.sqrt(squares) + _FLOOR)
            taken.append((epoch, at, (epoch - 1) * steps + at, int(n), loss / n, right / n))
        state = State(weights, squares)
        state.save(spark, states, epoch)
        _, n, loss, right = _measured(val, weights, False)
        tried.append((epoch, loss / n if n else None, right / n if n else None))
    taken = written(spark.createDataFrame(taken, "epoch int, batch int, step int, n bigint, loss double, accuracy double"), "steps")
    scores = spark.createDataFrame(tried, "epoch int, val_loss double, val_accuracy double")
    best = best_candidate(scores, "val_loss", "epoch").first()
    chosen = best["epoch"] if best else epochs
    per_epoch = taken.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("steps"), F.sum("n").alias("rows"), F.avg("loss").alias("loss"), F.avg("accuracy").alias("accuracy")
    )
    kept = State.load(spark, states, chosen)
    tested = predict_labels(test, kept, labels).select(key, "actual", "predicted")
    return Trained(
        taken,
        running_means(taken, "loss", "accuracy", index="step", every=report_every),
        scores.join(per_epoch, "epoch").withColumn("chosen", F.col("epoch") == chosen),
        tested,
        summary(tested),
        kept,
    )


def predict_labels(rows: DataFrame, state: State, labels: Sequence[str] = LABELS) -> DataFrame:
    """Add the ``predicted`` label to rows with ``terms``."""
    sent = rows.sparkSession.sparkContext.broadcast(state.weights)

    @F.arrow_udf("int")
    def best(terms: pa.Array) -> pa.Array:
        held = pa.RecordBatch.from_arrays([terms], names=["terms"])
        return pa.array(_scores(held, sent.value)[0].argmax(axis=1).astype(np.int32))

    return rows.withColumn("predicted", label_name(best("terms"), labels))


def epoch_means(trained: Trained) -> DataFrame:
    """Plain means over the mini-batches of the whole run."""
    return mean_of_batches(trained.steps, "loss", "accuracy")
