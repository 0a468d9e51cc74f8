"""Linear maximum-margin classifiers, all labels (or pairs of labels) fitted together.

Every label against the rest, or every pair of labels, is a problem with weights of its own: the mean
hinge loss over the problem's rows plus a penalty on the weights, not on the intercept. All problems
take their quasi-Newton steps in the same pass over the rows: with the directions of all problems the
tasks compute losses and gradients at a few step lengths at once, sums of arrays are added in groups
of tasks and then on the driver, which picks each problem's step. One job is one iteration, line search
included, however many labels there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.sums import array_sum
from shelfwise.scratch import written

#: Step lengths tried in one pass, as multiples of the quasi-Newton step.
STEPS = (4.0, 1.0, 0.5, 0.25, 1 / 16, 1 / 256)
#: Corners of the hinge are rounded over this width, so that gradients are continuous.
ROUNDED = 0.01
#: Pairs of steps and gradient changes remembered for each problem.
MEMORY = 8
# Numbers of one partial sum: 32 MB.
MOST_CELLS = 1 << 22
_ROWS_AT_ONCE = 1 << 10


@dataclass(frozen=True)
class Margins:
    """Weights (intercept last) of each problem; a problem tells label ``first`` from ``second``, or the rest (-1)."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    labels: int
    #: Objective of each problem after each iteration, one row an iteration.
    history: np.ndarray

    def decide(self, rows: np.ndarray) -> np.ndarray:
        """The label code of each row: largest margin, or most votes of pairs, the lower code on ties."""
        margins = rows @ self.weights[:, :-1].T + self.weights[:, -1]
        if (self.second < 0).all():
            scores = np.full((len(rows), self.labels), -np.inf)
            scores[:, self.first] = margins
            return scores.argmax(axis=1)
        votes = np.zeros((len(rows), self.labels))
        for at, (a, b) in enumerate(zip(self.first, self.second)):
            votes[:, a] += margins[:, at] >= 0
            votes[:, b] += margins[:, at] < 0
        return votes.argmax(axis=1)

    def transform(self, df: DataFrame, features: str = "projected", target: str = "prediction") -> DataFrame:
        """Add the label code as a double; a null vector has none."""

        @F.arrow_udf("double")
        def predict(rows: pa.Array) -> pa.Array:
            there = rows.is_valid().to_numpy(zero_copy_only=False)
            held = rows.drop_null()
            out = np.full(len(rows), np.nan)
            if len(held):
                out[there] = self.decide(held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1))
            return pa.array(out, mask=~there)

        return df.withColumn(target, predict(F.when(F.col(features).isNotNull(), vector_to_array(features))))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, self.labels, int(a), int(b), w.tolist()) for i, (a, b, w) in enumerate(zip(self.first, self.second, self.weights))]
        spark.createDataFrame(rows, "problem int, labels int, first int, second int, weights array<double>").write.mode(
            "overwrite"
        ).parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Margins:
        rows = spark.read.parquet(path).orderBy("problem").collect()
        first, second = (np.array([r[n] for r in rows]) for n in ("first", "second"))
        return Margins(np.array([r["weights"] for r in rows]), first, second, rows[0]["labels"], np.zeros((0, len(rows))))


def _passed(rows: DataFrame, weights, directions, steps, first, second) -> tuple[np.ndarray, np.ndarray]:
    """Summed losses (problem, step) and gradients (problem, step, weight) at ``weights + step * directions``."""
    problems, width = weights.shape
    shape = (problems, len(steps), width + 1)
    sent = rows.sparkSession.sparkContext.broadcast((weights, directions, np.array(steps), first, second))

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        weights, directions, steps, first, second = sent.value
        total = np.zeros(shape)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(at, _ROWS_AT_ONCE)
                label = part.column(0).to_numpy()
                x = np.ones((part.num_rows, width))
                x[:, :-1] = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width - 1)
                is_first = label[:, None] == first[None, :]
                is_second = np.where(second[None, :] < 0, ~is_first, label[:, None] == second[None, :])
                side = is_first.astype(np.float64) - is_second
                here, along = x @ weights.T, x @ directions.T
                for k, step in enumerate(steps):
                    short = 1 - side * (here + step * along)
                    inside = (side != 0) & (short > 0)
                    bent = np.minimum(short / ROUNDED, 1.0) * inside
                    loss = np.where(short > ROUNDED, short - ROUNDED / 2, short * short / (2 * ROUNDED)) * inside
                    total[:, k, -1] += loss.sum(axis=0)
                    total[:, k, :-1] -= (bent * side).T @ x
        return total.ravel()

    total = array_sum(rows, partial, int(np.prod(shape))).reshape(shape)
    sent.unpersist()
    return total[:, :, -1], total[:, :, :-1]


def _direction(gradient: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """The quasi-Newton direction of one problem by the two-loop recursion."""
    q, kept = gradient.copy(), []
    for s, y in zip(reversed(steps), reversed(changes)):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append((a, s, y))
    if steps:
        q *= (steps[-1] @ changes[-1]) / (changes[-1] @ changes[-1])
    for a, s, y in reversed(kept):
        q += s * (a - (y @ q) / (s @ y))
    return -q


def fit_margins(
    df: DataFrame,
    labels: int,
    features: str = "projected",
    label: str = "label",
    scheme: str = "rest",
    strength: float | None = None,
    iterations: int = 50,
    tolerance: float = 1e-4,
) -> Margins:
    """Fit ``labels`` labels (codes from 0) on dense vectors, each against the ``rest`` or in ``pairs``.

    ``strength`` weighs the penalty against the mean hinge loss; by default it is one over the rows of
    the problem, a support vector machine with unit cost. Rows with a null vector or label are left
    out. Labels without rows get no problem; one label alone is predicted always. Fitting ends when no
    problem's objective falls by the share ``tolerance`` any more, twice in a row.
    """
    if scheme not in ("rest", "pairs"):
        raise ValueError(f"unknown scheme {scheme}")
    held = df.filter(F.col(label).isNotNull() & F.col(features).isNotNull())
    rows = written(held.select(F.col(label).cast("int").alias("label"), vector_to_array(features).alias("x")), "margin-rows")
    square = F.aggregate("x", F.lit(1.0).cast("double"), lambda a, v: a + v * v)
    sizes_of = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"), F.sum(square).alias("square"))
    found = {r["label"]: r for r in sizes_of.collect()}
    if not found:
        raise ValueError("no rows to fit")
    if min(found) < 0 or max(found) >= labels:
        raise ValueError(f"codes {sorted(found)} are not below {labels}")
    there, width = sorted(found), max(r["width"] for r in found.values()) + 1
    everything = sum(r["n"] for r in found.values())
    if scheme == "pairs" and len(there) > 1:
        first, second = (np.array(x) for x in zip(*combinations(there, 2)))
        sizes = np.array([found[a]["n"] + found[b]["n"] for a, b in zip(first, second)], dtype=np.float64)
    else:
        first, second = np.array(there), np.full(len(there), -1)
        sizes = np.full(len(there), float(everything))
    if len(first) * len(STEPS) * (width + 1) > MOST_CELLS:
        raise ValueError(f"{len(first)} problems of {width} weights: project to fewer columns first")
    penalty = np.where(np.arange(width) < width - 1, 1.0, 0.0)[None, :] * (1 / sizes if strength is None else np.full(len(sizes), strength))[:, None]

    def objective(weights, losses, gradients) -> tuple[np.ndarray, np.ndarray]:
        return losses / sizes + (penalty * weights * weights).sum(axis=1) / 2, gradients / sizes[:, None] + penalty * weights

    weights = np.zeros((len(first), width))
    losses, gradients = _passed(rows, weights, np.zeros_like(weights), (0.0,), first, second)
    value, gradient = objective(weights, losses[:, 0], gradients[:, 0])
    past: list[tuple[list, list]] = [([], []) for _ in first]
    going, history = np.ones(len(first), bool), [value.copy()]
    # a first step of one over the mean squared length changes margins by about one
    reach = np.full(len(first), everything / sum(r["square"] for r in found.values()))
    shortest, calm = reach[0] * STEPS[-1] ** 3, np.zeros(len(first), bool)
    for _ in range(iterations):
        directions = np.zeros_like(weights)
        for p in np.flatnonzero(going):
            directions[p] = _direction(gradient[p], *past[p]) if past[p][0] else -reach[p] * gradient[p]
            if directions[p] @ gradient[p] >= 0:
                directions[p], past[p] = -reach[p] * gradient[p], ([], [])
        losses, gradients = _passed(rows, weights, directions, STEPS, first, second)
        tried = [objective(weights + s * directions, losses[:, k], gradients[:, k]) for k, s in enumerate(STEPS)]
        for p in np.flatnonzero(going):
            slope = directions[p] @ gradient[p]
            k = min(range(len(STEPS)), key=lambda k: tried[k][0][p])
            if tried[k][0][p] > value[p] + 1e-6 * STEPS[k] * slope:
                # no step is good: once more along the gradient, ever shorter, then the problem is done
                reach[p] *= 1.0 if past[p][0] else STEPS[-1]
                going[p] = reach[p] > shortest
                past[p] = ([], [])
                continue
            step, change = STEPS[k] * directions[p], tried[k][1][p] - gradient[p]
            small = value[p] - tried[k][0][p] <= tolerance * abs(value[p])
            weights[p] += step
            value[p], gradient[p] = tried[k][0][p], tried[k][1][p]
            if step @ change > 1e-12 * (change @ change):
                past[p] = (past[p][0] + [step])[-MEMORY:], (past[p][1] + [change])[-MEMORY:]
            if small and not calm[p]:  # twice in a row: once may be an unlucky direction
                past[p] = ([], [])
            going[p] &= not (small and calm[p])
            calm[p] = small
        history.append(value.copy())
        if not going.any():
            break
    return Margins(weights, first, second, labels, np.array(history))

