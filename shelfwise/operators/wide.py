"""Truncated singular value decomposition of wide or sparse vectors by a randomised range finder.

A random basis of a few more columns than components asked for is multiplied by the matrix and its
transpose, one pass over the rows each time, until what it leaves out of the rows stops falling. Then a
tall-skinny QR of the rows times the basis gives singular values and axes without squaring them: a
task reduces its rows to one small triangle, triangles are reduced in groups, the rest on the driver.

Nothing is held that grows with the rows, and no matrix of column by column: tasks and driver hold
the basis, which has as many rows as the vectors have entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.features import Projection
from shelfwise.operators.sums import array_sum

#: Numbers of a basis (width times its columns): 64 MB.
MOST_NUMBERS = 1 << 23
#: Columns of the basis beyond the components asked for.
EXTRA = 10
# Numbers of the rows looked at together, and groups in which triangles are reduced.
_CELLS, _FAN = 1 << 20, 64


@dataclass(frozen=True)
class WideFit:
    projection: Projection
    #: The share of the sum of squares that the axes leave out.
    left_out: float
    rounds: int
    #: Whether rounds ended because the axes no longer gained.
    settled: bool


def _blocks(indices: pa.Array, values: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray | slice]]:
    """Rows without null ones, some at a time: a matrix over the columns that occur, and these columns.

    Dense rows are taken as they lie, over all columns.
    """
    sizes = values.value_lengths().fill_null(0).to_numpy()
    present = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    listed = indices.is_valid().to_numpy(zero_copy_only=False)
    numbers = values.flatten().to_numpy(zero_copy_only=False)
    of_row = columns = None
    step = max(1, _CELLS // width)
    for low in range(0, len(present), step):
        some = present[low : low + step]
        mine = slice(starts[some[0]], ends[some[-1]])
        if not listed[some].any() and (sizes[some] == width).all():
            yield numbers[mine].reshape(-1, width), slice(None)
            continue
        if columns is None:
            of_row = np.repeat(np.arange(len(sizes)), sizes)
            columns = np.arange(len(numbers)) - starts[of_row]
            columns[listed[of_row]] = indices.flatten().to_numpy(zero_copy_only=False)
        found, place = np.unique(columns[mine], return_inverse=True)
        matrix = np.zeros((len(some), len(found)))
        matrix[np.searchsorted(some, of_row[mine]), place] = numbers[mine]
        yield matrix, found


def _vectors(df: DataFrame, features: str) -> DataFrame:
    return df.select(F.unwrap_udt(F.col(features)).alias("v")).select("v.indices", "v.values")


def _blocks_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray | slice]]:
    for batch in batches:
        yield from _blocks(batch.column(0), batch.column(1), width)


def _multiplied(rows: DataFrame, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """The transposed matrix times the matrix times the basis, and the sum of squares, in one pass."""
    sent = rows.sparkSession.sparkContext.broadcast(basis)

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        held = sent.value
        total, squares = np.zeros(held.shape), 0.0
        for matrix, columns in _blocks_of(batches, len(held)):
            total[columns] += matrix.T @ (matrix @ held[columns])
            squares += np.sum(matrix * matrix)
        return np.append(total.ravel(), squares)

    found = array_sum(rows, partial, basis.size + 1)
    sent.unpersist()
    return found[:-1].reshape(basis.shape), float(found[-1])


def _triangle(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """The triangle of the QR decomposition of the rows times the basis."""
    sent = rows.sparkSession.sparkContext.broadcast(basis)
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, triangle = sent.value, np.zeros((0, width))
        for matrix, columns in _blocks_of(batches, len(held)):
            triangle = np.linalg.qr(np.vstack([triangle, matrix @ held[columns]]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([triangle.tobytes()], pa.binary())], names=["triangle"])

    def stacked(triangles: list[bytes]) -> np.ndarray:
        return np.linalg.qr(np.vstack([np.frombuffer(t).reshape(-1, width) for t in triangles]), mode="r")

    def reduce(table: pa.Table) -> pa.Table:
        made = stacked(table.column("triangle").to_pylist())
        return pa.table({"triangle": pa.array([made.tobytes()], pa.binary())})

    parts = rows.mapInArrow(run, "triangle binary").withColumn("some", F.pmod(F.spark_partition_id(), F.lit(_FAN)))
    found = parts.groupBy("some").applyInArrow(reduce, "triangle binary").collect()
    sent.unpersist()
    return stacked([r["triangle"] for r in found])


def fit_wide_projection(
    df: DataFrame,
    k: int,
    features: str = "scaled",
    tolerance: float = 1e-4,
    most_rounds: int = 30,
    extra: int = EXTRA,
    seed: int = 42,
) -> WideFit:
    """The first ``k`` right singular vectors of sparse or dense vectors of any one length, without centring.

    Rounds end when one lowers what ``k`` axes leave out of the sum of squares by no more than the share
    ``tolerance``, or after ``most_rounds``; ``settled`` tells which. A round reads ``df`` once, so give a
    written table. Rows that are null are left out; without any other, or with a basis of over
    ``MOST_NUMBERS``, a ``ValueError`` is raised. Axes beyond the rank have the value 0. Signs are fixed
    by making the largest entry of each axis positive.
    """
    first = df.filter(F.col(features).isNotNull()).select(features).first()
    if first is None:
        raise ValueError("no rows to project")
    width = len(first[0])
    if not 0 < k <= width:
        raise ValueError(f"{k} components of {width} columns")
    columns = min(width, k + extra)
    if width * columns > MOST_NUMBERS:
        raise ValueError(f"{width} columns times {columns}: at most {MOST_NUMBERS} numbers")
    rows = _vectors(df, features)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, columns)))[0]
    rounds, left, settled = 0, np.inf, False
    while rounds < most_rounds and not settled:
        rounds += 1
        moved, total = _multiplied(rows, basis)
        squares = np.linalg.eigvalsh(basis.T @ moved)[::-1]
        before, left = left, total - squares[:k].sum()
        # what is left of rows that the axes hold whole is rounding
        settled = before - left <= max(tolerance * left, 1e-12 * total)
        if total > 0:
            basis = np.linalg.qr(moved)[0]
    _, values, turn = np.linalg.svd(_triangle(rows, basis), full_matrices=True)
    axes = (basis @ turn.T)[:, :k]
    values = np.pad(values, (0, columns - len(values)))[:k]
    axes = axes * np.where(axes[np.argmax(np.abs(axes), axis=0), np.arange(k)] < 0, -1.0, 1.0)
    left_out = max(0.0, 1 - float(values @ values) / total) if total > 0 else 0.0
    return WideFit(Projection(axes, values), left_out, rounds, settled)


def project_wide(df: DataFrame, projection: Projection, features: str = "scaled", target: str = "projected") -> DataFrame:
    """Vectors along the axes; sparse ones are never made whole. A null vector gives null."""
    sent = df.sparkSession.sparkContext.broadcast(projection.axes)

    @F.arrow_udf("array<double>")
    def project(indices: pa.Array, values: pa.Array) -> pa.Array:
        axes = sent.value
        made = [row for matrix, columns in _blocks(indices, values, len(axes)) for row in matrix @ axes[columns]]
        found = iter(made)
        return pa.array([next(found) if there else None for there in values.is_valid().to_pylist()], pa.list_(pa.float64()))

    vector = F.unwrap_udt(F.col(features))
    numbers = project(vector["indices"], vector["values"])
    return df.withColumn("__along", numbers).withColumn(
        target, F.when(F.col("__along").isNotNull(), array_to_vector(F.coalesce("__along", F.array(F.lit(0.0)))))
    ).drop("__along")
