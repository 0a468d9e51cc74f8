import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import LongType, StructField, StructType

from shelfwise.operators.features import fit_projection
from shelfwise.operators.wide import fit_wide_projection, project_wide

SCHEMA = StructType([StructField("id", LongType()), StructField("scaled", VectorUDT())])


def frame(spark, vectors, parts=3):
    return spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(parts)


def sparse(row):
    at = np.flatnonzero(row)
    return Vectors.sparse(len(row), at.tolist(), row[at].tolist())


@pytest.fixture(scope="module")
def matrix():
    """Falling singular values, most entries zero, some rows without any entry."""
    chance = np.random.default_rng(5)
    made = np.zeros((300, 900))
    for i in range(300):
        at = chance.choice(900, 12, replace=False)
        made[i, at] = chance.exponential(size=12)
    made[:, :8] += np.outer(chance.normal(size=300), np.arange(8, 0, -1)) * (np.arange(8) < 5)
    made[::50] = 0
    return made


def test_values_and_axes_equal_numpy(spark, matrix):
    _, values, axes = np.linalg.svd(matrix, full_matrices=False)
    found = fit_wide_projection(frame(spark, map(sparse, matrix)), 6, tolerance=1e-10, most_rounds=60)
    assert found.settled and np.isclose(found.left_out, 1 - (values[:6] ** 2).sum() / (values**2).sum())
    assert np.allclose(found.projection.values, values[:6], rtol=1e-5)
    along = np.abs(np.sum(found.projection.axes * axes[:6].T, axis=0))
    assert along[0] > 1 - 1e-9 and np.allclose(found.projection.axes.T @ found.projection.axes, np.eye(6), atol=1e-9)


def test_dense_rows_agree_with_the_matrix_of_column_products(spark, matrix):
    narrow = matrix[:, :40]
    df = frame(spark, [Vectors.dense(r) for r in narrow])
    exact = fit_projection(df, 4)
    found = fit_wide_projection(df, 4, tolerance=1e-10, most_rounds=100).projection
    assert np.allclose(found.values, exact.values, rtol=1e-7)
    assert np.allclose(np.abs(np.sum(found.axes * exact.axes, axis=0)), 1, atol=1e-4)


def test_same_on_any_partitioning_and_on_dense_and_sparse_rows(spark, matrix):
    mixed = [sparse(r) if i % 2 else Vectors.dense(r) for i, r in enumerate(matrix)]
    one, two = (fit_wide_projection(frame(spark, mixed, parts), 3) for parts in (1, 7))
    assert one.rounds == two.rounds and np.allclose(one.projection.axes, two.projection.axes, atol=1e-8)


def test_projected_rows(spark, matrix):
    df = frame(spark, [*map(sparse, matrix), None])
    fit = fit_wide_projection(df, 3)
    got = {r["id"]: r["projected"] for r in project_wide(df, fit.projection).collect()}
    assert got.pop(300) is None
    assert np.allclose(np.array([got[i].toArray() for i in range(300)]), matrix @ fit.projection.axes)


def test_rank_below_the_components_and_all_zeros(spark):
    fit = fit_wide_projection(frame(spark, [Vectors.sparse(50, [7], [2.0])] * 2), 3)
    assert np.allclose(fit.projection.values, [8**0.5, 0, 0]) and abs(fit.projection.axes[7, 0] - 1) < 1e-9
    assert fit.left_out < 1e-9
    nothing = fit_wide_projection(frame(spark, [Vectors.sparse(50, [], [])] * 2), 3)
    assert np.allclose(nothing.projection.values, 0) and nothing.projection.axes.shape == (50, 3)


def test_refused(spark):
    with pytest.raises(ValueError, match="no rows"):
        fit_wide_projection(frame(spark, [None, None]), 1)
    with pytest.raises(ValueError, match="components"):
        fit_wide_projection(frame(spark, [Vectors.dense([1.0])]), 2)
    with pytest.raises(ValueError, match="at most"):
        fit_wide_projection(frame(spark, [Vectors.sparse(1 << 22, [0], [1.0])]), 2)


def test_dense_rows_are_taken_as_they_lie(matrix):
    """Over all columns, without looking for those that occur; other rows, nulls and mixtures as before."""
    import pyarrow as pa

    from shelfwise.operators.wide import _blocks

    rows = matrix[:6, :40]
    full, at = [r.tolist() for r in rows], [np.flatnonzero(r).tolist() for r in rows]
    lists = lambda items, kind: pa.array(items, pa.list_(kind))
    (block, columns), = _blocks(lists([None] * 6, pa.int32()), lists([full[0], None, *full[2:]], pa.float64()), 40)
    assert columns == slice(None) and np.array_equal(block, np.delete(rows, 1, axis=0))
    mixed = [None, *at[1:]], [full[0], *(r[i].tolist() for r, i in zip(rows[1:], at[1:]))]
    (block, columns), = _blocks(lists(mixed[0], pa.int32()), lists(mixed[1], pa.float64()), 40)
    made = np.zeros((6, 40))
    made[:, columns] = block
    assert np.array_equal(made, rows)
