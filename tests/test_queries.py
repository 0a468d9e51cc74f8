import pytest

import __spark_entry__ as entry_points
from check_queries import compare, database


@pytest.fixture(scope="module")
def connection(folder):
    return database(folder)


def test_entry(spark, folder):
    df = entry_points.entry(spark)
    assert df.columns == ["main_cat", "count", "mean_words"] and df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_agrees_with_sql(spark, folder, connection, name):
    same, note = compare(spark, connection, folder, name)
    assert same, note


@pytest.mark.parametrize("name", ["features_projected", "table_predictions", "training_job"])
def test_fits_repeat(spark, folder, name):
    first, second = (sorted(map(str, entry_points.queries()[name](spark, folder).collect())) for _ in range(2))
    assert first == second and first
