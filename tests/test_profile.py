import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators.profile import (
    approx_distinct,
    box_statistics,
    box_statistics_approx,
    collected,
    distinct_count,
    examples,
    group_count,
    row_count,
    top_groups,
    truncation,
)
from shelfwise.plans.explore import explore
from shelfwise.plans.preprocess import preprocess


@pytest.fixture(scope="module")
def rows():
    """A hot label with a third of the rows, a null label, null values."""
    chance = random.Random(1)
    labels = ["hot"] * 300 + [chance.choice(["a", "b", None]) for _ in range(600)]
    return [(str(i), n, None if chance.random() < 0.05 else int(chance.expovariate(0.02))) for i, n in enumerate(labels)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "asin string, main_cat string, v int").repartition(5)


def of(rows, label):
    return [v for _, n, v in rows if n == label and v is not None]


def test_counts(df, rows):
    assert row_count(df).first()["rows"] == 900
    assert tuple(distinct_count(df).first()) == (4, 3)
    assert approx_distinct(df).first()["without_null"] == 3
    expected = {n: sum(r[1] == n for r in rows) for n in ("hot", "a", "b", None)}
    assert {r["main_cat"]: r["count"] for r in group_count(df).collect()} == expected
    top = top_groups(df, 2).collect()
    assert [r["count"] for r in top] == sorted(expected.values(), reverse=True)[:2]


def test_boxes_equal_numpy(df, rows):
    found = {r["main_cat"]: r for r in box_statistics(df, F.col("v")).collect()}
    for label in ("hot", "a", "b", None):
        values = np.array(of(rows, label))
        q1, median, q3 = np.percentile(values, [25, 50, 75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        got = found[label]
        assert (got["n"], got["q1"], got["median"], got["q3"]) == (len(values), q1, median, q3)
        assert got["whisker_low"] == inside.min() and got["whisker_high"] == inside.max()
        assert got["outliers"] == len(values) - len(inside)


def test_whisker_never_ends_inside_the_box(spark):
    df = spark.createDataFrame([("x", v) for v in (0, 100, 100, 100, 101)], "main_cat string, v int")
    got = box_statistics(df, F.col("v")).first()
    assert (got["q1"], got["whisker_low"], got["whisker_high"], got["outliers"]) == (100, 100, 100, 2)


def test_group_of_nulls_has_no_box(spark):
    df = spark.createDataFrame([("x", None), ("y", 1)], "main_cat string, v int")
    assert [r["main_cat"] for r in box_statistics(df, F.col("v")).collect()] == ["y"]


def test_approximate_boxes_are_close(df, rows):
    for got in box_statistics_approx(df, F.col("v")).collect():
        assert abs(got["median"] - np.median(of(rows, got["main_cat"]))) <= 2


def test_examples(df, rows):
    found = {r["main_cat"]: r["examples"] for r in examples(df, "v", 3, ["asin"]).collect()}
    for label in ("hot", "a", "b", None):
        ordered = [v for _, n, v in sorted(rows, key=lambda r: r[0]) if n == label and v is not None]
        assert found[label] == ordered[:3]


def test_collected_is_whole_and_cut(df, rows):
    pieces = collected(df, "v", "asin", rows_per_piece=50).collect()
    for label in ("hot", "a", "b", None):
        mine = [r for r in pieces if r["main_cat"] == label]
        assert sorted(v for r in mine for v in r["items"]) == sorted(of(rows, label))
        assert len(mine) > 1 and max(len(r["items"]) for r in mine) < 100


def test_truncation(spark):
    df = spark.createDataFrame([("x", "w " * 600), ("x", "w " * 510), ("x", "")], "main_cat string, combined_text string")
    got = truncation(df).first()
    assert got["max_tokens"] == 600 and abs(got["truncated_share"] - 1 / 3) < 1e-9


def test_explore_is_lazy_and_complete(spark):
    raw = spark.createDataFrame([("1", "t", "b", "9.5", "x")], "asin string, title string, brand string, price string, main_cat string")
    tables = explore(raw, preprocess(raw))
    assert set(tables) == {
        "rows", "distinct_labels", "label_counts", "word_boxes", "truncation", "asin_examples", "price_examples",
    }
    assert tables["price_examples"].first()["examples"] == ["9.5"]
