import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators.profile import collected_in_order
from shelfwise.operators.sketches import (
    merged_sketches,
    quartiles,
    rank_error,
    sketched_boxes,
    value_sketches,
)

GROUPS = ("hot", "a", None)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(4)
    made = []
    for i in range(9_000):
        label = "hot" if i < 6_000 else chance.choice(["a", None])
        value = None if chance.random() < 0.05 else float("nan") if chance.random() < 0.01 else chance.lognormvariate(3, 1)
        made.append((i % 7, label, value))
    return made


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "day int, main_cat string, v double").repartition(5)


def of(rows, label):
    return np.array([v for _, n, v in rows if n == label and v is not None and v == v])


def test_stored_and_merged_sketches_keep_their_rank_error(spark, df, rows, tmp_path):
    value_sketches(df, F.col("v"), "day", "main_cat", accuracy=256).write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    assert stored.count() == 7 * len(GROUPS)
    found = {r["main_cat"]: r for r in quartiles(merged_sketches(stored, "main_cat")).collect()}
    assert set(found) == set(GROUPS)
    for label, got in found.items():
        values = of(rows, label)
        assert got["n"] == len(values)
        for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert got[name] in values and abs((values <= got[name]).mean() - share) <= 2 * rank_error(256)


def test_whiskers_and_outliers_fit_the_boxes(df, rows):
    found = {r["main_cat"]: r for r in sketched_boxes(df, F.col("v"), value_sketches(df, F.col("v"), "main_cat", "day")).collect()}
    for label in GROUPS:
        values, got = of(rows, label), found[label]
        reach = 1.5 * (got["q3"] - got["q1"])
        inside = (values >= got["q1"] - reach) & (values <= got["q3"] + reach)
        assert got["whisker_low"] == min(values[inside].min(), got["q1"])
        assert got["whisker_high"] == max(values[inside].max(), got["q3"])
        assert got["outliers"] == (~inside).sum()


def test_few_rows_are_exact_and_empty_groups_absent(spark):
    df = spark.createDataFrame([("x", float(v)) for v in range(101)] + [("y", None)], "main_cat string, v double")
    [got] = quartiles(value_sketches(df, F.col("v"), "main_cat")).collect()
    assert tuple(got) == ("x", 101, 25.0, 50.0, 75.0)
    empty = value_sketches(df.limit(0), F.col("v"), "main_cat")
    assert empty.count() == 0 and sketched_boxes(df, F.col("v"), empty).count() == 0


def test_lists_of_one_key_are_cut_and_rebuilt(spark):
    chance = random.Random(9)
    rows = [("one", chance.choice(["same", "same", "b", None])) for _ in range(1_003)] + [(None, "z"), (None, "y")]
    df = spark.createDataFrame(rows, "main_cat string, v string").repartition(6)
    for table in (df, df.repartition(2, "v")):
        pieces = collected_in_order(table, "v", rows_per_piece=50).orderBy("main_cat", "piece").collect()
        for label in ("one", None):
            mine = [r for r in pieces if r["main_cat"] == label]
            whole = sorted(v for n, v in rows if n == label and v is not None)
            assert [v for r in mine for v in r["items"]] == whole
            assert [r["piece"] for r in mine] == list(range(mine[0]["pieces"]))
            assert {len(r["items"]) for r in mine[:-1]} <= {50} and len(mine) == -(-len(whole) // 50)


def test_lists_of_an_empty_table(spark):
    df = spark.createDataFrame([("x", None)], "main_cat string, v string")
    assert collected_in_order(df, "v").count() == 0
