"""Numbers, shuffles, samples and splits."""

import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.keys import digest
from shelfwise.operators import numbering
from shelfwise.operators.numbering import batches, shuffled_numbers, sorted_numbers, with_row_ids
from shelfwise.operators.sampling import (
    KeyNotUnique,
    exact_cuts,
    sample_exact,
    sample_share,
    shuffled,
    with_exact_split,
    with_split,
)

ROWS = 3_000


@pytest.fixture(scope="module")
def table(spark):
    # One group holds a third of the rows.
    group = F.when(F.col("id") < ROWS // 3, F.lit(0)).otherwise(F.col("id"))
    return spark.range(ROWS).withColumn("g", group)


def both(df):
    return df.repartition(7), df.repartition(2, "g")


def pairs(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_numbers_are_the_digest_order(spark, table):
    expected = [r["id"] for r in table.orderBy(digest("id", 5, 1), "id").collect()]
    for df in both(table):
        got = pairs(shuffled_numbers(df, "id", seed=5, epoch=1), "row_number")
        assert sorted(got, key=got.get) == expected and sorted(got.values()) == list(range(1, ROWS + 1))


def test_shuffle_depends_on_epoch_not_on_partitions(table):
    orders = [[r["id"] for r in shuffled(df, "id", epoch=1).collect()] for df in both(table)]
    assert orders[0] == orders[1] != [r["id"] for r in shuffled(table, "id", epoch=2).collect()]


@pytest.fixture(scope="module")
def repeated(spark):
    """Null, equal and composite keys, rows that agree in all columns, and nulls in either column."""
    rows = [(None if i % 5 == 0 else "k" if i % 5 < 3 else str(i % 40), None if i % 7 == 0 else i % 3, i % 90 or None) for i in range(1_000)]
    return spark.createDataFrame(rows, "k string, part int, v int")


@pytest.mark.parametrize("keys", ["k", ["k", "part"]])
@pytest.mark.parametrize("hot", [False, True])
def test_equal_keys_are_numbered_alike_on_any_partitioning(repeated, keys, hot, monkeypatch):
    def numbers(df):
        return sorted(map(repr, (tuple(r) for r in shuffled_numbers(df, keys, seed=3).collect())))

    plain = numbers(repeated.coalesce(1))
    if hot:
        monkeypatch.setattr(numbering, "_HOT_ROWS", 10)
    for df in (repeated.repartition(5), repeated.repartition(3, "v")):
        assert numbers(df) == plain
        sizes = [(r["batch"], r["rows"]) for r in batches(df, keys, 300).groupBy("batch").agg(F.count("*").alias("rows")).orderBy("batch").collect()]
        assert sizes == [(0, 300), (1, 300), (2, 300), (3, 100)]
    one, two = ([tuple(r) for r in shuffled(repeated.repartition(n), keys).collect()] for n in (2, 7))
    assert one == two


def test_sorted_numbers_with_a_hot_value(table):
    got = pairs(sorted_numbers(table, F.asc("g"), F.desc("id")), "row_number")
    expected = sorted(range(ROWS), key=lambda i: (0 if i < ROWS // 3 else i, -i))
    assert sorted(got, key=got.get) == expected and set(got.values()) == set(range(1, ROWS + 1))


def test_batches_are_full_but_the_last(table):
    sizes = [r["count"] for r in batches(table, "id", 7).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [7] * (ROWS // 7) + ([ROWS % 7] if ROWS % 7 else [])


def test_row_ids_are_unique_and_fixed(spark):
    copies = spark.range(1).select(F.explode(F.array_repeat(F.lit("same"), 500)).alias("t")).repartition(4)
    fixed = with_row_ids(copies)
    ids = [r["row_id"] for r in fixed.collect()]
    assert len(set(ids)) == 500 and sorted(ids) == sorted(r["row_id"] for r in fixed.collect())
    assert sample_exact(fixed, 0.25, "row_id").count() == 125


def test_share_sample(table):
    first, second = (set(pairs(sample_share(df, 0.3, "id"), "g")) for df in both(table))
    assert first == second and abs(len(first) / ROWS - 0.3) < 0.05
    assert sample_share(table, 1.0, "id").count() == ROWS
    assert sample_share(table, 0.0, "id").count() == 0
    assert 0 < sample_share(table, 0.5).count() < ROWS


def test_split_is_disjoint_complete_and_repeatable(table):
    first, second = (pairs(with_split(df, "id"), "split") for df in both(table))
    assert first == second and len(first) == ROWS
    sizes = {s: sum(v == s for v in first.values()) / ROWS for s in ("train", "val", "test")}
    assert abs(sizes["train"] - 0.64) < 0.05 and abs(sizes["val"] - 0.16) < 0.05 and abs(sizes["test"] - 0.2) < 0.05
    with pytest.raises(ValueError):
        with_split(table, "id", (("a", 0.5), ("b", 0.4)))


@pytest.mark.parametrize("share", [0.0, 0.001, 0.2, 0.5, 0.9995, 1.0])
def test_exact_sample(table, share):
    rows = sample_exact(table, share, "id")
    assert rows.count() == round(share * ROWS)
    order = [r["id"] for r in table.orderBy(digest("id")).collect()]
    assert {r["id"] for r in rows.collect()} == set(order[: round(share * ROWS)])


@pytest.mark.parametrize("rows", [1, 2, 5, 17, 999])
def test_exact_split(spark, rows):
    found = pairs(with_exact_split(spark.range(rows), "id"), "split")
    test = math.ceil(0.2 * rows)
    val = math.ceil(0.2 * (rows - test))
    counts = {s: sum(v == s for v in found.values()) for s in ("train", "val", "test")}
    assert counts == {"test": test, "val": val, "train": rows - test - val}
    two = pairs(with_exact_split(spark.range(rows), "id", val_share=None), "split")
    assert sum(v == "test" for v in two.values()) == test and set(two.values()) <= {"train", "test"}


def test_exact_cut_goes_deep_into_a_shared_prefix(spark):
    """Digests that agree on their first twelve digits need more than three rounds."""
    hexed = F.lpad(F.lower(F.hex("id")), 4, "0")
    df = spark.range(300).select(F.concat(F.lit("abcdef012345"), hexed, F.lit("0" * 16)).alias("d"), "id")
    for size in (1, 7, 300):
        [cut] = exact_cuts(df, F.col("d"), [size])
        assert sorted(r["id"] for r in df.filter(F.col("d") < cut).collect()) == list(range(size))


def test_equal_keys_are_cut_exactly_all_the_same(spark):
    """A third of the rows share one key, some rows have none."""
    key = F.when(F.col("id") < 100, F.lit("hot")).when(F.col("id") > 290, F.lit(None)).otherwise(F.col("id").cast("string"))
    rows = spark.range(300).withColumn("k", key)
    for share in (0.1, 0.5, 0.9):
        assert sample_exact(rows, share, "k").count() == round(share * 300)
    split = with_exact_split(rows, "k")
    assert split.columns == ["id", "k", "split"]
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"test": 60, "val": 48, "train": 192}
    ids = {s: {r["id"] for r in split.filter(F.col("split") == s).collect()} for s in counts}
    assert sum(map(len, ids.values())) == len(set.union(*ids.values())) == 300


def test_cut_refuses_impossible_sizes(spark):
    with pytest.raises(KeyNotUnique):
        exact_cuts(spark.createDataFrame([("k",)] * 10, "k string"), digest("k"), [5])
    with pytest.raises(ValueError, match="fewer"):
        exact_cuts(spark.range(3), digest("id"), [4])


def test_hot_key_is_numbered_in_the_same_order(spark, table, monkeypatch):
    expected = pairs(shuffled_numbers(table, "g").groupBy("g").agg(F.min("row_number").alias("n"), F.max("g").alias("id")), "n")
    monkeypatch.setattr("shelfwise.operators.numbering._HOT_ROWS", 100)
    hot = shuffled_numbers(table, "g")
    assert sorted(r["row_number"] for r in hot.collect()) == list(range(1, ROWS + 1))
    assert pairs(hot.groupBy("g").agg(F.min("row_number").alias("n"), F.max("g").alias("id")), "n") == expected
    assert hot.columns == ["id", "g", "row_number"]


def test_null_empty_and_composite_keys_are_told_apart(spark):
    rows = [(None, "c"), ("", "c"), ("a|b", "c"), ("a", "b|c"), ("c", None), ("c", ""), (None, None), ("", ""), ("-", "c")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(digest(["x", "y"]).alias("d")).distinct().count() == len(rows)
    single = {r["x"]: r["d"] for r in df.select("x", digest("x").alias("d")).distinct().collect()}
    assert len(set(single.values())) == len(single) and not any(d is None for d in single.values())
