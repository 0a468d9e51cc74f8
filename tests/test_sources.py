import gzip
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.plans.etl import routed_lines, run_etl
from shelfwise.schema import PRODUCT
from shelfwise.scratch import scratch_root, sized_for_join, written
from shelfwise.sources.json_lines import MALFORMED, json_fields, read_json_lines, write_json_lines
from shelfwise.sources.tables import fetch_small, read_table, write_table

ITEM = {
    "asin": "X1", "title": "rod &quot;end&quot;", "brand": "b", "description": ["d"], "feature": [], "category": ["c"],
    "also_buy": [], "also_view": [], "image": [], "price": "", "main_cat": "Automotive",
}


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "items.jsonl.gz"
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write(json.dumps(ITEM) + "\n\n{bad\n" + json.dumps({**ITEM, "asin": "X2", "price": "3.5"}) + "\n")
    return str(path)


def test_permissive_keeps_bad_lines_and_skips_blank_ones(spark, lines):
    rows = read_json_lines(spark, lines, keep_malformed=True).collect()
    assert [r["asin"] for r in rows] == ["X1", None, "X2"]
    assert [r[MALFORMED] for r in rows] == [None, "{bad", None]
    assert rows[0]["title"] == ITEM["title"] and rows[0]["feature"] == []
    assert [r["price"] for r in rows] == ["", None, "3.5"]


def test_other_modes(spark, lines):
    assert read_json_lines(spark, lines, mode="DROPMALFORMED").count() == 2
    with pytest.raises(Exception):
        read_json_lines(spark, lines, mode="FAILFAST").collect()


def test_explicit_schema_runs_no_job_and_spreads(spark, lines):
    df = read_json_lines(spark, lines, partitions=3)
    assert df.schema == PRODUCT and df.rdd.getNumPartitions() == 3


def test_json_write_and_read(spark, lines, tmp_path):
    whole = read_json_lines(spark, lines, mode="DROPMALFORMED")
    write_json_lines(whole, str(tmp_path / "out"))
    again = read_json_lines(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, whole.collect()))


def test_json_column(spark):
    df = spark.createDataFrame([('{"k": 3}',), ("no",), (None,)], "p string")
    assert [r[0] for r in df.select(json_fields(F.col("p"), "k bigint")["k"]).collect()] == [3, None, None]


def test_parquet_is_replaced_and_partitioned(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(10).withColumn("g", F.col("id") % 2), path, partition_by="g", rows_per_file=2)
    back = read_table(spark, path)
    assert back.count() == 10 and len(list((tmp_path / "t").glob("g=0/*.parquet"))) >= 3
    assert "PartitionFilters: [isnotnull(g" in back.filter("g = 1")._jdf.queryExecution().toString()


def test_fetch_is_whole_or_fails(spark):
    assert len(fetch_small(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        fetch_small(spark.range(6), 5)


def test_scratch_is_stable_and_tables_are_fixed(spark):
    assert scratch_root(spark) == scratch_root(spark)
    fixed = written(spark.range(4).withColumn("r", F.rand()), "random")
    assert sorted(fixed.collect()) == sorted(fixed.collect())


def test_broadcast_only_when_small(spark):
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(sized_for_join(spark.range(5), "few", most_rows=5))
    assert not hinted(sized_for_join(spark.range(6), "many", most_rows=5))


def test_etl(spark, lines, tmp_path):
    target = str(tmp_path / "table")
    run_etl(spark, lines, target, style="listed")
    rows = {r["asin"]: r["combined_text"] for r in read_table(spark, target).collect()}
    assert rows["X1"] == "X1 | rod &quot;end&quot; | ['d'] | [] | b"
    assert rows[None] == ""  # a broken line stays as an empty text
    run_etl(spark, lines, target, fraction=0.0)
    assert read_table(spark, target).count() == 0


def test_malformed_lines_are_routed(spark, tmp_path):
    good = [f'{{"asin":"{i}","title":"t {i}","main_cat":"Books"}}' for i in range(200)]
    bad = ['{"asin":"x"', "no json", '{"asin": "1", "description": "no list"}']
    spark.createDataFrame([(x,) for x in good + bad + ["", "  "]], "value string").coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "in"))
    done = run_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), rejected=str(tmp_path / "bad"))
    assert (done.lines, done.malformed) == (203, 3)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert {r.asin for r in rows.collect()} == {str(i) for i in range(200)} and rows.count() == 200
    assert {r.malformed for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == set(bad)
    kept, broken, _, _ = routed_lines(spark, str(tmp_path / "in"), partitions=5)
    # one gzip file is one task; its rows lie in as many files as were asked for, for the work after
    assert len(kept.inputFiles()) == 10 or len({f for f in kept.inputFiles() if "malformed_line=false" in f}) == 5
    sampled = run_etl(spark, str(tmp_path / "in"), str(tmp_path / "half"), fraction=0.5, rejected=str(tmp_path / "bad"))
    assert sampled.malformed == 3 and 0 < spark.read.parquet(str(tmp_path / "half")).count() < 200
    assert run_etl(spark, str(tmp_path / "in"), str(tmp_path / "drop"), mode="DROPMALFORMED") is None
    with pytest.raises(ValueError, match="malformed"):
        run_etl(spark, str(tmp_path / "in"), str(tmp_path / "no"), mode="FAILFAST", rejected=str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "drop")).count() == 200
