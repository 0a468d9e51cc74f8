"""What the physical plans must and must not hold."""

import re

from pyspark.sql import functions as F

from shelfwise.catalog import products, table, texts
from shelfwise.functions.text import word_count
from shelfwise.operators.encode import encode
from shelfwise.operators.metrics import summary
from shelfwise.operators.numbering import shuffled_numbers
from shelfwise.operators.profile import box_statistics, examples, top_groups
from shelfwise.operators.project import with_label
from shelfwise.operators.sampling import sample_share, with_split
from shelfwise.operators.vocabulary import word_vocabulary
from shelfwise.plans.preprocess import preprocess
from shelfwise.sources.json_lines import read_json_lines, write_json_lines
from shelfwise.sources.tables import read_table


def test_text_work_stays_in_the_jvm_and_needs_no_shuffle(spark, folder, plan_of, tmp_path):
    write_json_lines(products(spark, folder), str(tmp_path / "in"))
    raw = read_json_lines(spark, str(tmp_path / "in"))
    for style in ("flat", "listed"):
        rows = preprocess(raw, style)
        plan = plan_of(with_split(sample_share(rows, 0.5, "asin"), "asin").withColumn("n", word_count(F.col("combined_text"))))
        assert "Python" not in plan and "Exchange" not in plan
        read = re.search(r"ReadSchema: struct<([^.]*)", plan).group(1)
        assert "also_buy" not in read and "price" not in read


def test_filter_and_columns_reach_the_scan(spark, folder, plan_of):
    plan = plan_of(with_label(table(spark, folder, "documents"), "en", "lang").select("doc_id"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_examples_are_limited_before_the_shuffle(spark, folder, plan_of):
    plan = plan_of(examples(table(spark, folder, "part").withColumnRenamed("p_type", "main_cat"), "p_partkey", 3, ["p_partkey"]))
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.rindex("Exchange")


def test_top_list_is_not_a_full_sort(spark, folder, plan_of):
    plan = plan_of(top_groups(table(spark, folder, "documents").withColumnRenamed("source", "main_cat"), 5))
    assert "TakeOrderedAndProject" in plan


def test_lookup_encoding_moves_no_rows(spark, folder, plan_of):
    rows = table(spark, folder, "documents").selectExpr("doc_id", "text as combined_text", "lang as main_cat")
    vocabulary = word_vocabulary(rows, min_count=2)
    plan = plan_of(encode(rows, vocabulary, 64, "word"))
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan
    joined = plan_of(encode(rows, vocabulary, 64, "word", route="join"))
    assert "Python" not in joined


def test_numbers_shuffle_rows_once(spark, folder, plan_of):
    rows = table(spark, folder, "documents").select("doc_id", "text")
    plan = plan_of(shuffled_numbers(rows, "doc_id"))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(__range" in line]
    assert len(moved) == 1
    # The range sizes are a small table of their own, the only side that is broadcast.
    assert "ReadSchema: struct<__range:string,__n:bigint>" in plan and plan.count("BroadcastExchange") == 1


def test_counts_before_shuffles(spark, folder, plan_of):
    boxes = plan_of(box_statistics(texts(spark, folder), word_count(F.col("combined_text"))))
    assert "partial_count" in boxes
    pairs = table(spark, folder, "labels").selectExpr("quality as actual", "toxic as predicted")
    plan = plan_of(summary(pairs))
    assert "partial_count" in plan and plan.count("FileScan") == 1


def test_measure_is_computed_once(spark, folder):
    boxes = box_statistics(texts(spark, folder), word_count(F.col("combined_text")))
    boxes.collect()
    final = boxes._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("regexp_extract_all") == 1


def test_enough_tasks_are_left_alone(spark, folder, plan_of, tmp_path):
    spark.range(64).repartition(16).write.parquet(str(tmp_path / "many"))
    kept = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 1024 * 1024))
    try:
        assert "Exchange" not in plan_of(read_table(spark, str(tmp_path / "many"), spread=True))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", kept)
