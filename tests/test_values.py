import pytest
from pyspark.sql import functions as F

from shelfwise.functions.arrays import argmax, element, head, percent, ratio
from shelfwise.functions.keys import cut_point
from shelfwise.functions.labels import in_domain, label_code, label_decoder, label_encoder, label_key, label_name
from shelfwise.operators.validate import accepted, rejected, with_domain_check, with_reason
from shelfwise.schema import LABELS, REQUEST


def test_labels_are_sorted_and_complete():
    assert LABELS == sorted(LABELS) and len(set(LABELS)) == 22 and "Buy a Kindle" not in LABELS


def test_codes_follow_the_list(spark):
    df = spark.createDataFrame([(n,) for n in reversed(LABELS)], "main_cat string")
    rows = df.select("main_cat", label_code(F.col("main_cat")).alias("c")).withColumn("back", label_name(F.col("c"))).collect()
    assert all(LABELS[r["c"]] == r["main_cat"] == r["back"] for r in rows)
    encoded = label_decoder(source="label", target="again").transform(label_encoder().transform(df)).collect()
    assert all(LABELS[int(r["label"])] == r["main_cat"] == r["again"] for r in encoded)


@pytest.mark.parametrize("name", ["Buy a Kindle", None])
def test_unknown_label_fails(spark, name):
    df = spark.createDataFrame([(name,)], "main_cat string")
    with pytest.raises(Exception, match="unknown label"):
        df.select(label_code(F.col("main_cat"))).collect()


def test_label_keys(spark):
    df = spark.createDataFrame([(n,) for n in LABELS], "n string")
    keys = [r[0] for r in df.select(label_key(F.col("n"))).collect()]
    assert keys[3] == "Arts_Crafts_and_Sewing" and len(set(keys)) == 22
    assert all(k.isidentifier() for k in keys)


def test_arrays(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([0.5, 0.5],), ([],)], "a array<double>")
    rows = df.select(
        argmax(F.col("a")).alias("m"), element(F.col("a"), 2).alias("e"), F.size(head(F.col("a"), 2)).alias("h")
    ).collect()
    assert [(r["m"], r["e"], r["h"]) for r in rows] == [(1, 3.0, 2), (0, None, 2), (None, None, 0)]


def test_ratio_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, 4), (0, 0), (3, None)], "p int, w int")
    rows = df.select(percent(ratio(F.col("p"), F.col("w"))).alias("x")).collect()
    assert [r["x"] for r in rows] == [25.0, 0.0, 0.0]


def test_cut_points():
    assert cut_point(0) == "00000000" and cut_point(0.5) == "80000000" and cut_point(1) == "g"
    with pytest.raises(ValueError):
        cut_point(1.5)


def full_request(**changes):
    values = {f.name: ["x"] if f.dataType.typeName() == "array" else "x" for f in REQUEST.fields}
    return tuple({**values, **changes}.values())


def test_requests_are_split_with_reasons(spark):
    rows = [full_request(), full_request(brand=None, image=None), full_request(feature=["a", None]), full_request(price="")]
    checked = with_reason(spark.createDataFrame(rows, REQUEST))
    assert accepted(checked).count() == 2 and "reject_reason" not in accepted(checked).columns
    reasons = [r["reject_reason"] for r in rejected(checked).collect()]
    assert reasons == ["brand is missing; image is missing", "feature holds a null"]


def test_missing_column_rejects_every_row(spark):
    df = spark.createDataFrame([full_request()], REQUEST).drop("title")
    assert with_reason(df).first()["reject_reason"] == "title is missing"


def test_domain(spark):
    df = spark.createDataFrame([("Books",), ("Buy a Kindle",), (None,)], "main_cat string")
    assert [r["in_domain"] for r in with_domain_check(df).collect()] == [True, False, False]
    assert df.select(in_domain(F.col("main_cat"), ["x"]).alias("d")).first()["d"] is False
