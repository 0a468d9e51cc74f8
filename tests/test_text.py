import random

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.text import (
    combine_flat,
    combine_listed,
    combine_spaced,
    list_text,
    rough_words,
    token_count,
    tokens,
    word_count,
)
from shelfwise.operators.project import keep_columns, text_and_label, with_label, with_text
from shelfwise.schema import KEPT, PRODUCT

SCHEMA = "asin string, title string, description array<string>, feature array<string>, brand string, main_cat string"


def row(asin="A1", title="a lamp", description=("x", "y"), feature=("f",), brand="b", label="Books"):
    return (asin, title, None if description is None else list(description), list(feature), brand, label)


def texts(spark, rows, style):
    df = with_text(spark.createDataFrame(rows, SCHEMA), style)
    return [r["combined_text"] for r in df.collect()]


def test_flat_flattens_and_skips_nulls(spark):
    rows = [
        row(),
        row(feature=()),
        row(title=""),
        row(brand=None),
        row(description=(None, "z")),
        row(description=None),
    ]
    assert texts(spark, rows, "flat") == [
        "A1 | a lamp | x | y | f | b",
        "A1 | a lamp | x | y | b",
        "A1 |  | x | y | f | b",
        "A1 | a lamp | x | y | f",
        "A1 | a lamp | z | f | b",
        "A1 | a lamp | f | b",
    ]


def test_listed_matches_printed_lists(spark):
    rows = [
        row(),
        row(feature=()),
        row(brand=None),
        row(description=(None, "z")),
        row(description=("d one", "it's", 'say "no"', "both ' and \"")),
        row(description=("tab\there", "line\nend\r", "back\\slash")),
        row(description=("no\u00a0break", "zero\u200bwidth", "\x07", "\U0001f600 ok", "\U000e0001", "\u0378")),
    ]
    expected = [" | ".join(str(v) for v in r[:-1] if v is not None) for r in rows]
    assert texts(spark, rows, "listed") == expected


def test_list_text_equals_python_on_random_text(spark):
    chance = random.Random(5)
    alphabet = "ab '\"\\\n\t\r\x00\x1f\x7f\x85\u00a0\u00ad\u0301\u00e9\u200b\u2028\u3000\u4e2d\ufeff\U0001f600"
    lists = [["".join(chance.choices(alphabet, k=chance.randrange(9))) for _ in range(3)] for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<string>")
    got = {r["i"]: r["t"] for r in df.select("i", list_text(F.col("v")).alias("t")).collect()}
    assert [got[i] for i in range(len(lists))] == [str(v) for v in lists]


def test_listed_takes_numbers_and_refuses_other_types(spark):
    df = spark.createDataFrame([(7, "x")], "n int, t string")
    assert df.select(combine_listed(df).alias("t")).first()["t"] == "7 | x"
    with pytest.raises(TypeError):
        combine_listed(spark.createDataFrame([(1.5,)], "d double"))


def test_spaced(spark):
    df = spark.createDataFrame([row()], SCHEMA)
    assert df.select(combine_spaced("title", "description", "brand").alias("t")).first()["t"] == "a lamp x y b"


def test_word_count_equals_python_split(spark):
    spaces = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    chance = random.Random(3)
    samples = ["", " ", "one", " a  b ", *("".join(chance.choices("ab\u200b\u00e9" + spaces, k=12)) for _ in range(300))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(samples)], "i int, t string")
    got = {r["i"]: r["n"] for r in df.select("i", word_count(F.col("t")).alias("n")).collect()}
    assert [got[i] for i in range(len(samples))] == [len(t.split()) for t in samples]


def test_tokens(spark):
    df = spark.createDataFrame([("Gr\u00f6\u00dfe 3/4-16, l'\u00e9t\u00e9!",), ("",), ("--",)], "t string")
    got = [(r[0], r[1]) for r in df.select(tokens(F.col("t")), token_count(F.col("t"))).collect()]
    assert got == [(["gr\u00f6\u00dfe", "3", "4", "16", "l", "\u00e9t\u00e9"], 6), ([], 0), ([], 0)]


def test_rough_words(spark):
    df = spark.createDataFrame([("Ab-c\u200bd \u4e2d\u6587x $5 \u0301",), ("a\ufffdb\x00c",)], "t string")
    got = [r[0] for r in df.select(rough_words(F.col("t"))).collect()]
    assert got == [["Ab", "-", "cd", "\u4e2d", "\u6587", "x", "$", "5"], ["abc"]]


def test_projection_is_ordered_and_tolerant(spark):
    df = spark.createDataFrame([row()], SCHEMA)
    assert keep_columns(df.drop("feature").select("main_cat", "brand", "asin")).columns == ["asin", "brand", "main_cat"]
    assert keep_columns(df, None).columns == df.columns
    assert [c for c in KEPT if c not in PRODUCT.fieldNames()] == []
    no_label = text_and_label(with_text(keep_columns(df.drop("main_cat"))))
    assert no_label.columns == ["asin", "combined_text"]
    assert with_text(df, include_key=False).first()["combined_text"].startswith("a lamp")
    with pytest.raises(ValueError):
        with_text(df, "other")


def test_label_filter(spark):
    df = spark.createDataFrame([("Books",), ("Grocery",), (None,)], "main_cat string")
    assert with_label(df, "Books").count() == 1


def test_flat_of_names_with_dots(spark):
    df = spark.createDataFrame([("x", "y")], "`a.b` string, c string")
    assert df.select(combine_flat("a.b", "c").alias("t")).first()["t"] == "x | y"
