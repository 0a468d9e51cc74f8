"""Licence notices by diagonal voting.

All rolling word k-grams of the documents are hashed and joined with the positions of the same
k-grams in short templates. A hit votes for the diagonal (document position less template
position) it lies on; votes are counted for each document, template and diagonal. A phrase stands
where one diagonal holds all of its k-grams. For notices, neighbouring diagonals are merged (a word
put in or left out moves to the next diagonal) and the span counts when it covers enough of the
template's words. A second hash of another kind verifies each hit.

Defined cases: null text is empty and has no words; texts under k words have no hits; repeated rows
of one doc_id and text are scanned alike; equal diagonals of different templates are kept apart.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
# Diagonals this near belong to one span, and so do hits with at most GAP words between them.
SLACK, GAP = 3, 12
# Share of a notice's words that must be covered.
COVERAGE = 0.7

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Openings and notices of common licences, as words.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "it under the terms of the gnu general public license as published by the free software foundation either "
    "version 3 of the license or": "gpl-3",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
}


def words(text: Column) -> Column:
    """The lower-cased words of a text (A-Z only; other letters as they are)."""
    folded = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(folded, SEPARATORS), "")


def _hashes(listed: Column, at: Column) -> Column:
    gram = [F.get(listed, at + i) for i in range(K)]
    return F.struct(F.xxhash64(*gram).alias("gram"), F.hash(*gram).alias("check"))


def _grams(listed: Column) -> Column:
    places = F.when(F.size(listed) >= K, F.sequence(F.lit(0), F.size(listed) - K)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda at: _hashes(listed, at))


def template_grams(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """A row for each k-gram of each template; short fixed lists, so of bounded size."""
    rows = [(t, label, exact) for part, exact in ((phrases, True), (notices, False)) for t, label in part.items()]
    listed = F.array(
        *[
            F.struct(F.lit(i).alias("template"), F.lit(t).alias("content"), F.lit(name).alias("label"), F.lit(exact).alias("exact"))
            for i, (t, name, exact) in enumerate(rows)
        ]
    )
    templates = spark.range(1, numPartitions=1).select(F.inline(listed)).withColumn("listed", F.split("content", " "))
    return templates.select(
        "template", "label", "exact", F.size("listed").alias("length"), F.posexplode(_grams(F.col("listed"))).alias("at", "g")
    ).select("template", "label", "exact", "length", "at", "g.gram", "g.check")


def find_spans(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, coverage: float = COVERAGE
) -> DataFrame:
    """Spans of phrases and notices: doc_id, text_key, label, exact, first, last, score."""
    templates = template_grams(docs.sparkSession, phrases, notices)
    grams = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), words(F.col("text")).alias("listed")
    ).select("doc_id", "text_key", F.posexplode(_grams(F.col("listed"))).alias("pos", "g"))
    hits = grams.select("doc_id", "text_key", "pos", "g.gram", "g.check").join(F.broadcast(templates), ["gram", "check"])
    document = ["doc_id", "text_key", "template", "label", "exact", "length"]
    diagonals = (
        hits.withColumn("diagonal", F.col("pos") - F.col("at"))
        .groupBy(*document, "diagonal")
        .agg(F.collect_set("at").alias("ats"))
        .withColumn("first", F.col("diagonal") + F.array_min("ats"))
        .withColumn("last", F.col("diagonal") + F.array_max("ats") + K - 1)
    )
    phrase = diagonals.filter(F.col("exact") & (F.size("ats") == F.col("length") - K + 1)).select(
        "doc_id", "text_key", "label", "exact", "first", "last", F.lit(1.0).alias("score")
    )
    along = Window.partitionBy("doc_id", "text_key", "template").orderBy("first", "diagonal")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(along)) > SLACK) | (
        F.col("first") > F.max("last").over(before) + GAP
    )
    covered = F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("ats")), lambda at: F.sequence(at, at + K - 1))))
    notice = (
        diagonals.filter(~F.col("exact"))
        .withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(along))
        .groupBy(*document, "span")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.size(covered).alias("covered"))
        .withColumn("score", F.col("covered") / F.col("length"))
        .filter(F.col("score") >= coverage)
        .select("doc_id", "text_key", "label", "exact", "first", "last", "score")
    )
    return phrase.unionByName(notice)


def scan_licenses(docs: DataFrame, **options) -> DataFrame:
    """Every document with the places of the phrases, the labels found, and the best span's score."""
    spans = find_spans(docs, **options)
    exact = F.col("exact")
    joined = lambda names: F.array_join(F.sort_array(names), ",")
    found = spans.groupBy("doc_id", "text_key").agg(
        F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(exact, F.col("first"))).cast("bigint").alias("last_word"),
        joined(F.collect_set(F.when(exact, F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    counted = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.size(words(F.col("text"))).cast("bigint").alias("n_words"),
    )
    same = counted["doc_id"].eqNullSafe(F.col("_id")) & (counted["text_key"] == F.col("_key"))
    return counted.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
