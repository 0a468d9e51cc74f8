import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import toxicity
from shelfwise.llm.folds import bounded_sample, fold
from shelfwise.llm.language_id import chosen, estimated, identify
from tests.llm.conftest import ODD, crc

ALPHABETS = {"aa": "abcdeé", "bb": "fghijk", "cc": "lmnopß"}


def prose(draw, lang, n):
    return " ".join("".join(draw.choice(ALPHABETS[lang]) for _ in range(draw.randint(2, 7))) for _ in range(n))


def test_languages_of_pure_and_mixed_texts(spark):
    draw = random.Random(3)
    made = [(i, prose(draw, lang, 40), lang) for i, lang in enumerate(list(ALPHABETS) * 100)]
    mixed = [(1000 + i, prose(draw, "aa", 70) + " " + prose(draw, "cc", 30), None) for i in range(20)]
    odd = [(i, t, None) for i, t in ODD if i not in (4, 5, 10)] + [(2000, "123 --", "aa"), (2001, "–…", None), (2002, "日本", None)]
    docs = spark.createDataFrame(made + mixed + odd, "doc_id BIGINT, text STRING, lang STRING").selectExpr("*", "1 AS score", "2 AS held")
    got = identify(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    known = {i: lang for i, _, lang in made}
    for r in got:
        assert r.held_out == (crc("" if r.doc_id is None else str(r.doc_id)) % 5 == 0)
        if r.doc_id is not None and 11 <= r.doc_id < 300:
            assert r.lang_pred == known[r.doc_id] and r.languages == [r.lang_pred]
        elif r.doc_id is not None and 1000 <= r.doc_id < 2000:
            assert r.lang_pred == "aa" and r.languages == ["aa", "cc"] and math.isclose(r.score, 0.7, abs_tol=0.05)
    by = {r.doc_id: r for r in got}
    assert by[2000].lang_pred == by[2001].lang_pred == "und" and by[2002].lang_pred != "und"
    assert identify(docs.limit(0)).count() == 0
    nothing = identify(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_em_finds_the_shares():
    draw = np.random.default_rng(4)
    kind = draw.random(4000) < 0.3
    words = np.where(kind[:, None], [[-9.0, -2.0]], [[-2.0, -9.0]])
    shares, value = estimated(words, np.array([0, 1000, 4000]), np.full((2, 2), 0.5), 30)
    assert np.allclose(shares[:, 1], [kind[:1000].mean(), kind[1000:].mean()], atol=0.01)
    direct = np.log((shares[0] * np.exp(words[:1000])).sum(axis=1)).sum()
    assert math.isclose(value[0], direct, rel_tol=1e-9)
    pure = chosen(np.tile([[-2.0, -9.0]], (50, 1)), np.array([0, 20, 50]))
    assert (pure == [[1, 0], [1, 0]]).all()


def brute_segments(scores):
    """Maximal segments by their definition: the best segment, then the same on both sides of it."""
    if not scores or max(scores) <= 0:
        return []
    spans = [(sum(scores[a:b]), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
    best = max(s for s, _, _ in spans)
    _, a, b = min((x for x in spans if x[0] == best), key=lambda x: (x[2] - x[1], x[1]))
    left, right = brute_segments(scores[:a]), brute_segments(scores[b:])
    return left + [(a, b, best)] + [(x + b, y + b, s) for x, y, s in right]


@given(st.lists(st.integers(-9, 9), max_size=14))
@settings(max_examples=400, deadline=None)
def test_segments(numbers):
    # powers apart, so that no two segments tie
    scores = [n + (i + 1) * 2.0 ** -(10 + i) for i, n in enumerate(numbers)]
    expected = brute_segments(scores)
    for found in (toxicity.maximal_segments(scores), toxicity.segments_of(np.array(scores))):
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in found], [s for *_, s in expected])


def test_toxicity(spark):
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(1200):
        words = prose(draw, "aa", draw.randint(20, 80)).split()
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(draw.randint(0, len(words)), draw.choice(["vileword", "vileness", "grim"]))
        rows.append((i, " ".join(words)))
        if i % 10 != 9:
            labels.append((i, int(toxic)))
    odd = [(i and i + 5000, t) for i, t in ODD]
    docs = spark.createDataFrame(rows + odd, "doc_id BIGINT, text STRING").selectExpr("*", "1 AS toxic", "'x' AS best")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id BIGINT, toxic INT").selectExpr("doc_id", "1 AS quality", "toxic")
    got = toxicity.score_documents(docs, marks).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    right = [r.predicted == (r.doc_id % 6 == 0) for r in got if r.doc_id is not None and r.doc_id < 5000]
    assert sum(right) / len(right) > 0.98
    one = next(r for r in got if r.doc_id == 6)
    words = dict(rows)[6].split()
    assert any(w.startswith(("vile", "grim")) for s in one.segments for w in words[s.start : s.stop])
    assert toxicity.score_documents(docs.limit(0), marks).count() == 0
    unlearned = toxicity.score_documents(docs, marks.limit(0)).collect()
    assert {r.predicted for r in unlearned} == {0}
    all_clean = toxicity.score_documents(docs, marks.filter("toxic = 0")).collect()
    assert {r.predicted for r in all_clean} == {0}


def test_sample_is_bounded(spark):
    df = spark.range(20000).selectExpr("id AS doc_id", "IF(id < 100, 'few', 'many') AS label")
    n = Counter(r.label for r in bounded_sample(df, "label", "doc_id", 500).collect())
    assert n["few"] == 100 and 400 < n["many"] < 600
    assert df.filter(fold("doc_id", 5) == 0).count() == sum(crc(str(i)) % 5 == 0 for i in range(20000))
    with pytest.raises(ValueError):
        identify(spark.range(300).selectExpr("id AS doc_id", "'abc' AS text", "string(id) AS lang"))
