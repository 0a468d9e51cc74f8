import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import ball_tree
from shelfwise.llm.ball_tree import BallTree, Best, search
from tests.llm.conftest import ODD
from tests.llm.test_native import words_of as brute_words

MATRIX = st.lists(st.dictionaries(st.integers(0, 7), st.integers(1, 10**10), min_size=1), min_size=1, max_size=60)


def tree_of(rows, leaf, monkey):
    monkey.setattr(ball_tree, "LEAF", leaf)
    starts = np.cumsum([0, *map(len, rows)])
    columns = np.array([c for r in rows for c in sorted(r)])
    values = np.array([r[c] for r in rows for c in sorted(r)], dtype=np.int64)
    return BallTree(starts, columns, values, 8)


@given(MATRIX, st.sets(st.integers(0, 7), min_size=1), st.sampled_from([1, 3, 8]), st.sampled_from([1, 3, 10]))
@settings(max_examples=300, deadline=None)
def test_tree(rows, item, leaf, count):
    with pytest.MonkeyPatch.context() as monkey:
        tree = tree_of(rows, leaf, monkey)
    scores = [sum(r.get(c, 0) for c in item) for r in rows]
    terms = np.array(sorted(item))
    bounds = tree.bounds([terms, np.arange(8)])[:, 0]
    # every row lies in one leaf, and no node's bound is below a score of its rows
    leaves = [tree.rows[a:b].tolist() for a, b in zip(tree.leaves[:-1], tree.leaves[1:])]
    assert sorted(i for x in leaves for i in x) == list(range(len(rows))) and max(map(len, leaves)) <= leaf
    for leaf_at, inside in enumerate(leaves):
        node = (1 << tree.levels) + leaf_at
        while node:
            assert all(bounds[node] >= scores[i] for i in inside)
            node //= 2
    wanted = np.zeros(8, np.int64)
    wanted[terms] = 1
    best = Best(count)
    tree.search(bounds, wanted, best, np.arange(len(rows)))
    expected = sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:count]
    assert list(zip((-best.scores).tolist(), best.keys.tolist())) == expected


def test_subtrees_are_left_out(monkeypatch):
    draw = random.Random(1)
    rows = [{draw.randint(0, 1) + 2 * (i % 4): draw.randint(900, 1000)} for i in range(4000)]
    tree = tree_of(rows, 32, monkeypatch)
    wanted = np.array([1, 1, 0, 0, 0, 0, 0, 0])
    best = Best(10)
    scored = tree.search(tree.bounds([np.array([0, 1])])[:, 0], wanted, best, np.arange(4000))
    assert scored < (1 << tree.levels) / 2


def brute(docs, items):
    found = [(i, Counter(brute_words(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(w for _, c in found for w in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in found:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(n_terms, 1)
            score = 0
            for w in set(brute_words(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
            scores.append((-score, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:10], 1):
            out[item, rank, None if none else i, -s] += 1
    return out


@pytest.mark.parametrize("at_once", [4096, 3])
def test_search(spark, rows, at_once, monkeypatch):
    monkeypatch.setattr(ball_tree, "BLOCK_ENTRIES", 200)
    draw = random.Random(2)
    word = lambda n: " ".join(draw.choice("abcdefgh") + draw.choice("Xyzé") for _ in range(n))
    docs = [(100 + i, word(draw.randint(0, 40))) for i in range(150)] + ODD + [(90, "same text here"), (91, "SAME text, here")]
    items = [(i, word(draw.randint(1, 9))) for i in range(5)] + [(5, None), (6, ""), (7, "?!"), (None, "same text"), (3, "ax ay ax"), (8, "nowhere")]
    table = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id BIGINT, text STRING, doc_id INT, rank INT")
    got = search(rows(docs, True).repartition(4), table, items_at_once=at_once).collect()
    assert Counter(map(tuple, got)) == brute(docs, items)


def test_empty(spark, rows):
    items = spark.createDataFrame([("a", "x")], "item_id STRING, text STRING")
    assert search(rows([]), items).collect() == [] and search(rows([(1, None)]), items).collect() == []
    nothing = search(rows([(1, "x")]), items.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]
