import random

import pytest

from shelfwise.llm import ngram_join
from shelfwise.llm.components import components
from shelfwise.llm.ngram_join import one_of_each_group, similar_groups
from tests.llm.conftest import ODD


def brute(pairs, percent=75):
    sets = []
    for i, t in pairs:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(x)] = find(y)
    ids = {}
    for x, (i, s) in enumerate(sets):
        ids.setdefault(find(x), []).append(i)
    least = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return sorted(((i, len(s), least[find(x)] if s else i) for x, (i, s) in enumerate(sets)), key=repr)


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghijklmnop") + draw.choice("qrstuvwxyz") + draw.choice("abcdefghij")
    passage = [word() for _ in range(60)]
    out, i = [], 1000
    for _ in range(14):
        base = [word() for _ in range(draw.choice([3, 8, 30, 120, 400]))]
        if draw.random() < 0.5:
            base += passage
        for _ in range(draw.choice([1, 2, 12, 30])):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 25))):
                copy[draw.randrange(len(copy))] = word()
            if draw.random() < 0.3:
                copy = copy[: draw.randint(1, len(copy))]
            out.append((i, " ".join(copy)))
            i += 1
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(rows, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL_MEMBERS", 8)
    monkeypatch.setattr(ngram_join, "PART_SHINGLES", 5000)
    pairs = corpus(seed) + (ODD if seed == 1 else [])
    got = similar_groups(rows(pairs, True))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(pairs)


def test_edges(rows):
    assert similar_groups(rows([])).count() == 0 and one_of_each_group(rows([])).count() == 0
    df = rows([(1, "a b c d e f"), (2, "A b c d e f"), (3, ""), (4, None), (5, "other words")], True)
    kept = one_of_each_group(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]


def test_long_chain_is_one_component(spark):
    links = spark.range(60).selectExpr("id * 7 % 61 AS a", "(id + 1) * 7 % 61 AS b")
    got = components(links).collect()
    assert len(got) == 61 and {r.component for r in got} == {0}


def test_more_parts_send_no_more_bytes(rows):
    """Classes and sizes of texts go along once a block, not once for each part that a text falls into."""
    docs = rows(corpus(3) + [(i, t) for i, (_, t) in enumerate(corpus(3)[:40])])
    sent = []
    for parts in (1, 400):
        packed = ngram_join.packed_shingles(docs, parts).cache()
        size = lambda df: sum(len(v) for r in df.collect() for v in r if isinstance(v, (bytes, bytearray)))
        sent.append((size(packed), size(ngram_join.shared_shingles(packed))))
        packed.unpersist()
    assert sent[0][0] == sent[1][0] and sent[1][1] <= sent[0][1]
