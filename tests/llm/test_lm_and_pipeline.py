import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from shelfwise.llm import interpolated_lm, language_id
from shelfwise.llm.interpolated_lm import BUCKETS, bucket_of, learned_weights, score_documents
from tests.llm.conftest import ODD, crc
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_ngram_join import corpus
from tests.llm.test_spans_and_packs import brute_hits


def model(pairs):
    """Counts of the training documents, and every document's bigrams."""
    one, two, docs = Counter(), Counter(), []
    for i, t in pairs:
        held = crc("" if i is None else str(i)) % 10 == 0
        w = [*(t or "").encode().lower().split(), "</s>"]
        docs.append((i, held, w))
        if not held:
            one.update(w)
            two.update(zip(["<s>", *w], w))
    one["<s>"] = one["</s>"]
    return one, two, docs


def weights_by_hand(one, two, n, v):
    """The same EM without the grid, bigram by bigram."""
    cells = {}
    for (c, w), k in two.items():
        cv = one[c] - 1
        f = ((k - 1) / cv if cv > 0 else 0.0, (one[w] - 1) / (n - 1), 1 / (v + 1))
        cells.setdefault(int(bucket_of(np.array([cv]))[0]), []).append((k, f))
    out = {}
    for b, rows in cells.items():
        lam = [0.0, 0.5, 0.5] if b == 0 else [1 / 3] * 3
        for _ in range(60):
            new = [0.0] * 3
            for k, f in rows:
                p = sum(x * y for x, y in zip(lam, f))
                new = [s + k * x * y / p for s, x, y in zip(new, lam, f)]
            lam = [s / sum(k for k, _ in rows) for s in new]
        out[b] = lam
    return out


@pytest.mark.parametrize("small", [False, True])
def test_scores(rows, small, monkeypatch):
    if small:
        monkeypatch.setattr(interpolated_lm, "BLOCK_BYTES", 4000)
        monkeypatch.setattr(interpolated_lm, "PART_TOKENS", 3000)
    pairs = corpus(5) + ODD
    one, two, docs = model(pairs)
    n = sum(k for w, k in one.items() if w != "<s>")
    v = len([w for w in one if w != "<s>"])
    got = score_documents(rows(pairs, True)).collect()
    base = lambda w: sum(math.log10((one[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
    key = lambda i, h, k, s: (i, h, k, round(s, 4))
    assert Counter(key(r.doc_id, r.held_out, r.n_tokens, r.base_score) for r in got) == Counter(key(i, h, len(w), base(w)) for i, h, w in docs)
    assert {r.train_tokens for r in got} == {n}
    lam = weights_by_hand(one, two, n, v)
    expected = {}
    for i, _, w in docs:
        total = 0.0
        for c, x in zip(["<s>", *w], w):
            a, b, u = lam.get(int(bucket_of(np.array([one[c]]))[0]), [1 / 3] * 3)
            total += math.log10(a * (two[c, x] / one[c] if one[c] else 0) + b * one[x] / n + u / (v + 1) + 1e-300)
        expected[i, len(w)] = total
    for r in got:
        assert math.isclose(r.score, expected[r.doc_id, r.n_tokens], rel_tol=0.03, abs_tol=0.1)
        assert r.n_known <= r.n_tokens
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_nothing_to_learn_from(rows):
    assert score_documents(rows([])).count() == 0
    held = next(i for i in range(100) if crc(str(i)) % 10 == 0)
    (r,) = score_documents(rows([(held, "a b")])).collect()
    assert (r.score, r.base_score, r.n_tokens, r.n_known, r.train_tokens) == (0.0, 0.0, 3, 0, 0)


def test_weights_sum_to_one():
    cells = pa.table({"bucket": [3, 3, 0], "two": [0, 1, 1], "one": [-8, -8, -8], "weight": [6, 4, 5]})
    got = learned_weights(cells, 99)
    assert got.shape == (BUCKETS, 3) and np.allclose(got.sum(axis=1), 1) and got[0, 0] == 0
    # the maximum of 6 log(a + b / 4) + 4 log(b / 4) with a + b = 1
    assert math.isclose(got[3, 0], 3.5 / 7.5, abs_tol=1e-3)


def test_pipeline(spark, rows, tmp_path):
    draw = random.Random(8)
    item = " ".join(draw.choice("aeiou") + draw.choice("bcd") for _ in range(20))
    texts = corpus(9)
    pairs = texts + [(i + 5000, t) for i, t in texts[:20]] + ODD + [(7000, "12 34 !!"), (7001, f"ab {item} cd"), (7002, f"{item} " + " ".join(f"w{i}" for i in range(900)))]
    rows(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("x", item)], "item_id STRING, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), pairs
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "language ID":
            kept = [(i, t) for i, t in kept if any(c.isalpha() for c in t or "")]
        elif name == "exact dedup":
            best = {}
            for i, t in kept:
                best[t] = max(best.get(t, -1), -1 if i is None else i)
            kept = [(i, t) for i, t in kept if (-1 if i is None else i) == best[t]]
        elif name == "n-gram Jaccard join":
            least = {i: c for i, _, c in brute_groups(kept)}
            kept = [(i, t) for i, t in kept if i == least[i]]
        elif name == "benchmark decontamination":
            hit = lambda t: (lambda n, h, _: h and 20 * len(h) >= n)(*brute_hits(t, [("x", item)], 13))
            kept = [(i, t) for i, t in kept if not hit(t)]
            assert 7001 not in dict(kept) and 7002 in dict(kept)
        if name != "packing":
            assert docs.columns == columns
            assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(kept), name
    assert Counter(r.doc_id for r in docs.filter("start = 0").collect()) == Counter(i for i, _ in kept)
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, again.drop("sequence_id", "offset").collect())) == sorted(map(str, docs.drop("sequence_id", "offset").collect()))
    assert language_id.with_language(rows([]), 0.4).count() == 0
    assert zlib.crc32(b"") == 0 and hashlib.md5(b"").digest()
