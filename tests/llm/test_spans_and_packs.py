import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwise.llm.decontaminate import Matcher, cut, find_contamination, judged, without_contamination
from shelfwise.llm.packing import Encoder, cut_pieces, first_fit, pack
from shelfwise.llm.stretches import tokenizer_file
from shelfwise.llm.words import LETTERED, SPACED, shingles, words_of
from tests.llm.conftest import ODD
from tests.llm.test_native import words_of as brute_words


@given(st.lists(st.text(alphabet="aB z\t\n\x0b-9É\x00 ß", max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words(texts):
    got = words_of(pa.array(texts, pa.string()), LETTERED)
    listed = [brute_words(t) for t in texts]
    assert got.counts().tolist() == [len(w) for w in listed]
    flat = [w for ws in listed for w in ws]
    assert len(set(zip(flat, got.hashes.tolist()))) == len(set(flat)) == len(set(got.hashes.tolist()))
    spaced = [t.encode().lower().split() for t in texts]
    got = words_of(pa.array(texts, pa.string()), SPACED)
    assert got.counts().tolist() == [len(w) for w in spaced]
    sets = [{tuple(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else ({tuple(w)} if w else set()) for w in spaced]
    grams, rows = shingles(got, 2)
    assert [len(set(grams[rows == i].tolist())) for i in range(len(texts))] == [len(s) for s in sets]


def brute_hits(text, items, window):
    w = brute_words(text)
    hit, names = set(), set()
    for name, item in items:
        x = brute_words(item)
        size = min(window, len(x))
        for a in range(len(x) - size + 1) if x else ():
            for i in range(len(w) - size + 1):
                if w[i : i + size] == x[a : a + size]:
                    hit.update(range(i, i + size))
                    names.add(name)
    return len(w), hit, names


@given(
    st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=5),
    st.lists(st.lists(st.sampled_from("abcd"), max_size=25), min_size=1, max_size=4),
)
@settings(max_examples=300, deadline=None)
def test_automaton(items, texts):
    items = [(str(i), " ".join(x)) for i, x in enumerate(items)]
    texts = [" ".join(t) for t in texts]
    matcher = Matcher([n for n, _ in items], [t for _, t in items], 4)
    for text, (n, spans, found) in zip(texts, matcher.matches(pa.array(texts, pa.string()))):
        words, hit, names = brute_hits(text, items, 4)
        assert n == words and found == names
        assert {i for a, b in spans for i in range(a, b)} == hit


@pytest.mark.parametrize("most_words", [1000, 30])
def test_contamination(spark, rows, most_words):
    draw = random.Random(1)
    word = lambda n: " ".join(draw.choice("abcdefgh") + draw.choice("xyz") for _ in range(n))
    items = [(str(i), word(draw.choice([3, 14, 20]))) for i in range(9)] + [("e", ""), ("n", None), ("p", "!!")]
    texts = [word(30) + " " + draw.choice(items[:9])[1].upper() + ". " + word(draw.choice([1, 300])) for _ in range(30)]
    pairs = [(100 + i, t) for i, t in enumerate(texts)] + ODD
    table = spark.createDataFrame(items, "item_id STRING, text STRING")
    got = judged(find_contamination(rows(pairs, True), table, most_words=most_words)).collect()
    expected = []
    for i, t in pairs:
        n, hit, names = brute_hits(t, [(a, b or "") for a, b in items], 13)
        expected.append((i, n, len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= n))
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == Counter(expected)
    if most_words == 1000:
        kept = without_contamination(rows(pairs, True), table)
        assert kept.columns == rows(pairs, True).columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(x[0] for x in expected if not x[-1])
    assert find_contamination(rows([]), table).count() == 0
    assert find_contamination(rows([(1, "a")]), table.limit(0)).collect()[0].spans == []


def test_cut():
    assert cut("One, two three. Four!", [(1, 3)]) == "One, . Four!"
    assert cut(None, [(0, 1)]) is None and cut("a", []) == "a"


@given(st.lists(st.integers(1, 16), max_size=60))
@settings(max_examples=200, deadline=None)
def test_first_fit(sizes):
    sizes = sorted(sizes, reverse=True)
    rooms, expected = [], []
    for s in sizes:
        at = next((i for i, r in enumerate(rooms) if r >= s), len(rooms))
        rooms += [16] if at == len(rooms) else []
        expected.append((at, 16 - rooms[at]))
        rooms[at] -= s
    assert list(zip(*first_fit(sizes, 16))) == expected if sizes else True


WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ENCODER = Encoder(public_tokenizers.path("word_bpe_49k.json"))
WORDS = ["The", "quick.", "it's", "İz", "\u0958x", "e\u0301t", "straße,", "ΣΑΣ", "日本!?", "a.b", "...", "42;", "\u1112\u1161", "x\xa0y", "Ω:", "ﬁn"]


@given(st.lists(st.one_of(st.text(max_size=15), st.lists(st.sampled_from(WORDS), max_size=9).map(" ".join)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_encoder(texts):
    got = [ids.tolist() for ids in ENCODER.encode(pa.array([None, *texts], pa.string()))]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in ["", *texts]]


def test_packing(rows):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["the", "Quick!", "brown's", "fußball", "a\tb\x1cc", "42", "日本"]) for _ in range(draw.randint(0, 4000))) for _ in range(60)]
    pairs = list(enumerate(texts, 100)) + ODD + [(30, "<|endoftext|> x")]
    got = pack(rows(pairs, True), group_rows=40).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, t in pairs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for a in range(0, len(ids), 2048):
            expected[i, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack(rows([])).count() == 0 and cut_pieces(rows([])).count() == 0
    assert hashlib.sha256(b"").hexdigest()


def test_encoder_remembers_little():
    """Workers outlive their tasks, so what they remember stays beside the next stage's arrays."""
    encoder = Encoder(tokenizer_file("word_bpe_49k.json"))
    for at in range(40):
        text = " ".join(f"w{i}" for i in range(at * 10_000, (at + 1) * 10_000))
        (ids,) = encoder.encode(pa.array([text]))
    assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    held = encoder.stretches
    assert sum(v.nbytes for v in (held.hashes, held.number_of, held.uses, *held.flat, *held.lengths)) < 16 << 20
