import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwise.llm import token_alignment, token_counts
from shelfwise.llm.stretches import Remembered, before_spaces, byte_batches, ragged, sums_by_row
from shelfwise.llm.token_alignment import Aligner, align, shared_ends
from shelfwise.llm.token_counts import count_tokens
from tests.llm.conftest import ODD

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
WHOLE, PLAIN = Tokenizer.from_file(A), Tokenizer.from_file(A)
PLAIN.encode_special_tokens = True
PARTS = ["a", "the", " ", "  ", "\n", "\t", "\xa0", "　", "\x1c", "\x85", "it's", "'", "12", "9x", "日本", "É", "é", "​", "😀", ".", "!?", "<|endoftext|>", "<s>", "\x00", "\r\n", " ", "ñoqui", "_", "᠎", "½", "Ⅷ"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=25).map("".join)


@given(st.lists(st.one_of(TEXTS, st.text(max_size=20)), max_size=8))
@settings(max_examples=400, deadline=None)
def test_counts_of_stretches(texts):
    held = pa.array([*texts, None], pa.string())
    got = token_counts.token_counts(held, A).tolist()
    assert got == [len(WHOLE.encode(t, add_special_tokens=False).ids) for t in texts] + [0]
    for with_space in (True, False):
        cut, at = before_spaces(held, with_space), 0
        for t, n in zip([*texts, ""], cut.counts.tolist()):
            found = cut.texts_at(np.arange(at, at + n))
            assert ("" if with_space else " ").join(found) == t and (not t) == (n == 0)
            at += n


def test_long_stretches():
    draw = random.Random(1)
    texts = ["".join(draw.choice(["ab", "12", "\n", ".", "é", "\n\n", "\t"]) for _ in range(9000)), "x" * 30000, "\n" * 9000, " " * 9000]
    got = token_counts.token_counts(pa.array(texts), A).tolist()
    assert got == [len(WHOLE.encode(t, add_special_tokens=False).ids) for t in texts]
    assert max(map(len, token_counts._INNER.split(texts[0]))) < token_counts.LONG


def test_token_counts(rows):
    pairs = [*ODD, (50, "<|endoftext|> and it's  two"), (51, "a " * 600)]
    got = count_tokens(rows(pairs, True)).collect()
    size = lambda t: len(WHOLE.encode(t or "", add_special_tokens=False).ids)
    expected = Counter((i, len((t or "").encode()), size(t), size(t) > 512) for i, t in pairs)
    assert Counter(map(tuple, got)) == expected
    assert count_tokens(rows([])).count() == 0


def test_remembered():
    asked = []

    def encode(batch):
        asked.extend(batch)
        return [([ord(c) for c in s], [len(s)]) for s in batch]

    known = Remembered(encode, 2, most=8)
    draw = random.Random(2)
    for _ in range(50):
        texts = ["a", "b" * 3] + ["".join(draw.choices("abcdefgh", k=draw.randint(0, 4))) for _ in range(6)]
        numbers = known.numbers(np.array([int.from_bytes(t.encode()) for t in texts], np.uint64), lambda at: [texts[i] for i in at])
        ids, lengths = known.rows(0, numbers)
        assert "".join(map(chr, ids)) == "".join(texts) and lengths.tolist() == [len(t) for t in texts]
        assert known.rows(1, numbers)[0].tolist() == [len(t) for t in texts]
    assert asked.count("a") == 1 and len(known.hashes) <= 8 + 8
    assert known.numbers(np.zeros(0, np.uint64), None).tolist() == [] and list(byte_batches(["ab", "c", "defg"], 3)) == [["ab", "c"], ["defg"]]
    assert ragged(np.array([5, 0]), np.array([2, 0])).tolist() == [5, 6]
    assert sums_by_row(np.array([1, 2, 3]), np.array([0, 2, 0, 1])).tolist() == [0, 3, 0, 3]


@given(st.lists(st.tuples(*[st.lists(st.integers(1, 40), max_size=12)] * 2, st.integers(41, 60)), max_size=40), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_shared_ends(stretches, lane):
    ends_a, ends_b, of_a, of_b, at = [], [], [], [], 0
    for a, b, last in stretches:
        a, b = sorted({*a, last}), sorted({*b, last})
        ends_a += [at + e for e in a]
        ends_b += [at + e for e in b]
        of_a.append(len(a))
        of_b.append(len(b))
        at += last
    kept, token_alignment.LANE = token_alignment.LANE, lane
    try:
        got = shared_ends(*(np.array(x, dtype=np.int64) for x in (ends_a, ends_b, of_a, of_b)))
    finally:
        token_alignment.LANE = kept
    both = {*ends_a} & {*ends_b}
    assert got[0].tolist() == [e in both for e in ends_a] and got[1].tolist() == [e in both for e in ends_b]


def brute(texts):
    """Ids of whole texts, and groups cut where both sides' joined bytes are equally long."""
    left, right = PLAIN, sentencepiece.SentencePieceProcessor(model_file=B)
    byte = token_alignment._byte_of_character()
    out, count = [], Counter()
    for t in texts:
        a = b = []
        if t:
            a = [(i, bytes(byte[c] for c in left.id_to_token(i))) for i in left.encode(" " + t, add_special_tokens=False).ids]
            b = []
            for i in right.encode(t):
                piece = right.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()))
            if any(b"".join(x for _, x in side) != (" " + t).encode() for side in (a, b)):
                a = b = []
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
        ending = [dict(zip(of, side)) for of, side in zip(ends, (a, b))]
        shared, groups, start = sorted({*ends[0]} & {*ends[1]}), [], [0, 0]
        links = [(ending[0][e][0], ending[1][e][0]) for e in shared]
        for e in shared:
            stop = [of.index(e, s) + 1 for of, s in zip(ends, start)]
            inside = [",".join(str(i) for i, _ in side[s:t]) for side, s, t in zip((a, b), start, stop)]
            groups.append("|".join(inside))
            start = stop
        text = ";".join(groups)
        out.append((len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if text else ""))
        count.update(links)
    highest = Counter()
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links), digest)
        for n_a, n_b, n_groups, links, digest in out
    ]


@given(st.lists(st.one_of(TEXTS, st.text(max_size=20)), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_aligner(texts):
    if not hasattr(test_aligner, "made"):
        test_aligner.made = Aligner(A, B)
    codes, n_a, n_b, n_links, digests = test_aligner.made.align(pa.array([None, *texts, ""], pa.string()))
    got = list(zip(n_a.tolist(), n_b.tolist(), n_links.tolist(), digests))
    assert got == [(x[0], x[1], x[2], x[6]) for x in brute([None, *texts, ""])]
    assert len(codes) == n_links.sum()


def test_alignment(rows, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 4000)
    draw = random.Random(3)
    texts = ["".join(draw.choice(PARTS + ["the cat", " of ", "thonreou "]) for _ in range(draw.randint(0, 120))) for _ in range(40)]
    short = [(i, t if t is None or len(t) < 9000 else t[:3000]) for i, t in ODD]
    pairs = [*enumerate(texts, 100), *short, (60, "a▁b"), (61, "<s> <|endoftext|>")]
    got = align(rows(pairs, True).repartition(3)).collect()
    expected = Counter((i, *x) for (i, _), x in zip(pairs, brute([t for _, t in pairs])))
    assert Counter(map(tuple, got)) == expected
    assert align(rows([])).count() == 0


def test_vocabulary_that_spans_spaces(monkeypatch):
    class Model:
        def __init__(self, model_file):
            pass

        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError):
        token_alignment.sentence_pieces("x.model")
