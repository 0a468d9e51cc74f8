"""Cross-tokenizer alignment by skipping along diagonals.

Both tokenizers encode a space and the text; the byte ends of their tokens are two increasing
arrays. At the current shift between the two indexes, ends are compared in spans that double as long
as all agree: a stretch of one-to-one tokens is jumped in a few probes. Where ends differ, the group
is resolved locally, by moving on in the array whose end lies behind until both ends meet, and the
shift changes to what the group left. Texts are cut into lanes at stretch boundaries (where both
tokenizers end) and all lanes of a block of texts take their probes together, on arrays.

A link is a pair of tokens that end together. A pair of ids is counted over all documents: a block
gives its distinct pairs with their counts once, these are summed, and the sums come back to each
block by a join on pairs. A block's text is bounded, so nothing grows with the corpus but the number
of rows; the highest count of each right-hand id is a table of at most that vocabulary's size.

Defined cases: a text that is null, empty or not given back by either tokenizer byte for byte has no
tokens: zeros, and an empty string of groups, unhashed. Special tokens' strings are plain text. Stretches are told
apart by 64-bit hashes. Null
ids and repeated rows are aligned and counted each. Counts of equal size are all highest. Texts of
any length are aligned whole; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.stretches import Remembered, before_spaces, ragged, sums_by_row, tokenizer_file
from shelfwise.llm.words import pieces
from shelfwise.scratch import written

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 1 << 21
#: Tokens of a lane, about: many short lanes advance together.
LANE = 256
#: Rows of the table of highest counts that may be broadcast; no vocabulary in use comes near.
MOST_IDS = 1 << 20

BLOCKS = (
    "pairs ARRAY<BIGINT>, counts ARRAY<BIGINT>, links BINARY, doc_ids ARRAY<BIGINT>, n_a ARRAY<BIGINT>, "
    "n_b ARRAY<BIGINT>, n_links ARRAY<BIGINT>, digests ARRAY<STRING>"
)
ALIGNED = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, "
    "count_sum BIGINT, groups_sha256 STRING"
)


def _byte_of_character() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Side:
    """A tokenizer: ids of a space and a text, and the bytes of each id."""

    encode: object
    bytes_of: list[bytes]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(b) for b in self.bytes_of], dtype=np.int64)


def byte_level(file: str) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.encode_special_tokens = True
    byte = _byte_of_character()
    entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(True))]
    bytes_of = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    return Side(encode, bytes_of)


def sentence_pieces(file: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    entries = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("▁" in e.lstrip("▁") for e in entries):
        raise ValueError("this vocabulary joins words over spaces: texts cannot be cut before them")
    bytes_of = [
        bytes([int(e[3:5], 16)]) if model.is_byte(i) else e.replace("▁", " ").encode() for i, e in enumerate(entries)
    ]
    space = [model.piece_to_id("▁")]

    def encode(texts: list[str]) -> list[list[int]]:
        # the model adds its space to a text, but gives nothing for an empty one
        return [ids if text else space for text, ids in zip(texts, model.encode(texts, num_threads=1))]

    return Side(encode, bytes_of)


def _side(name: str) -> Side:
    file = tokenizer_file(name)
    return byte_level(file) if file.endswith(".json") else sentence_pieces(file)


class Aligner:
    """Both tokenizers with the ids of remembered stretches."""

    def __init__(self, left: str, right: str):
        self.a, self.b = _side(left), _side(right)
        self.size_a, self.size_b = self.a.sizes, self.b.sizes
        self.known = Remembered(self._encode, 3)
        # decimal text of every id, right-aligned, and its width
        most = max(len(self.size_a), len(self.size_b))
        self.digits = np.array([f"{i:>6}" for i in range(most)], dtype="S6").view(np.uint8).reshape(most, 6)
        self.widths = np.array([len(str(i)) for i in range(most)], dtype=np.int64)
        if most > 999_999:
            raise ValueError("ids of more than six digits")

    def _encode(self, stretches: list[str]) -> list[tuple]:
        """Ids of both sides, and one flag: whether both give the stretch back byte for byte."""
        rows = []
        for text, a, b in zip(stretches, self.a.encode(stretches), self.b.encode(stretches)):
            whole = (" " + text).encode()
            same = all(b"".join([side.bytes_of[i] for i in ids]) == whole for side, ids in ((self.a, a), (self.b, b)))
            rows.append((a, b, (int(same),)))
        return rows

    def align(self, texts: pa.Array) -> tuple:
        """Pair codes of all links in order; of each text its left ids, right ids and links; digests."""
        cut = before_spaces(texts, with_space=False)
        counts, numbers = cut.counts, self.known.numbers(cut.hashes, cut.texts_at)
        same, _ = self.known.rows(2, numbers)
        good = sums_by_row(1 - same.astype(np.int64), counts) == 0
        numbers = numbers[np.repeat(good, counts)]
        counts = np.where(good, counts, 0)
        a, of_a = self.known.rows(0, numbers)
        b, of_b = self.known.rows(1, numbers)
        n_a, n_b = sums_by_row(of_a, counts), sums_by_row(of_b, counts)
        at_a, at_b = shared_ends(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), of_a, of_b)
        n_links = sums_by_row(at_a.astype(np.int64), n_a)
        codes = (a[at_a].astype(np.int64) << 32) | b[at_b]
        return codes, n_a, n_b, n_links, self._digests(a, b, at_a, at_b, n_a, n_b)

    def _digests(self, a, b, at_a, at_b, n_a, n_b) -> list[str]:
        """Digests of the groups' texts: every id in decimals and the mark that follows it."""
        # tokens of earlier groups on the other side, plus for the right side those of its own group
        group_a = np.cumsum(at_a) - at_a
        group_b = np.cumsum(at_b) - at_b
        ends_a = np.concatenate([[0], np.flatnonzero(at_a) + 1])
        ends_b = np.concatenate([[0], np.flatnonzero(at_b) + 1])
        place_a = np.arange(len(a)) + ends_b[group_a] if len(a) else np.zeros(0, np.int64)
        place_b = np.arange(len(b)) + ends_a[group_b + 1] if len(b) else np.zeros(0, np.int64)
        total = len(a) + len(b)
        text = np.empty((total, 7), dtype=np.uint8)
        width = np.empty(total, dtype=np.int64)
        for ids, place, ends, mark in ((a, place_a, at_a, b"|"), (b, place_b, at_b, b";")):
            text[place, :6] = self.digits[ids]
            text[place, 6] = np.where(ends, mark[0], b","[0])
            width[place] = self.widths[ids] + 1
        shown = (np.arange(7)[None, :] >= 7 - width[:, None]).ravel()
        flat = memoryview(text.ravel()[shown])
        size = sums_by_row(width, n_a + n_b)
        ends = np.cumsum(size)
        return [
            hashlib.sha256(flat[end - n : end - 1]).hexdigest() if n else "" for end, n in zip(ends.tolist(), size.tolist())
        ]


def shared_ends(ends_a: np.ndarray, ends_b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the tokens on either side that end where one of the other side ends.

    Ends increase along all texts. ``of_a`` and ``of_b`` count the tokens of each stretch, at whose
    last both sides end; lanes are cut there.
    """
    at_a, at_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    if not len(ends_a):
        return at_a, at_b
    upto = np.cumsum(of_a)
    lane_ends = np.unique(np.append(np.searchsorted(upto, np.arange(LANE, upto[-1], LANE)), len(upto) - 1))
    stop_a, stop_b = upto[lane_ends], np.cumsum(of_b)[lane_ends]
    i, j = np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1])
    width = np.full(len(i), 2)
    while len(i):
        # probe: the next ``width`` ends at the present shift
        span = np.minimum(width, np.minimum(stop_a - i, stop_b - j))
        flat_a = ragged(i, span)
        first = np.cumsum(span) - span
        equal = ends_a[flat_a] == ends_b[flat_a + np.repeat(j - i, span)]
        place = np.arange(len(flat_a)) - np.repeat(first, span)
        run = np.minimum.reduceat(np.where(equal, np.repeat(span, span), place), first)
        jumped = place < np.repeat(run, span)
        at_a[flat_a[jumped]] = True
        at_b[(flat_a + np.repeat(j - i, span))[jumped]] = True
        i, j = i + run, j + run
        whole = run == span
        width = np.where(whole, 2 * width, 2)
        # irregular groups: whichever side lies behind moves on until both ends meet
        lanes = np.flatnonzero(~whole)
        x, y, open_ = i[lanes], j[lanes], np.arange(len(lanes))
        while len(open_):
            a, b = ends_a[x[open_]], ends_b[y[open_]]
            x[open_] += a < b
            y[open_] += b < a
            open_ = open_[a != b]
        at_a[x] = True
        at_b[y] = True
        i[lanes], j[lanes] = x + 1, y + 1
        going = i < stop_a
        i, j, width, stop_a, stop_b = i[going], j[going], width[going], stop_a[going], stop_b[going]
    return at_a, at_b


@lru_cache(maxsize=1)
def _aligner(left: str, right: str) -> Aligner:
    return Aligner(left, right)


def aligned_blocks(docs: DataFrame, left: str, right: str) -> DataFrame:
    """One row for each block of documents: its distinct pairs, their counts, and the links by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(left, right)
        for whole in batches:
            for batch in pieces(whole, "text", BLOCK_BYTES):
                codes, n_a, n_b, n_links, digests = aligner.align(batch.column(1))
                pairs, links, counts = np.unique(codes, return_inverse=True, return_counts=True)
                links = links.astype("<u2" if len(pairs) <= 1 << 16 else "<u4")
                columns = [pairs, counts, links.tobytes(), batch.column(0).to_pylist(), n_a, n_b, n_links, digests]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], t) for c, t in zip(columns, _BLOCK_TYPES)], names=_BLOCK_NAMES
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, BLOCKS)


_LONGS = pa.list_(pa.int64())
_BLOCK_NAMES = ["pairs", "counts", "links", "doc_ids", "n_a", "n_b", "n_links", "digests"]
_BLOCK_TYPES = [_LONGS, _LONGS, pa.binary(), _LONGS, _LONGS, _LONGS, _LONGS, pa.list_(pa.string())]


def _longs(column: pa.Array) -> np.ndarray:
    return column.values[column.offsets[0].as_py() : column.offsets[-1].as_py()].to_numpy(zero_copy_only=False)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of blocks whose pairs came back with their counts over all documents."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            get = lambda name: row.column(row.schema.get_field_index(name))
            places, totals, best = (_longs(get(n)) for n in ("places", "totals", "best"))
            total_of, best_of = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
            total_of[places], best_of[places] = totals, best
            links = np.frombuffer(get("links")[0].as_py(), "<u2" if len(places) <= 1 << 16 else "<u4")
            n_links = _longs(get("n_links"))
            yield pa.RecordBatch.from_arrays(
                [
                    get("doc_ids").flatten(),
                    *(pa.array(_longs(get(n))) for n in ("n_a", "n_b", "n_links", "n_links")),
                    pa.array(sums_by_row(best_of[links], n_links)),
                    pa.array(sums_by_row(total_of[links], n_links)),
                    get("digests").flatten(),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``total`` links over all documents, ``best`` (1 where no other pair of its right id has more)."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    totals = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("total"))
    totals = written(totals.withColumn("right", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pair-counts")
    highest = written(totals.groupBy("right").agg(F.max("total").alias("highest")), "highest")
    small = F.broadcast(highest) if highest.count() <= MOST_IDS else highest
    return totals.join(small, "right").select("pair", "total", (F.col("total") == F.col("highest")).cast("bigint").alias("best"))


def align(docs: DataFrame, left: str = LEFT, right: str = RIGHT) -> DataFrame:
    """Every document's tokens, groups and links between the two tokenizers."""
    blocks = written(aligned_blocks(docs, left, right).withColumn("block", F.monotonically_increasing_id()), "aligned")
    each = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = (
        each.join(pair_counts(blocks), "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct(F.col("place").cast("bigint").alias("place"), "total", "best")).alias("found"))
        .select("block", *(F.col("found")[n].alias(m) for n, m in (("place", "places"), ("total", "totals"), ("best", "best"))))
    )
    held = blocks.drop("pairs", "counts").join(answers, "block", "left")
    empty = F.array().cast("array<bigint>")
    held = held.select(
        *(F.coalesce(n, empty).alias(n) for n in ("places", "totals", "best")), "links", "doc_ids", "n_a", "n_b", "n_links", "digests"
    )
    return held.mapInArrow(_scored, ALIGNED)
