"""Sequence packing: first-fit decreasing with a tournament tree, in randomised groups.

A document's ids (and the end id) are cut into pieces of the sequence length; the last piece is
shorter. Pieces are dealt into groups by a hash, each of about ``GROUP_ROWS`` documents whatever the
table's size, and packed group by group: longest first, each into the first sequence with room. The
tree holds the largest room of every range of sequences, so the first that fits is found from the
root down. Only lengths and ids of pieces are shuffled, never ids or texts.

Text is encoded in stretches between blanks and line ends, which the tokenizer never joins; the ids
of the stretches most used are remembered, as most stretches repeat. Stretches are told apart by 64-bit hashes.

Defined cases: null is empty and packs its end id alone; a document of any length is cut; equal
lengths are taken by document, start and checksum; repeated rows are packed each; an empty table
gives no piece.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.stretches import Remembered, spans_as_text, sums_by_row, tokenizer_file
from shelfwise.llm.words import BLANKS, pieces, words_of
from shelfwise.scratch import written

LENGTH = 2048
END = 1
GROUP_ROWS = 4096
# Text encoded at a time, and stretches and runs known to a worker at most: workers outlive their tasks.
SLICE_BYTES, REMEMBERED = 1 << 19, 1 << 19
# Marks that may follow a run of letters, in a pre-token of their own.
MARKS = ".,;:!?"
# Runs of letters encoded in one text; strings of marks that are remembered.
JOINED, MOST_MARKS = 1000, 10_000

PIECES = "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, deal BIGINT"
PLACED = "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, `offset` BIGINT"


class Encoder:
    """Texts to ids, by stretches between blanks and line ends.

    Most stretches are one run of letters with marks behind it: a pre-token of its own and the marks'
    pre-token. Such runs are remembered apart from their marks and encoded many in one text; as each
    pre-token's last id closes a word, the ids are told apart by it.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        size = self.tokenizer.get_vocab_size(True)
        self.closes = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        kind = np.uint16 if size <= 1 << 16 else np.int32
        self.stretches = Remembered(self._stretches, 1, REMEMBERED, kind)
        self.runs = Remembered(self._runs, 1, REMEMBERED, kind)
        self.marks: dict[str, list[int]] = {"": []}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs(self, runs: list[str]) -> list[tuple]:
        groups = [runs[at : at + JOINED] for at in range(0, len(runs), JOINED)]
        rows = []
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            ids = np.array(ids)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(group):
                rows += [(part.tolist(),) for part in np.split(ids, ends[:-1])]
            else:  # a letter that the tokenizer takes apart
                rows += [(i,) for i in self._ids(group)]
        return rows

    def _stretches(self, stretches: list[str]) -> list[tuple]:
        rows: list = [None] * len(stretches)
        plain, runs, marks, others = [], [], [], []
        for at, stretch in enumerate(stretches):
            run = stretch.rstrip(MARKS)
            if run.isalpha():
                plain.append(at)
                runs.append(run)
                marks.append(stretch[len(run) :])
            else:
                others.append(at)
        for at, ids in zip(others, self._ids([stretches[at] for at in others])):
            rows[at] = (ids,)
        new = [m for m in set(marks) if m not in self.marks]
        if len(self.marks) + len(new) > MOST_MARKS:
            self.marks, new = {"": []}, list({*marks} - {""})
        self.marks.update(zip(new, self._ids(new)))
        found = words_of(pa.array(runs, pa.string()), BLANKS)
        ids, lengths = self.runs.rows(0, self.runs.numbers(found.hashes, lambda at: [runs[i] for i in at.tolist()]))
        ids, ends = ids.tolist(), np.cumsum(lengths).tolist()
        for at, start, end, mark in zip(plain, [0, *ends], ends, marks):
            rows[at] = (ids[start:end] + self.marks[mark],)
        return rows

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; case is folded as the tokenizer does."""
        words = words_of(texts, BLANKS)
        found = lambda at: spans_as_text(words.data, words.starts[at], words.ends[at])
        ids, lengths = self.stretches.rows(0, self.stretches.numbers(words.hashes, found))
        ends = np.cumsum(sums_by_row(lengths, words.counts()))
        yield from np.split(ids.astype("<u4"), ends[:-1])


@lru_cache(maxsize=1)
def _encoder(file: str) -> Encoder:
    return Encoder(file)


def default_tokenizer() -> str:
    """The name of the tokenizer file; each executor looks up where it lies."""
    return "word_bpe_49k.json"


def cut_pieces(docs: DataFrame, length: int = LENGTH, end: int = END, tokenizer: str | None = None) -> DataFrame:
    """The pieces of every document, with the checksum of their ids."""
    name = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file(name))
        last = np.array([end], dtype="<u4").tobytes()
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                rows = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                    ids = memoryview(ids.tobytes() + last)
                    n = len(ids) // 4
                    for start in range(0, n, length):
                        part = ids[4 * start : 4 * (start + length)]
                        sum_ = zlib.crc32(part)
                        rows.append((doc_id, start, len(part) // 4, sum_, n, zlib.crc32(f"{doc_id}:{start}:{sum_}".encode())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PIECES)


class Rooms:
    """A tournament tree over sequences: each inner node holds the largest room below it."""

    def __init__(self, count: int, room: int):
        self.leaves = 1 << max(0, count - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def take(self, size: int) -> int:
        """Give ``size`` of the first sequence that has room for it; its number."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        most[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            larger = max(most[2 * node], most[2 * node + 1])
            if most[node] == larger:
                break
            most[node] = larger
        return found


def first_fit(sizes: list[int], room: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each of the sizes, taken in the given order."""
    rooms = Rooms(len(sizes), room)
    sequences, offsets, used = [], [], [0] * rooms.leaves
    for size in sizes:
        at = rooms.take(size)
        sequences.append(at)
        offsets.append(used[at])
        used[at] += size
    return sequences, offsets


def pack(
    docs: DataFrame, length: int = LENGTH, end: int = END, tokenizer: str | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    cut = written(cut_pieces(docs, length, end, tokenizer), "pieces")
    # One piece in each document is its last; documents are counted by it.
    groups = max(1, -(-cut.filter(F.col("start") + F.col("length") == F.col("doc_tokens")).count() // group_rows))

    def place(held: pd.DataFrame) -> pd.DataFrame:
        group = int(held["group"].iloc[0])
        held = held.sort_values(
            ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True
        )
        sequences, offsets = first_fit(held["length"].tolist(), length)
        held["sequence_id"] = (np.int64(group) << 32) + np.array(sequences, dtype=np.int64)
        held["offset"] = np.array(offsets, dtype=np.int64)
        return held.drop(columns=["group", "deal"])

    dealt = cut.withColumn("group", F.pmod(F.xxhash64("deal"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(place, PLACED)
