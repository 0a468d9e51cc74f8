"""Texts cut where tokenizers never join, and remembered encodings of the stretches between the cuts.

A space after a character that is no white space begins a new token in every tokenizer used here:
byte-level pre-tokens never end in a space that follows a letter, digit or mark, and the pieces of a
sentence-piece vocabulary hold a space at their front alone. So a text's ids are those of its
stretches, one after the other. Most stretches repeat; each is encoded once and remembered, and when
too many are known the less used ones are forgotten.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from shelfwise.llm.words import buffers, span_hashes

#: Stretches known to a worker at most, beyond those of the slice in work.
REMEMBERED = 1 << 20
#: Characters handed to a tokenizer at a time; its results are large.
ENCODED_AT_ONCE = 1 << 18


def tokenizer_file(name: str) -> str:
    """Where a tokenizer's file lies on this machine; a name without folders is a public one."""
    import public_tokenizers

    return name if os.path.sep in name else public_tokenizers.path(name)


def byte_batches(stretches: list[str], most: int = ENCODED_AT_ONCE) -> Iterator[list[str]]:
    """The stretches in batches of about ``most`` characters; a longer one is a batch of its own."""
    batch, size = [], 0
    for stretch in stretches:
        if batch and size + len(stretch) > most:
            yield batch
            batch, size = [], 0
        batch.append(stretch)
        size += len(stretch)
    if batch:
        yield batch


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of all spans, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class Remembered:
    """Numbers for stretches, told apart by their 64-bit hashes, and rows of integers for the numbers.

    ``encode`` gives for a batch of stretches one row for each: a tuple with a sequence of integers
    for each of ``width`` tables, which ``kind`` can hold.
    """

    def __init__(self, encode: Callable[[list[str]], list[tuple]], width: int, most: int = REMEMBERED, kind: type = np.int32):
        self.encode, self.width, self.most, self.kind = encode, width, most, kind
        # known hashes in order, with their numbers
        self.hashes, self.number_of = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat = [np.zeros(0, kind) for _ in range(width)]
        self.lengths = [np.zeros(0, np.int32) for _ in range(width)]
        self.uses = np.zeros(0, np.uint32)

    def _learn(self, stretches: list[str]) -> None:
        flat, lengths = [[] for _ in range(self.width)], [[] for _ in range(self.width)]
        for batch in byte_batches(stretches):
            for row in self.encode(batch):
                for t, ids in enumerate(row):
                    flat[t].extend(ids)
                    lengths[t].append(len(ids))
        for t in range(self.width):
            self.flat[t] = np.append(self.flat[t], np.array(flat[t], self.kind))
            self.lengths[t] = np.append(self.lengths[t], np.array(lengths[t], np.int32))
        self.uses = np.append(self.uses, np.zeros(len(stretches), np.uint32))

    def _keep_used(self) -> None:
        """Forget the less used half."""
        kept = np.sort(np.argsort(self.uses, kind="stable")[-(self.most // 2) :])
        new = np.full(len(self.uses), -1, np.int32)
        new[kept] = np.arange(len(kept), dtype=np.int32)
        there = new[self.number_of] >= 0
        self.hashes, self.number_of = self.hashes[there], new[self.number_of[there]]
        for t in range(self.width):
            self.flat[t], lengths = self.rows(t, kept)
            self.lengths[t] = lengths.astype(np.int32)
        self.uses = self.uses[kept] >> 1

    def numbers(self, hashes: np.ndarray, stretches_at: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """The number of each stretch, valid until the next call; unknown ones are asked for by place."""
        if len(self.hashes) > self.most:
            self._keep_used()
        distinct, first, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            self.number_of = np.insert(self.number_of, at[new], len(self.uses) + np.arange(len(new)))
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self._learn(stretches_at(first[new]))
        found = self.number_of[np.searchsorted(self.hashes, distinct)]
        self.uses[found] += counts.astype(np.uint32)
        return found[inverse]

    def rows(self, table: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The integers of ``table`` for the numbers, one after the other, and how many each has."""
        ends = np.cumsum(self.lengths[table], dtype=np.int64)[numbers]
        lengths = self.lengths[table][numbers].astype(np.int64)
        return self.flat[table][ragged(ends - lengths, lengths)], lengths


#: Bytes of a character's end that may be white space: those of ASCII, and any byte of other characters.
_WHITE = np.array([b in (*range(9, 14), *range(28, 33)) for b in range(256)])
#: First bytes of the three-byte characters among which there is white space.
_WHITE_LEADS = np.array([b in (0xE1, 0xE2, 0xE3) for b in range(256)])
#: Every byte plus one; no byte of UTF-8 is 255.
_BYTES = np.minimum(np.arange(256) + 1, 255).astype(np.uint8)


@dataclass
class Stretches:
    """The stretches of a slice of texts: byte spans, their hashes, and how many each text has."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray

    def texts_at(self, places: np.ndarray) -> list[str]:
        return spans_as_text(self.data, self.starts[places], self.ends[places])


def spans_as_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    whole = memoryview(data)
    return [str(whole[a:b], "utf-8") for a, b in zip(starts.tolist(), ends.tolist())]


def before_spaces(texts: pa.Array, with_space: bool) -> Stretches:
    """Texts cut before each space that follows a character other than white space.

    A space that is cut before belongs to the stretch it begins, or to none. A space behind a
    character of which the last bytes leave open whether it is white space is not cut before.
    """
    data, offsets = buffers(texts)
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    spaces = np.flatnonzero(data == 32)
    spaces = np.setdiff1d(spaces, row_starts, assume_unique=True)
    before = data[spaces - 1]
    unclear = (data[np.maximum(spaces - 2, 0)] == 0xC2) | _WHITE_LEADS[data[np.maximum(spaces - 3, 0)]]
    cuts = spaces[~(_WHITE[before] | ((before >= 0x80) & unclear))]
    starts = np.concatenate([row_starts, cuts])
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    ends = np.append(starts[1:], len(data))[: len(starts)]
    counts = np.diff(np.searchsorted(starts, offsets))
    if not with_space:
        starts = starts + (order >= len(row_starts))
    return Stretches(data, starts, ends, counts, span_hashes(_BYTES[data], starts, ends))


def sums_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the values of each row, of which row ``r`` has ``counts[r]``."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]
