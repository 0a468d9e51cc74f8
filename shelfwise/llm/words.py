"""Hashed words of Arrow text columns, computed on whole byte buffers inside tasks.

``words_of`` gives for each word its 64-bit hash, the byte where it starts and ends, and the row it
lies in. A word's hash is a polynomial in its folded bytes, taken from running sums, then mixed; it
depends on the word alone. Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_ODD = 0x9E3779B97F4A7C15 | 1
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Bytes hashed at a time; a longer word is hashed alone.
_SEGMENT = 1 << 20


def _table(is_word) -> np.ndarray:
    """Folded byte plus one for bytes of words, 0 for separators; A-Z are folded."""
    folded = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return np.array([f + 1 if b < 255 and is_word(b) else 0 for b, f in enumerate(folded)], dtype=np.uint8)


#: Words between the white space of ASCII.
SPACED = _table(lambda b: b not in b" \t\n\x0b\x0c\r")
#: Words between blanks and line ends.
BLANKS = _table(lambda b: b not in b" \n")
#: Words of ASCII letters, digits and everything beyond ASCII.
LETTERED = _table(lambda b: b >= 128 or chr(b).isalnum())


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _FIRST
    x = (x ^ (x >> np.uint64(27))) * _SECOND
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return run(_ODD), run(pow(_ODD, -1, 2**64))


def span_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans, which are in order of their starts and do not overlap."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, base + _SEGMENT, "right")))
        last = ends[upto - 1]
        power, inverse = _powers(max(_SEGMENT, 1 << int(last - base).bit_length()))
        sums = np.zeros(last - base + 1, dtype=np.uint64)
        np.cumsum(folded[base:last] * power[: last - base], out=sums[1:])
        s, e = starts[at:upto] - base, ends[at:upto] - base
        hashes[at:upto] = (sums[e] - sums[s]) * inverse[s]
        at = upto
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


@dataclass
class Words:
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: For each row, the number of the first of its words; one more at the end.
    bounds: np.ndarray
    #: Bytes of all rows, and where each row starts; one more at the end.
    data: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, table: np.ndarray = SPACED) -> Words:
    data, offsets = buffers(texts)
    folded = table[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = folded != 0
    row_start = np.zeros(len(data) + 1, dtype=bool)
    row_start[offsets] = True
    # between byte i-1 and byte i: a word starts, or one ends
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | row_start))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | row_start))
    hashes = span_hashes(folded, starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), data, offsets)


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of pairs, in order."""
    return mix(first * np.uint64(_ODD) + mix(second))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and their rows; a row of fewer words is one run."""
    n, counts = len(words.hashes), words.counts()
    grams = np.zeros(max(0, n - k + 1), dtype=np.uint64)
    for i in range(k):
        grams = mix(grams * np.uint64(_ODD) + words.hashes[i : i + len(grams)])
    rows = words.rows()
    whole = rows[: len(grams)] == rows[k - 1 :] if n >= k else np.zeros(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < k))
    extra = np.zeros(len(short), dtype=np.uint64)
    for i in range(k - 1):
        there = counts[short] > i
        at = np.minimum(words.bounds[short] + i, max(n - 1, 0))
        extra = np.where(there, mix(extra * np.uint64(_ODD) + words.hashes[at]), extra)
    extra = mix(extra + counts[short].astype(np.uint64))
    return np.concatenate([grams[whole], extra]), np.concatenate([rows[: len(grams)][whole], short])


def release_memory() -> None:
    """Give back to the system what freed arrays leave with the allocators; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 24):
    """``batch`` in slices of about ``most_bytes`` of text; a longer row is a slice of its own."""
    _, offsets = buffers(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto
    release_memory()
