"""Whole-number arrays as compact bytes, kept exactly, for columns of blocks that are shuffled or written.

Numbers are cut to the bytes that the largest one needs, their bytes laid out by significance and
compressed; sorted numbers are kept as steps. Each form carries its length.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

_HEAD = struct.Struct("<QB")


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 to 2**64 - 1."""
    numbers = np.ascontiguousarray(numbers, dtype="<u8")
    width = (int(numbers.max()).bit_length() + 7) // 8 if len(numbers) else 0
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :width].T
    return _HEAD.pack(len(numbers), width) + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size, width = _HEAD.unpack_from(data)
    out = np.zeros((size, 8), np.uint8)
    if width:
        raw = pa.Codec("zstd", 1).decompress(data[_HEAD.size :], size * width, asbytes=True)
        out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, size).T
    return out.reshape(-1).view("<u8").astype(np.uint64, copy=False)


def packed_sorted(numbers: np.ndarray) -> bytes:
    """Numbers in rising order; the first one is kept whole."""
    numbers = np.asarray(numbers, dtype=np.uint64)
    first = int(numbers[0]) if len(numbers) else 0
    return struct.pack("<Q", first) + packed(np.diff(numbers, prepend=numbers[:1]))


def unpacked_sorted(data: bytes) -> np.ndarray:
    (first,) = struct.unpack_from("<Q", data)
    return np.cumsum(unpacked(data[8:]), dtype=np.uint64) + np.uint64(first)
