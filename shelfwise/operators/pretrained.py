"""Texts encoded by a tokenizer that was trained elsewhere and is read from its file.

Every executor reads the file once; its path is a parameter. Rows stay where they lie, ids are cut,
framed and padded as arrays, a batch at a time. Where a tokenizer never joins text across a space, a
text is encoded span by span until it has its ids, which are the first ids of the whole text.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schema import TEXT

# Characters encoded at a time; a longer text is encoded alone.
AT_ONCE = 1 << 20
# Characters encoded for each id that a text still lacks.
CHARACTERS = 6

# Parts of tokenizers whose work before a space does not depend on what follows.
_NORMALIZERS = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "})
_SPLITS = ("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    return found


def _parts(node: dict | None, name: str) -> list[dict]:
    return [] if node is None else node[name] if node["type"] == "Sequence" else [node]


@lru_cache(maxsize=2)
def _ends_at_spaces(path: str) -> bool:
    """Whether the tokenizer is known to begin anew at a space that follows another character."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    split = (_parts(held.get("pre_tokenizer"), "pretokenizers") or [{"type": None}])[0]
    words = split["type"] == "Split" and split["pattern"].get("Regex") in _SPLITS and split["behavior"] == "Removed" and split["invert"]
    return bool(
        words
        and held["model"]["type"] == "BPE"
        and not held["model"].get("dropout")
        and all(n in _NORMALIZERS for n in _parts(held.get("normalizer"), "normalizers"))
        and not any(c.isspace() for t in held.get("added_tokens", ()) for c in t["content"])
    )


def _span_end(text: str, start: int, most: int) -> int:
    """Where a span of at most ``most`` characters ends before a space that no space precedes; else all is one span."""
    if start + most >= len(text):
        return len(text)
    at = text.rfind(" ", start + 1, start + most + 1)
    while at > start and text[at - 1].isspace():
        at = text.rfind(" ", start + 1, at)
    return at if at > start else len(text)


def _groups(texts: list[str], most: int) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def framed_ids(texts: list[str | None], path: str, start: int, end: int, pad: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and masks of the texts, a row each: start, ids cut to fit, end, padding. Null is empty."""
    tokenizer, most = _tokenizer(path), length - 2
    tokenizer.enable_truncation(most)
    ids = np.full((len(texts), length), pad, np.int32)
    ids[:, 0] = start
    whole, held, done = [t or "" for t in texts], [0] * len(texts), [0] * len(texts)
    while short := [i for i, text in enumerate(whole) if held[i] < most and done[i] < len(text)]:
        spans = []
        for i in short:
            begun = done[i]
            done[i] = _span_end(whole[i], begun, CHARACTERS * (most - held[i]) + 64) if _ends_at_spaces(path) else len(whole[i])
            spans.append(whole[i][begun : done[i]])
        encoded = (e.ids for group in _groups(spans, AT_ONCE) for e in tokenizer.encode_batch_fast(group, add_special_tokens=False))
        for i, more in zip(short, encoded):
            more = more[: most - held[i]]
            ids[i, 1 + held[i] : 1 + held[i] + len(more)] = more
            held[i] += len(more)
    ends = 1 + np.array(held, dtype=np.int64)
    ids[np.arange(len(texts)), ends] = end
    mask = (np.arange(length) <= ends[:, None]).astype(np.int32)
    return ids, mask


def encode_pretrained(
    df: DataFrame, path: str, start: int, end: int, pad: int, max_length: int = 512, text: str = TEXT
) -> DataFrame:
    """Replace the text by ``input_ids`` and ``attention_mask``, both ``max_length`` long.

    ``path`` is a tokenizer file that every executor can open; ``start``, ``end`` and ``pad`` are ids of its
    vocabulary. Null and empty texts have their frame alone; an empty table gives an empty one.
    """
    if max_length < 2:
        raise ValueError("no room for the first and last id")
    kept = [c for c in df.columns if c not in (text, "input_ids", "attention_mask")]
    lists = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [df.schema[c] for c in kept] + [T.StructField(n, lists) for n in ("input_ids", "attention_mask")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, texts = batch.columns
            bounds = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * max_length)
            found = framed_ids(texts.to_pylist(), path, start, end, pad, max_length)
            arrays = [pa.ListArray.from_arrays(bounds, pa.array(x.ravel())) for x in found]
            yield pa.RecordBatch.from_arrays([*others, *arrays], names=schema.names)

    return df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)
