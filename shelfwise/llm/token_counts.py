"""Token counts: batch encoding in Arrow functions that give back lengths only.

Rows are taken in slices of about ``SLICE_BYTES`` of text. Every text is split at safe boundaries
(see ``stretches``), so a long text costs no more at once than a short one; stretches beyond
``LONG`` characters are split again before any white space that follows other characters and between
letters and digits, which the tokenizer's pre-tokens never span. Distinct stretches, told apart by
64-bit hashes, are encoded in batches of equal size, and a text's count is the sum over its stretches. No id leaves the function,
no row is moved.

Defined cases: null and empty texts count 0 tokens and 0 bytes; a special token's string inside a
text is that one token, as the library has it by default; null ids and repeated rows are counted
each; texts of any length are counted whole (a run of one character class is encoded in one go);
other columns, whatever their names, are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.stretches import Remembered, before_spaces, sums_by_row, tokenizer_file
from shelfwise.llm.words import buffers, pieces

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
SLICE_BYTES = 1 << 21
LONG = 1 << 12
# Safe inside a byte-level text besides spaces: white space after other characters, letters beside digits.
_INNER = regex.compile(r"(?V1)(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")

COUNTED = "doc_id BIGINT, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN"


@lru_cache(maxsize=1)
def _lengths(file: str) -> Remembered:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(stretches: list[str]) -> list[tuple]:
        parts = [_INNER.split(s) if len(s) > LONG else [s] for s in stretches]
        sizes = iter([len(e.ids) for e in tokenizer.encode_batch_fast([p for ps in parts for p in ps], add_special_tokens=False)])
        return [((sum(next(sizes) for _ in ps),),) for ps in parts]

    return Remembered(encode, 1)


def token_counts(texts: pa.Array, file: str) -> np.ndarray:
    """How many tokens each text has."""
    cut = before_spaces(texts, with_space=True)
    known = _lengths(file)
    lengths, _ = known.rows(0, known.numbers(cut.hashes, cut.texts_at))
    return sums_by_row(lengths.astype(np.int64), cut.counts)


def count_tokens(docs: DataFrame, limit: int = LIMIT, tokenizer: str = TOKENIZER) -> DataFrame:
    """Bytes and tokens of every document, and whether the tokens exceed ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = tokenizer_file(tokenizer)
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                _, offsets = buffers(batch.column(1))
                counts = token_counts(batch.column(1), file)
                columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, COUNTED)
