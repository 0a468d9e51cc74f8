"""Language of a text as a mixture of languages.

A word's likelihood in a language is the product of its letters' chances after up to three letters
before them, from hashed counts of 3- and 4-byte windows. A text is taken for words drawn from a
mixture of languages; expectation-maximisation estimates their proportions. Language sets are
nested by those proportions and chosen by likelihood less a penalty for each further language; the
language with the largest share in the chosen set is the prediction, its share the score.

The counts come from a bounded sample of labelled rows: about ``SAMPLE_ROWS`` of each language.
The model has ``BINS`` rows for each language and may be sent to tasks for up to ``MOST_LABELS`` of them.

Defined cases: null texts and texts without letters are ``und`` with score 0, as are all texts
where nothing was learned; labels of null count as none; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.folds import bounded_sample, fold, row_key, without_rows
from shelfwise.llm.words import buffers, pieces
from shelfwise.scratch import written

SAMPLE_ROWS = 2000
BINS = 1 << 15
SMOOTHING, ROUNDS, PENALTY = 2.0, 10, 2.0
UNKNOWN = "und"
# Text taken at a time: some hundred bytes of arrays stand behind each of its bytes.
SLICE_BYTES = 1 << 18

# Folded letters; 0 for what stands between words.
_LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
RESULT = "doc_id BIGINT, held_out BOOLEAN, lang_pred STRING, score DOUBLE, languages ARRAY<STRING>, shares ARRAY<DOUBLE>"


@dataclass
class Windows:
    """Bins of the windows at all letters and word ends, and where words and rows begin."""

    long: np.ndarray
    short: np.ndarray
    word_starts: np.ndarray
    row_words: np.ndarray
    latin: np.ndarray


def _bin(window: np.ndarray) -> np.ndarray:
    return (window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (BINS.bit_length() - 1))


def windows_of(texts: pa.Array) -> Windows:
    data, offsets = buffers(texts)
    rows = len(offsets) - 1
    padded = np.zeros(len(data) + rows + 4, np.uint8)  # a gap before the first row and after each
    padded[np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets)) + 3] = _LETTERS[data]
    back = [padded[3 - i : len(padded) - i].astype(np.uint64) for i in range(4)]
    back[2][back[1] == 0] = 0
    back[3][back[2] == 0] = 0
    used = (back[0] > 0) | (back[1] > 0)
    context = (back[3] << np.uint64(16)) | (back[2] << np.uint64(8)) | back[1]
    at = np.flatnonzero(used)
    starts = np.flatnonzero((back[0] > 0) & (back[1] == 0))
    window = (context[at] << np.uint64(8)) | back[0][at] | np.uint64(1 << 40)
    row_from = offsets + np.arange(rows + 1)
    latin = np.add.reduceat(((back[0] >= 97) & (back[0] <= 122)).astype(np.int64), row_from[:-1]) > 0 if rows else np.zeros(0, bool)
    return Windows(_bin(window), _bin(context[at]), np.searchsorted(at, starts), np.searchsorted(starts, row_from), latin)


@dataclass
class Model:
    names: list[str]
    long: np.ndarray
    short: np.ndarray

    @staticmethod
    def from_counts(names: list[str], long: np.ndarray, short: np.ndarray) -> Model:
        return Model(
            names, np.log(long + SMOOTHING / 64).astype(np.float32), np.log(short + SMOOTHING).astype(np.float32)
        )

    def word_likelihoods(self, w: Windows) -> np.ndarray:
        if not len(w.word_starts):
            return np.zeros((0, len(self.names)))
        return np.add.reduceat(self.long[w.long] - self.short[w.short], w.word_starts, axis=0).astype(np.float64)


def estimated(words: np.ndarray, bounds: np.ndarray, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in each row after some rounds of EM, and the rows' log-likelihoods.

    ``words`` has a row of log-likelihoods for each word; rows of texts have one word at least.
    """
    counts = np.diff(bounds)
    top = words.max(axis=1, keepdims=True)
    chance = np.exp(words - top)
    for _ in range(rounds):
        each = np.repeat(shares, counts, axis=0) * chance
        each /= each.sum(axis=1, keepdims=True) + 1e-300
        shares = np.add.reduceat(each, bounds[:-1], axis=0) / counts[:, None]
    mixed = (np.repeat(shares, counts, axis=0) * chance).sum(axis=1)
    return shares, np.add.reduceat(np.log(mixed + 1e-300) + top[:, 0], bounds[:-1])


def chosen(words: np.ndarray, bounds: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """For each row of texts the shares of the languages in its best set, 0 outside it."""
    rows, languages = len(bounds) - 1, words.shape[1]
    if not rows:
        return np.zeros((0, languages))
    counts = np.diff(bounds)
    price = penalty * np.log(counts + 1.0)
    full, best_possible = estimated(words, bounds, np.full((rows, languages), 1.0 / languages), rounds)
    order = np.argsort(-full, axis=1, kind="stable")
    alone = np.add.reduceat(words, bounds[:-1], axis=0)[np.arange(rows), order[:, 0]]
    out = np.zeros((rows, languages))
    out[np.arange(rows), order[:, 0]] = 1.0
    score = alone.copy()
    for size in range(2, languages + 1):
        # a larger set cannot beat the best possible likelihood less its price
        open_ = np.flatnonzero(best_possible - (size - 1) * price > score)
        if not len(open_):
            break
        kept = np.zeros((len(open_), languages))
        np.put_along_axis(kept, order[open_, :size], 1.0, axis=1)
        mine = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in open_])
        starts = np.concatenate([[0], np.cumsum(counts[open_])])
        begun = kept * (full[open_] + 1e-6)
        shares, value = estimated(words[mine], starts, begun / begun.sum(axis=1, keepdims=True), rounds)
        value -= (size - 1) * price[open_]
        better = value > score[open_]
        score[open_[better]] = value[better]
        out[open_[better]] = shares[better]
    return out


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model of a bounded sample of the rows with a language."""
    learned = bounded_sample(docs.filter(F.col("lang").isNotNull()).select("doc_id", "text", "lang"), "lang", "doc_id", sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                langs = np.array(batch.column(0).to_pylist(), dtype=object)
                for lang in dict.fromkeys(langs.tolist()):
                    w = windows_of(batch.column(1).filter(pa.array(langs == lang)))
                    held.setdefault(lang, np.zeros(2 * BINS, np.int64))
                    held[lang] += np.bincount(w.long.astype(np.int64), minlength=2 * BINS)
                    held[lang][BINS:] += np.bincount(w.short.astype(np.int64), minlength=BINS)
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(counts[at])], names=["lang", "slot", "n"]
            )

    summed = (
        learned.select("lang", "text").mapInArrow(count, "lang STRING, slot BIGINT, n BIGINT").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    )
    found = summed.toArrow()
    langs = np.array(found.column("lang").to_pylist(), dtype=object)
    names = sorted(set(langs.tolist()))
    counts = np.zeros((2 * BINS, len(names)))
    for i, name in enumerate(names):
        mine = langs == name
        counts[found.column("slot").to_numpy()[mine], i] = found.column("n").to_numpy()[mine]
    return Model.from_counts(names, counts[:BINS], counts[BINS:])


def _has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def predict(docs: DataFrame, model: Model, held_out: str = "held_out") -> DataFrame:
    """The language of every document, from its text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.names, UNKNOWN], dtype=object)
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                w = windows_of(batch.column(2))
                counts = np.diff(w.row_words)
                lettered = w.latin.copy()
                for i in np.flatnonzero((counts > 0) & ~lettered):
                    lettered[i] = _has_letter(batch.column(2)[int(i)].as_py())
                at = np.flatnonzero(lettered & (len(model.names) > 0))
                shares = np.zeros((batch.num_rows, len(names)))
                if len(at):
                    words = model.word_likelihoods(w)
                    judged = np.flatnonzero(counts > 0)
                    shares[judged, :-1] = chosen(words, np.concatenate([[0], np.cumsum(counts[judged])]))
                best = np.full(batch.num_rows, len(names) - 1)
                best[at] = shares[at].argmax(axis=1)
                rest = np.setdiff1d(np.arange(batch.num_rows), at)
                shares[rest] = 0
                listed = [np.flatnonzero(s) for s in shares]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(names[best], pa.string()),
                        pa.array(np.clip(shares[np.arange(len(best)), best], 0, 1)),
                        pa.array([names[i].tolist() for i in listed], pa.list_(pa.string())),
                        pa.array([s[i].tolist() for s, i in zip(shares, listed)], pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score", "languages", "shares"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col(held_out).alias("held_out"), "text").mapInArrow(run, RESULT)


def identify(docs: DataFrame, folds: int = 5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from all folds but the first, then predict every document."""
    split = docs.withColumn("held_out", fold("doc_id", folds) == 0)
    return predict(split, fit(split.filter(~F.col("held_out")), sample_rows))


def with_language(docs: DataFrame, least_share: float, folds: int = 5) -> DataFrame:
    """The documents with a language that holds ``least_share`` of the text, with all their columns."""
    split = docs.withColumn("_held_out", fold("doc_id", folds) == 0)
    keyed = split.select(row_key().alias("doc_id"), F.col("_held_out").alias("held_out"), "text")
    found = predict(keyed, fit(split.filter(~F.col("_held_out"))))
    rejected = found.filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least_share))
    return without_rows(docs, written(rejected.select(F.col("doc_id").alias("row_key")).distinct(), "rejected"))
