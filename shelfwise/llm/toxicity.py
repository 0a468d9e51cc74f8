"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words and their first bytes (so that unseen endings fall back to a known beginning).
Each gets its log-odds between toxic and clean training texts under a Dirichlet prior in proportion
to the token's overall share, moved towards 0 by its standard error; a word's second, third, ...
place in a text counts a half, a third, ... of that. A linear-time scan finds all
maximal segments of a text; the best one is compared with what clean texts of that length reach by
chance (an extreme-value law fitted on clean texts apart from those counted), and a logistic curve
on the same part turns that into a chance.

Both fits use bounded samples of labelled rows: about ``SAMPLE_ROWS`` of each label. A token needs
``SUPPORT`` texts, which bounds the table sent to tasks by the sample's words.

Defined cases: null and empty texts have no segment and get the curve's value for a best of 0;
null labels are not learned from; without both labels every score is the prior share (0 if there
are no labels at all); repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.folds import bounded_sample, fold
from shelfwise.llm.words import LETTERED, Words, mix, pieces, span_hashes, words_of
from shelfwise.scratch import written

SAMPLE_ROWS = 20_000
SUPPORT = 5
#: Bytes of the beginnings a word falls back to.
BEGINNINGS = (12, 8, 6, 5, 4)
#: Prior texts as a share of a token's own, standard errors taken off, and what a token without evidence costs.
PRIOR, ERRORS, DRIFT = 0.1, 2.0, 0.05

RESULT = "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT, best DOUBLE, segments ARRAY<STRUCT<start: BIGINT, stop: BIGINT, score: DOUBLE>>"


def tokens_of(words: Words) -> list[np.ndarray]:
    """Hashes of the words, then of their beginnings (0 where a word is not longer)."""
    folded = LETTERED[words.data]
    out = [words.hashes]
    for size in BEGINNINGS:
        short = words.ends - words.starts <= size
        cut = mix(span_hashes(folded, words.starts, np.minimum(words.starts + size, words.ends)) + np.uint64(size))
        out.append(np.where(short, np.uint64(0), cut))
    return out


@dataclass
class Model:
    hashes: np.ndarray
    scores: np.ndarray
    rate: float = 1.0
    location: float = 0.0
    slope: float = 0.0
    intercept: float = -50.0

    def token_scores(self, words: Words) -> np.ndarray:
        """The score of each word: of itself or its longest beginning with support."""
        out = np.full(len(words.hashes), -DRIFT)
        if not len(self.hashes):
            return out
        left = np.ones(len(out), dtype=bool)
        for tokens in tokens_of(words):
            at = np.searchsorted(self.hashes, tokens)
            at[at == len(self.hashes)] = 0
            hit = left & (self.hashes[at] == tokens)
            out[hit] = self.scores[at[hit]]
            left &= ~hit
        return damped(out, words)

    def surprise(self, best: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Best scores on the scale of the extreme-value law for texts of their sizes."""
        return self.rate * (best - self.location) - np.log(sizes + 1.0)

    def chance(self, best: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * self.surprise(best, sizes), -50, 50)))


def damped(scores: np.ndarray, words: Words) -> np.ndarray:
    """Scores above 0 divided by how often their word has stood in the text so far, this time included."""
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return scores
    row = np.searchsorted(words.bounds, at, "right")
    order = np.lexsort((at, words.hashes[at], row))
    word, row = words.hashes[at][order], row[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (word[1:] != word[:-1]) | (row[1:] != row[:-1])
    place = np.arange(len(at))
    times = place - np.maximum.accumulate(np.where(fresh, place, 0)) + 1
    scores[at[order]] /= times
    return scores


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (start, stop, score), in one pass with a stack of candidates."""
    total, stack = 0.0, []  # candidates: (start, stop, sum before, sum after)
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start = at
        while True:
            lower = len(stack) - 1
            while lower >= 0 and stack[lower][2] >= before:
                lower -= 1
            if lower < 0 or stack[lower][3] >= total:
                stack.append((start, at + 1, before, total))
                break
            start, _, before, _ = stack[lower]
            del stack[lower:]
    return [(a, b, after - before) for a, b, before, after in stack]


def segments_of(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """The maximal segments of a text, found on its runs of equal sign."""
    if not len(scores) or scores.max() <= 0:
        return []
    starts = np.concatenate([[0], np.flatnonzero((scores[1:] > 0) != (scores[:-1] > 0)) + 1])
    stops = np.append(starts[1:], len(scores))
    return [(int(starts[a]), int(stops[b - 1]), s) for a, b, s in maximal_segments(np.add.reduceat(scores, starts).tolist())]


def best_of(scores: np.ndarray) -> float:
    return max((s for _, _, s in segments_of(scores)), default=0.0)


def _counted(rows: DataFrame) -> DataFrame:
    """``token``, ``toxic`` and ``clean``: in how many texts of either label each token stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 23):
                words = words_of(batch.column(1), LETTERED)
                labels = np.array(batch.column(0).to_pylist(), dtype=np.int64)
                docs = words.rows().astype(np.uint64)
                pairs = []
                for tokens in tokens_of(words):
                    order = np.lexsort((docs, tokens))
                    t, d = tokens[order], docs[order].astype(np.int64)
                    fresh = np.ones(len(t), bool)
                    fresh[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
                    fresh &= t != 0
                    pairs.append((t[fresh], labels[d[fresh]]))
                token = np.concatenate([t for t, _ in pairs])
                label = np.concatenate([y for _, y in pairs])
                unique, at = np.unique(token, return_inverse=True)
                toxic = np.bincount(at, weights=label, minlength=len(unique)).astype(np.int64)
                clean = np.bincount(at, minlength=len(unique)) - toxic
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unique.view(np.int64)), pa.array(toxic), pa.array(clean)], names=["token", "toxic", "clean"]
                )

    each = rows.select("toxic", "text").mapInArrow(count, "token BIGINT, toxic BIGINT, clean BIGINT")
    return each.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def token_table(rows: DataFrame) -> Model:
    """Shrunk log-odds of the tokens with support."""
    counted = _counted(rows).filter(F.col("toxic") + F.col("clean") >= SUPPORT).toArrow()
    token = counted.column("token").to_numpy().view(np.uint64)
    toxic, clean = (counted.column(n).to_numpy().astype(float) for n in ("toxic", "clean"))
    if not len(token) or not toxic.sum() or not clean.sum():
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    prior = PRIOR * (toxic + clean)
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (a.sum() - a + 1)) - np.log(b / (b.sum() - b + 1))
    error = ERRORS * np.sqrt(1 / a + 1 / b)
    shrunk = np.sign(odds) * np.maximum(np.abs(odds) - error, 0) - DRIFT
    order = np.argsort(token)
    return Model(token[order], shrunk[order])


def _bests(rows: DataFrame, model: Model) -> np.ndarray:
    """(label, best score, words) of each sampled row."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 23):
                words = words_of(batch.column(1), LETTERED)
                scores, bounds = sent.value.token_scores(words), words.bounds
                best = [best_of(scores[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array(best, pa.float64()), pa.array(words.counts(), pa.int64())],
                    names=["toxic", "best", "n"],
                )

    found = rows.select("toxic", "text").mapInArrow(run, "toxic BIGINT, best DOUBLE, n BIGINT").toArrow()
    return np.array([found.column(n).to_numpy().astype(float) for n in ("toxic", "best", "n")])


def calibrated(model: Model, toxic: np.ndarray, best: np.ndarray, sizes: np.ndarray, share: float) -> Model:
    """Fit the extreme-value law to clean texts, then the logistic curve to both labels.

    ``share`` is the toxic share of all labelled rows, as the sample may hold another.
    """
    clean = best[toxic == 0]
    spread = max(float(clean.std()) if len(clean) else 0.0, 0.1)
    model.rate = math.pi / (spread * math.sqrt(6))
    level = best[toxic == 0] - np.log(sizes[toxic == 0] + 1.0) / model.rate
    model.location = (float(level.mean()) if len(clean) else 0.0) - 0.5772156649 / model.rate
    x = model.surprise(best, sizes)
    centre, scale = float(x.mean()), max(float(x.std()), 1e-6)
    z = np.stack([np.ones_like(x), (x - centre) / scale], axis=1)
    weight = np.where(toxic == 1, share / max(toxic.mean(), 1e-9), (1 - share) / max(1 - toxic.mean(), 1e-9))
    coef = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ coef, -30, 30)))
        slope = z.T @ (weight * (p - toxic)) + 1e-2 * coef
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        coef -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    model.slope = max(0.0, coef[1] / scale)
    model.intercept = coef[0] - coef[1] * centre / scale
    return model


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """``labels``: doc_id, toxic. Three quarters of the sample make the token table, the rest the curve.

    The sample is drawn from the labels alone, two bounded lists of ids, so that it can be broadcast
    to where the texts lie.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    sample = written(bounded_sample(marks, "toxic", "doc_id", sample_rows), "toxic-sample")
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(4))
    drawn = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("part", part)
    if 0 in counts and 1 in counts:
        model = token_table(drawn.filter("part > 0"))
        toxic, best, sizes = _bests(drawn.filter("part = 0"), model)
        if 0 < toxic.sum() < len(toxic):
            return calibrated(model, toxic, best, sizes, share)
    prior = Model(np.zeros(0, np.uint64), np.zeros(0))
    prior.intercept = math.log(share / (1 - share)) if 0 < share < 1 else (50.0 if share else -50.0)
    return prior


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every document's score and its significant segments (words ``start`` to ``stop``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 23):
                words = words_of(batch.column(2), LETTERED)
                scores, bounds, sizes = model.token_scores(words), words.bounds, words.counts()
                found = [segments_of(scores[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                best = np.array([max((s for _, _, s in f), default=0.0) for f in found])
                chance = model.chance(best, sizes)
                kept = [
                    [{"start": a, "stop": b, "score": s} for a, b, s in f if c >= 0.5 and model.chance(np.array([s]), np.array([n]))[0] >= 0.5]
                    for f, n, c in zip(found, sizes, chance)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(chance),
                        pa.array((chance >= 0.5).astype(np.int32)),
                        pa.array(best),
                        pa.array(kept, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))),
                    ],
                    names=["doc_id", "held_out", "score", "predicted", "best", "segments"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "held_out", "text").mapInArrow(run, RESULT)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from the labels of all folds but the first, then score every document."""
    split = docs.select("doc_id", "text").withColumn("held_out", fold("doc_id", folds) == 0)
    return score(split, fit(split, labels.filter(fold("doc_id", folds) != 0), sample_rows))
