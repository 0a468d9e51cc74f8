"""Benchmark decontamination with a suffix automaton over the test items' words.

The items' words make one generalised suffix automaton: its states are the classes of word runs
that end at the same places of items. A document's words are streamed through it; after each word
the state tells the longest run ending there that some item holds. Where that run reaches a window
(13 words, or a whole shorter item) the window's words are hit, and the class tells which items
hold it. ``clean`` cuts hit spans out, or drops documents hit over a share of their words.

An automaton takes items of at most ``MOST_WORDS`` words, so what is sent to tasks is bounded; more
items are dealt into blocks of that size, the documents are streamed once for each block, and the
hit words are united.

Words are compared by 64-bit hashes. Only stretches of documents whose neighbouring words are
neighbours in some item are streamed; nothing longer than a word can match across a stretch's end.

Defined cases: null, empty or punctuation-only texts have no words and are never contaminated;
items without words have no window; equal items are all reported; repeated rows are judged alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.folds import row_key, without_rows
from shelfwise.llm.words import LETTERED, joined, pieces, words_of
from shelfwise.scratch import scratch_path, written

WINDOW = 13
MOST_WORDS = 200_000
# Text taken at a time: some fifty bytes of arrays stand behind each of its bytes.
SLICE_BYTES = 1 << 20

FOUND = "doc_id BIGINT, n_words BIGINT, spans ARRAY<STRUCT<start: BIGINT, stop: BIGINT>>, items ARRAY<STRING>, row STRING"


class Automaton:
    """States as rows: ``following`` (word to state), ``link``, ``length``, and window ends."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.following: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[str]] = [set()]
        self.short: list[set[str]] = [set()]
        places: list[tuple[str, list[int]]] = []
        for name, words in items:
            last, path = 0, []
            for word in words:
                last = self._extended(last, word)
                path.append(last)
            if words:
                places.append((name, path))
        for name, path in places:
            if len(path) < window:
                self.short[path[-1]].add(name)
            else:
                self._holds(name, path)

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.following.append(following)
        self.link.append(link)
        self.length.append(length)
        self.items.append(set())
        self.short.append(set())
        return len(self.length) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """A copy of ``child`` for the runs through ``parent``, put above it."""
        copy = self._new(self.length[parent] + 1, self.link[child], dict(self.following[child]))
        while parent >= 0 and self.following[parent].get(word) == child:
            self.following[parent][word] = copy
            parent = self.link[parent]
        self.link[child] = copy
        return copy

    def _extended(self, last: int, word: int) -> int:
        if (there := self.following[last].get(word)) is not None:
            return there if self.length[there] == self.length[last] + 1 else self._split(last, word, there)
        state, above = self._new(self.length[last] + 1, 0, {}), last
        while above >= 0 and word not in self.following[above]:
            self.following[above][word] = state
            above = self.link[above]
        if above >= 0:
            there = self.following[above][word]
            whole = self.length[there] == self.length[above] + 1
            self.link[state] = there if whole else self._split(above, word, there)
        return state

    def _holds(self, name: str, path: list[int]) -> None:
        """Note the item at the class of each of its windows."""
        for state in path[self.window - 1 :]:
            while self.length[self.link[state]] >= self.window:
                state = self.link[state]
            self.items[state].add(name)

    def stream(self, words: list[int], first: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        """Follow ``words``, adding the windows that occur and the items that hold them."""
        state, matched = 0, 0
        for at, word in enumerate(words):
            while state and word not in self.following[state]:
                state = self.link[state]
                matched = self.length[state]
            if word not in self.following[state]:
                continue
            state, matched = self.following[state][word], matched + 1
            node = state
            if matched >= self.window:
                while self.length[self.link[node]] >= self.window:
                    node = self.link[node]
                spans.append((first + at + 1 - self.window, first + at + 1))
                found |= self.items[node]
            while node:
                if self.short[node] and self.length[node] <= matched:
                    found |= self.short[node]
                    spans.append((first + at + 1 - self.length[node], first + at + 1))
                node = self.link[node]


class Matcher:
    """An automaton with the words and pairs of neighbours that any window needs."""

    def __init__(self, names: list[str], texts: list[str], window: int):
        words = words_of(pa.array(texts, pa.string()), LETTERED)
        self.vocabulary, ids = np.unique(words.hashes, return_inverse=True)
        runs = [ids[a:b].tolist() for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        same = words.rows()[:-1] == words.rows()[1:]
        self.pairs = np.unique(joined(words.hashes[:-1], words.hashes[1:])[same])
        self.automaton = Automaton(list(zip(names, runs)), window)
        self.least = min((min(window, len(r)) for r in runs if r), default=0)

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
        """For each text: its words, the merged spans of hit words, the items."""
        words = words_of(texts, LETTERED)
        counts = words.counts()
        spans: dict[int, list] = {}
        found: dict[int, set] = {}
        if self.least and len(words.hashes):
            ids = np.searchsorted(self.vocabulary, words.hashes)
            ids[ids == len(self.vocabulary)] = 0
            known = self.vocabulary[ids] == words.hashes
            pairs = joined(words.hashes[:-1], words.hashes[1:])
            place = np.searchsorted(self.pairs, pairs)
            near = np.zeros(len(pairs), dtype=bool)
            if len(self.pairs):
                place[place == len(self.pairs)] = 0
                near = self.pairs[place] == pairs
            rows = words.rows()
            near &= rows[:-1] == rows[1:]
            fresh = known.copy()
            fresh[1:] &= ~near  # a stretch starts at a known word that does not follow its neighbour
            ends = known.copy()
            ends[:-1] &= ~near
            starts, stops = np.flatnonzero(fresh), np.flatnonzero(ends) + 1
            long = stops - starts >= self.least
            for a, b in zip(starts[long].tolist(), stops[long].tolist()):
                row = int(rows[a])
                first = a - int(words.bounds[row])
                self.automaton.stream(ids[a:b].tolist(), first, spans.setdefault(row, []), found.setdefault(row, set()))
        for row, n in enumerate(counts.tolist()):
            yield n, merged(spans.get(row, ())), found.get(row, set())


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


@lru_cache(maxsize=2)
def _matcher(names: tuple[str, ...], texts: tuple[str, ...], window: int) -> Matcher:
    return Matcher(list(names), list(texts), window)


def _row_key(doc_id, text: str | None) -> str:
    return hashlib.sha256(f"{doc_id}:{text or ''}".encode()).hexdigest()


def _streamed(docs: DataFrame, names: tuple[str, ...], texts: tuple[str, ...], window: int, keyed: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(names, texts, window)
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                n, spans, items = zip(*matcher.matches(batch.column(1)))
                keys = [_row_key(*r) for r in zip(*(c.to_pylist() for c in batch.columns[:2]))] if keyed else [None] * len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).cast(pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(
                            [[{"start": a, "stop": b} for a, b in s] for s in spans],
                            pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
                        ),
                        pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                        pa.array(keys, pa.string()),
                    ],
                    names=["doc_id", "n_words", "spans", "items", "row"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, FOUND)


def item_blocks(items: DataFrame, most_words: int) -> Iterator[tuple[tuple[str, ...], tuple[str, ...]]]:
    """The items in blocks of at most ``most_words`` words (a longer item is a block of its own)."""
    sized = items.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.col("text"),
        F.size(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")).alias("n"),
    ).filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = sized.agg(F.sum("n")).first()[0] or 0
    blocks = -(-int(total) // max(1, most_words // 2)) if total > most_words else 1
    dealt = written(sized.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "items")
    for block in range(blocks):
        held = dealt.filter(F.col("block") == block).orderBy("item_id", "text")
        names, texts, n = [], [], 0
        for r in held.toLocalIterator():
            if names and n + r["n"] > most_words:
                yield tuple(names), tuple(texts)
                names, texts, n = [], [], 0
            names.append(r["item_id"])
            texts.append(r["text"])
            n += r["n"]
        yield tuple(names), tuple(texts)


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """Every document with its words, the spans of hit words, and the items whose windows occur."""
    blocks = item_blocks(items, most_words)
    first, more = next(blocks), next(blocks, None)
    if more is None:
        return _streamed(docs, *first, window, False).drop("row")
    path, count = scratch_path(docs.sparkSession, "contamination"), 0
    for names, texts in chain([first, more], blocks):
        _streamed(docs, names, texts, window, True).write.mode("append").parquet(path)
        count += 1
    each = docs.sparkSession.read.schema(FOUND).parquet(path)
    repeats = F.count("*") / F.lit(count)
    flat = each.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("parts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        repeats.cast("int").alias("repeats"),
    )
    grown = F.aggregate(
        "parts",
        F.array().cast("array<struct<start: bigint, stop: bigint>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.element_at(done, -1).withField("stop", F.greatest(F.element_at(done, -1)["stop"], x["stop"]))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats")))
    return flat.select("doc_id", "n_words", grown.alias("spans"), "items", copies.alias("_copy")).drop("_copy")


def judged(found: DataFrame) -> DataFrame:
    """``n_hit``, ``n_items`` and ``contaminated``: hit words are a twentieth of the words or more."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("bigint"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
    )


def without_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, whole and with all their columns."""
    keyed = docs.select(row_key().alias("doc_id"), "text")
    bad = judged(find_contamination(keyed, items, window)).filter("contaminated")
    return without_rows(docs, written(bad.select(F.col("doc_id").alias("row_key")).distinct(), "contaminated"))


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of ``spans`` and what stands between them."""
    if not text or not spans:
        return text
    words = words_of(pa.array([text]), LETTERED)
    data, out, at = text.encode(), [], 0
    for start, stop in spans:
        out.append(data[at : words.starts[start]])
        at = words.ends[stop - 1]
    return b"".join([*out, data[at:]]).decode()
