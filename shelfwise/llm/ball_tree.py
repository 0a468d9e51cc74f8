"""Ranked lexical search by an exact inner-product search in sparse ball trees.

A document is a sparse vector over the items' terms; an entry is the term's weight times what its
occurrences give, an integer. An item is the sum of its terms' unit vectors, so a score is an inner
product. Documents are taken in blocks of bounded size, dealt by Spark; in its task a block becomes a
balanced tree: a node is split at the median of the projections on the line between two far points,
down to leaves of ``LEAF`` documents. Every node has its centroid and a radius that holds all its
documents. No document below a node scores more than <item, centroid> + |item| * radius; with the
rounding of doubles added on the safe side, a subtree is left out only where that bound lies below
the item's tenth best score so far. Nodes are taken best bound first; at leaves scores are computed
from integers, exactly. Best lists go on from block to block of a task, and the lists of all tasks
are ranked once more: tasks times items times ten short rows.

Items are the stated query set, taken in blocks of ``ITEMS`` against all documents. Documents are
reduced to the items' terms once and written; document frequencies are counted from that table.

Defined cases: null and empty texts, on either side, have no terms and appear in no result; equal
scores are ranked by document id, null ids last; repeated documents take a rank each; repeated items
and items with null ids are ranked each; texts of any length are read whole; other columns of either
table are not read; without documents or items the result is empty. Terms are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.stretches import ragged
from shelfwise.llm.words import LETTERED, pieces, words_of
from shelfwise.scratch import written

BEST = 10
#: Items searched in one pass over the documents.
ITEMS = 4096
LEAF = 32
#: Documents and entries of a tree at most, and cells of the dense rows of centroids.
BLOCK_ROWS, BLOCK_ENTRIES, BLOCK_CELLS = 8192, 1 << 20, 1 << 22
SLICE_BYTES = 1 << 22

REDUCED = "doc_id BIGINT, n BIGINT, terms ARRAY<INT>, times ARRAY<BIGINT>"
FOUND = "item INT, doc_id BIGINT, score BIGINT"


def item_terms(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """The places of each item's distinct terms in the sorted hashes of all terms."""
    words = words_of(pa.array(texts, pa.string()), LETTERED)
    hashes, places = np.unique(words.hashes, return_inverse=True)
    return [np.unique(places[a:b]) for a, b in zip(words.bounds[:-1], words.bounds[1:])], hashes


def reduced(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Each document's terms with repeats, counted, and its occurrences of the given terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(hashes)
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                words = words_of(batch.column(1), LETTERED)
                place = np.minimum(np.searchsorted(hashes, words.hashes), max(size - 1, 0))
                known = hashes[place] == words.hashes if size else np.zeros(len(words.hashes), bool)
                cells, times = np.unique(words.rows()[known] * size + place[known], return_counts=True)
                rows, terms = (cells // size, cells % size) if size else (cells, cells)
                bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (terms.astype(np.int32), times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(words.counts().astype(np.int64)), *lists], names=["doc_id", "n", "terms", "times"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, REDUCED)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class BallTree:
    """A balanced tree over the rows of a sparse matrix of integers; every row has an entry.

    Node 1 is the root, nodes 2k and 2k + 1 are below node k; ``bounds`` of a level cut ``order``,
    the rows from left to right, into the level's nodes.
    """

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        rows = len(starts) - 1
        self.levels = max(0, math.ceil(math.log2(rows / LEAF))) if rows > LEAF else 0
        # distances need no more than doubles; what rounding may add is added to the radius
        as_float = values.astype(np.float64)
        square = np.add.reduceat(as_float * as_float, starts[:-1])
        slack = 2.0**-52 * 8 * (len(columns) / max(rows, 1) + width + 64)
        row_of = np.repeat(np.arange(rows), np.diff(starts))
        order, node = np.arange(rows), np.zeros(rows, np.int64)
        self.centroids, self.radii = [np.zeros((1, width))], [np.zeros(1)]
        for level in range(self.levels + 1):
            count = 1 << level
            sums = np.bincount(node[row_of] * width + columns, as_float, count * width).reshape(count, width)
            centroid = sums / np.maximum(np.bincount(node, minlength=count), 1)[:, None]
            away, safe = self._distances(centroid, node, row_of, columns, as_float, starts, square, slack)
            radius = np.zeros(count)
            np.maximum.at(radius, node, safe)
            self.centroids.append(centroid)
            self.radii.append(radius)
            if level == self.levels:
                break
            first = self._farthest(away, node, count)
            dense = self._dense(first, starts, columns, as_float, width)
            away, _ = self._distances(dense, node, row_of, columns, as_float, starts, square, slack)
            second = self._farthest(away, node, count)
            line = self._dense(second, starts, columns, as_float, width) - dense
            along = np.add.reduceat(as_float * line[node[row_of], columns], starts[:-1])
            order = np.lexsort((np.arange(rows), along, node))
            # halves of the ordered rows of every node
            sizes = np.bincount(node, minlength=count)
            rank = np.arange(rows) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            node = node.copy()
            node[order] = 2 * node[order] + (rank >= np.repeat((sizes + 1) // 2, sizes))
        self.centroids = np.concatenate(self.centroids)  # by node number; number 0 is not used
        self.radii = np.concatenate(self.radii)
        order = np.lexsort((np.arange(rows), node))
        self.rows = order
        lengths = np.diff(starts)[order]
        self.starts = np.append(0, np.cumsum(lengths))
        flat = ragged(starts[:-1][order], lengths)
        self.columns, self.values = columns[flat], values[flat]
        self.leaves = np.searchsorted(node[order], np.arange((1 << self.levels) + 1))
        self.slack = slack

    @staticmethod
    def _dense(rows, starts, columns, values, width) -> np.ndarray:
        lengths = starts[rows + 1] - starts[rows]
        flat = ragged(starts[rows], lengths)
        dense = np.zeros((len(rows), width))
        dense[np.repeat(np.arange(len(rows)), lengths), columns[flat]] = values[flat]
        return dense

    @staticmethod
    def _distances(points, node, row_of, columns, values, starts, square, slack) -> tuple[np.ndarray, np.ndarray]:
        """Each row's squared distance to its node's point; and its distance, rounded up safely."""
        own = np.einsum("ij,ij->i", points, points)[node]
        dot = np.add.reduceat(values * points[node[row_of], columns], starts[:-1])
        away = np.maximum(square - 2 * dot + own, 0)
        return away, np.sqrt(away + slack * (square + own))

    @staticmethod
    def _farthest(away, node, count) -> np.ndarray:
        last = np.lexsort((away, node))
        return last[np.searchsorted(node[last], np.arange(count), "right") - 1]

    def bounds(self, items: list[np.ndarray]) -> np.ndarray:
        """No row below the node scores more for the item: a row for each node, a column for each item."""
        flat = np.concatenate(items)
        starts = np.cumsum([0, *(len(t) for t in items)])[:-1]
        sums = np.add.reduceat(self.centroids[:, flat], starts, axis=1)
        reach = np.sqrt([len(t) for t in items])[None, :] * self.radii[:, None]
        return (sums + reach) * (1 + self.slack) + 1

    def leaf_scores(self, leaf: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf's rows and their scores, summed as integers over the wanted columns."""
        a, b = self.leaves[leaf], self.leaves[leaf + 1]
        at = self.starts[a : b + 1]
        values = self.values[at[0] : at[-1]] * wanted[self.columns[at[0] : at[-1]]]
        return self.rows[a:b], np.add.reduceat(values, at[:-1] - at[0])

    def search(self, bounds: np.ndarray, wanted: np.ndarray, best: Best, key: np.ndarray) -> int:
        """Offer the rows that may be among the best; how many leaves were scored."""
        first, scored = 1 << self.levels, 0
        nodes = [(-bounds[1], 1)]
        while nodes and -nodes[0][0] >= best.least:
            _, node = heapq.heappop(nodes)
            if node >= first:
                rows, scores = self.leaf_scores(node - first, wanted)
                scored += 1
                good = np.flatnonzero(scores >= best.least)
                if len(good):
                    best.offer(scores[good], key[rows[good]])
            else:
                for below in (2 * node, 2 * node + 1):
                    if bounds[below] >= best.least:
                        heapq.heappush(nodes, (-bounds[below], below))
        return scored


#: Stands for a null id while ranking: behind all others.
_NO_ID = np.iinfo(np.int64).max


class Best:
    """The best scores of an item, equal ones by id."""

    def __init__(self, count: int):
        self.count = count
        self.scores, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: A row below this is not among the best.
        self.least = 1

    def offer(self, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.append(self.scores, scores), np.append(self.keys, keys)
        order = np.lexsort((keys, -scores))[: self.count]
        self.scores, self.keys = scores[order], keys[order]
        if len(order) == self.count:
            self.least = int(self.scores[-1])


def _blocks(batches: Iterator[pa.RecordBatch], rows: int, entries: int) -> Iterator[tuple]:
    """Keys, totals, starts, columns and occurrences of the rows that have entries, by blocks."""
    for batch in batches:
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        terms = lists.values.to_numpy()
        times = batch.column(3).values.to_numpy()[batch.column(3).offsets[0].as_py() :]
        ids = batch.column(0).fill_null(_NO_ID).to_numpy()
        totals = batch.column(1).to_numpy()
        there = np.flatnonzero(np.diff(offsets))
        at = 0
        while at < len(there):
            most = int(np.searchsorted(offsets[there + 1], offsets[there[at]] + entries, "right"))
            some = there[at : max(at + 1, min(most, at + rows))]
            lengths = offsets[some + 1] - offsets[some]
            flat = ragged(offsets[some], lengths)
            yield ids[some], totals[some], np.append(0, np.cumsum(lengths)), terms[flat], times[flat - offsets[0]]
            at += len(some)


def _search(docs: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """The best documents of each item in each task."""
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [i for i, terms in enumerate(items) if len(terms)]
        lists = [Best(best) for _ in asked]
        wanted = np.zeros(width, np.int64)
        rows = max(LEAF, min(BLOCK_ROWS, LEAF * BLOCK_CELLS // (2 * max(width, 1))))
        for keys, n, starts, columns, times in _blocks(batches, rows, BLOCK_ENTRIES):
            # products of three large counts: whole numbers of any size
            m = 100 - 90 + ((90 * n_docs * n.astype(object)) // n_terms).astype(np.int64)
            long = np.repeat(m, np.diff(starts))
            values = weights[columns] * ((1_000_000_000 * times) // (1000 * times + 8 * long))
            tree = BallTree(starts, columns, values, width)
            bounds = tree.bounds([items[i] for i in asked])
            for at, i in enumerate(asked):
                wanted[items[i]] = 1
                tree.search(bounds[:, at], wanted, lists[at], keys)
                wanted[items[i]] = 0
        for i, found in zip(asked, lists):
            ids = pa.array(found.keys, mask=found.keys == _NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(found.keys), pa.int32()), ids, pa.array(found.scores)], names=["item", "doc_id", "score"]
            )

    return docs.select("doc_id", "n", "terms", "times").mapInArrow(run, FOUND)


def _block_of_items(docs: DataFrame, texts: list[str | None], best: int) -> DataFrame:
    """``item`` (place in ``texts``), ``rank``, ``doc_id`` and ``score``."""
    terms, hashes = item_terms(texts)
    held = written(reduced(docs, hashes), "reduced")
    totals = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # at most one row for each of the items' terms
    counted = held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = dict.fromkeys(range(len(hashes)), 0) | {r["term"]: r["count"] for r in counted}
    weights = np.array([term_weight(totals["docs"], df[t]) for t in range(len(hashes))], dtype=np.int64)
    found = _search(held, terms, weights, totals["docs"], max(totals["terms"], 1), best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search(docs: DataFrame, items: DataFrame, best: int = BEST, items_at_once: int = ITEMS) -> DataFrame:
    """Each item's best documents: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    spark = docs.sparkSession
    stated = written(items.select("item_id", F.col("text").cast("string").alias("text")), "items")
    kind = stated.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {kind}, rank INT, doc_id BIGINT, score BIGINT")
    # the rows of the written table by their file and place: blocks of items_at_once or fewer
    placed = stated.withColumn("place", F.monotonically_increasing_id())
    place = None
    while True:
        rest = placed if place is None else placed.filter(F.col("place") > place)
        block = rest.orderBy("place").limit(items_at_once).collect()
        if not block:
            return result
        place = block[-1]["place"]
        ranked = _block_of_items(docs, [r["text"] for r in block], best)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"item INT, item_id {kind}")
        named = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        result = result.unionByName(named)
