"""A bigram language model by deleted interpolation.

P(w | v) = a f(w | v) + b f(w) + c / (V + 1), where f are maximum-likelihood estimates and (a, b, c)
depend on how often the context v was seen, in buckets of powers of two. The weights are learned by
expectation-maximisation on held-out counts: each training bigram is scored with its own place
taken out of all counts.

1. Documents become blocks (written once): distinct word hashes and each token's place among them.
2. A block's distinct words and bigrams are counted for its training documents and dealt to parts
   by hash range, packed and sorted; a part adds up the counts of all blocks and answers every block
   with totals in the order asked. Both are in proportion to the distinct n-grams of blocks.
3. Blocks meet their totals once; each token's two totals are written. From these come the weights'
   statistics on a fixed grid of logarithms, and then the scores, without another shuffle.

Words and bigrams are 64-bit hashes, totals 64 bits. Nothing is pruned. ``BLOCK_BYTES`` bounds a
block but for single longer texts; ``PART_TOKENS`` bounds the tokens behind a part. For the weights
alone, estimates are rounded to a quarter of a power of two (a factor of at most 1.1); scores use
exact ones.

Defined cases: null is empty and has one token, the end; without training tokens every token has
probability 1 / (V + 1) with V = 0; a null doc_id counts as the empty text in folds; repeated rows
are counted and scored each; a text longer than a block is a block of its own; columns other than
``doc_id`` and ``text`` are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.folds import fold
from shelfwise.llm.packed import packed, packed_sorted, unpacked, unpacked_sorted
from shelfwise.llm.words import SPACED, joined, pieces, words_of
from shelfwise.scratch import written

BLOCK_BYTES, PART_TOKENS = 1 << 22, 1_000_000
BUCKETS, GRID, ROUNDS = 40, 4, 60
# Places of the grid: logarithms of estimates lie above -64.
SIDE = 1024

# Hashes of what is not a word.
END, START = np.uint64(0x51ED270B9F8A3C4D), np.uint64(0x2C9277B5F1D4E683)

BLOCKS = "block STRING, doc_id ARRAY<BIGINT>, held_out ARRAY<BOOLEAN>, n_tokens ARRAY<BIGINT>, words BINARY, tokens BINARY"
ASKED = "kind INT, part BIGINT, block STRING, keys BINARY, counts BINARY"
TOTALS = "block STRING, kind INT, part BIGINT, totals BINARY, known BIGINT"
COUNTED = (
    "doc_id ARRAY<BIGINT>, held_out ARRAY<BOOLEAN>, n_tokens ARRAY<BIGINT>, n_known ARRAY<BIGINT>, "
    "base_score ARRAY<DOUBLE>, one BINARY, two BINARY"
)
CELLS = "cell BIGINT, weight BIGINT"
SCORES = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, base_score DOUBLE, score DOUBLE"
)


def _batch(schema: str, *rows: tuple) -> pa.RecordBatch:
    """Rows as a record batch with the columns of a Spark schema."""
    kinds = {"STRING": pa.string(), "BINARY": pa.binary(), "INT": pa.int32(), "BIGINT": pa.int64()}
    kinds |= {"BOOLEAN": pa.bool_(), "DOUBLE": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    types = [pa.list_(kinds[k[6:-1]]) if k.startswith("ARRAY<") else kinds[k] for _, k in fields]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(fields), types)]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, since each holds whole arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def document_blocks(docs: DataFrame) -> DataFrame:
    """``docs``: doc_id, held_out, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in pieces(whole, "text", BLOCK_BYTES):
                words = words_of(batch.column(2), SPACED)
                hashes = np.insert(words.hashes, words.bounds[1:], END)
                held, places = np.unique(hashes, return_inverse=True)
                row = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), (words.counts() + 1).tolist()]
                yield _batch(BLOCKS, (f"{task}-{number}", *row, packed_sorted(held), packed(places)))
                number += 1

    return docs.select(F.col("doc_id").cast("bigint"), "held_out", F.col("text").cast("string")).mapInArrow(run, BLOCKS)


class Block:
    """A block's tokens, its distinct bigrams, and which tokens are trained on."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["n_tokens"], dtype=np.int64)
        self.doc_id, self.held_out = row["doc_id"], row["held_out"]
        self.words = unpacked_sorted(row["words"])
        self.tokens = unpacked(row["tokens"]).astype(np.int64)
        context = np.empty_like(self.tokens)
        context[1:] = self.tokens[:-1]
        context[first_places(self.sizes)] = len(self.words)
        pairs, self.kinds = np.unique(context * (len(self.words) + 1) + self.tokens, return_inverse=True)
        before, word = np.divmod(pairs, len(self.words) + 1)
        hashes = joined(np.append(self.words, START)[before], self.words[word])
        # in the order of the hashes, as parts are asked
        self.order = np.argsort(hashes)
        self.pair_hashes = hashes[self.order]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the words and of the bigrams (in the order asked)."""
        trained = np.repeat(~np.array(self.held_out, dtype=bool), self.sizes)
        one = np.bincount(self.tokens[trained], minlength=len(self.words))
        two = np.bincount(self.kinds[trained], minlength=len(self.order))
        return one, two[self.order]


def first_places(sizes: np.ndarray) -> np.ndarray:
    """Where each document's tokens start."""
    return np.cumsum(sizes) - sizes


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts are even ranges of the hash's upper 32 bits, so sorted hashes are sorted by part."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def asked(blocks: DataFrame, parts: int) -> DataFrame:
    """The n-grams of each block with their counts, a row for each kind and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row)
            for kind, hashes, counts in zip((1, 2), (block.words, block.pair_hashes), block.counts()):
                part = _part(hashes, parts)
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                yield _batch(
                    ASKED,
                    *(
                        (kind, int(part[a]), row["block"], packed_sorted(hashes[a:b]), packed(counts[a:b]))
                        for a, b in zip(cuts, cuts[1:])
                    ),
                )

    return blocks.mapInArrow(run, ASKED)


def totals(requests: DataFrame) -> DataFrame:
    """Each block's request answered with counts over all blocks; ``known``: a part's n-grams trained on."""

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [unpacked_sorted(r["keys"]) for r in rows]
        unique, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(unique), np.int64)
        np.add.at(total, at, np.concatenate([unpacked(r["counts"]) for r in rows]).astype(np.int64))
        known, end, answers = int((total > 0).sum()), 0, []
        for r, k in zip(rows, keys):
            answers.append((r["block"], r["kind"], r["part"], packed(total[at[end : end + len(k)]]), known))
            known, end = 0, end + len(k)
        return pa.Table.from_batches([_batch(TOTALS, *answers)])

    return requests.groupBy("kind", "part").applyInArrow(add, TOTALS)


def counted(blocks: DataFrame, answers: DataFrame, tokens: int, known: int) -> DataFrame:
    """Each block's documents with their base scores, and for each token the totals of its word and bigram."""

    def run(block_rows: pa.Table, answer_rows: pa.Table) -> pa.Table:
        block = Block(block_rows.to_pylist()[0])
        rows = sorted(answer_rows.select(["kind", "part", "totals"]).to_pylist(), key=lambda r: (r["kind"], r["part"]))
        # parts are in the order of the hashes
        one, asked_two = (np.concatenate([unpacked(r["totals"]) for r in rows if r["kind"] == k]).astype(np.int64) for k in (1, 2))
        two = np.empty_like(asked_two)
        two[block.order] = asked_two
        firsts = first_places(block.sizes)
        base = np.log10((one + 0.1) / (tokens + 0.1 * (known + 1)))[block.tokens]
        seen = np.add.reduceat((one > 0)[block.tokens].astype(np.int64), firsts)
        documents = (block.doc_id, block.held_out, block.sizes.tolist(), seen.tolist(), np.add.reduceat(base, firsts).tolist())
        return pa.Table.from_batches([_batch(COUNTED, (*documents, packed(one[block.tokens]), packed(two[block.kinds])))])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, COUNTED)


def token_totals(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of a row's documents, and for each token the totals of its word, its bigram and its context."""
    sizes = np.array(row["n_tokens"], dtype=np.int64)
    one, two = (unpacked(row[c]).astype(np.int64) for c in ("one", "two"))
    context = np.empty_like(one)
    context[1:] = one[:-1]
    # a document starts as often as one ends, and each ends with the end
    context[first_places(sizes)] = one[-1]
    return sizes, one, two, context


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, then one bucket for each power of two."""
    return np.minimum(np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)


def held_out_cells(rows: DataFrame, tokens: int) -> DataFrame:
    """Training bigrams with their own place taken out, on a grid of their two estimates' logarithms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sizes, one, two, context = token_totals(row)
            used = np.repeat(~np.array(row["held_out"], dtype=bool), sizes)
            c2, c1, cv = two[used] - 1, one[used] - 1, context[used] - 1
            grid2 = np.where((c2 > 0) & (cv > 0), np.round(GRID * np.log2(np.maximum(c2, 1) / np.maximum(cv, 1))), 1)
            grid1 = np.where(c1 > 0, np.round(GRID * np.log2(np.maximum(c1, 1) / max(tokens - 1, 1))), 1)
            cell = (bucket_of(cv) * SIDE + grid2.astype(np.int64) + SIDE // 2) * SIDE + grid1.astype(np.int64) + SIDE // 2
            cells, weight = np.unique(cell, return_counts=True)
            yield _batch(CELLS, *zip(cells.tolist(), weight.tolist()))

    return rows.select("n_tokens", "held_out", "one", "two").mapInArrow(run, CELLS).groupBy("cell").agg(F.sum("weight").alias("weight"))


def cell_columns(cells: pa.Table) -> pa.Table:
    """``bucket``, ``two``, ``one`` (grid places of the estimates, 1 for none) and ``weight``."""
    rest, one = np.divmod(cells.column("cell").to_numpy().astype(np.int64), SIDE)
    bucket, two = np.divmod(rest, SIDE)
    return pa.table({"bucket": bucket, "two": two - SIDE // 2, "one": one - SIDE // 2, "weight": cells.column("weight")})


def learned_weights(cells: pa.Table, known: int) -> np.ndarray:
    """(a, b, c) of each bucket by EM; buckets without data lean on shorter contexts."""
    bucket, two, one, weight = (cells.column(c).to_numpy().astype(np.int64) for c in ("bucket", "two", "one", "weight"))
    chance = np.stack(
        [np.where(two <= 0, 2.0 ** (two / GRID), 0.0), np.where(one <= 0, 2.0 ** (one / GRID), 0.0), np.full(len(two), 1 / (known + 1))],
        axis=1,
    )
    weights = np.tile([1 / 3, 1 / 3, 1 / 3], (BUCKETS, 1))
    weights[0] = [0, 0.5, 0.5]
    seen = np.bincount(bucket, weights=weight, minlength=BUCKETS)
    for _ in range(ROUNDS):
        share = weights[bucket] * chance
        share *= (weight / share.sum(axis=1))[:, None]
        for k in range(3):
            moved = np.bincount(bucket, weights=share[:, k], minlength=BUCKETS)
            weights[:, k] = np.where(seen > 0, moved / np.maximum(seen, 1), weights[:, k])
    # no bucket rules unknown words out
    weights[:, 2] = np.maximum(weights[:, 2], 1e-6)
    return weights / weights.sum(axis=1, keepdims=True)


def scored(rows: DataFrame, tokens: int, known: int, weights: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sizes, one, two, context = token_totals(row)
            a, b, c = weights[bucket_of(context)].T
            chance = a * two / np.maximum(context, 1) + b * one / max(tokens, 1) + c / (known + 1)
            score = np.add.reduceat(np.log10(chance), first_places(sizes)).tolist()
            documents = (row["doc_id"], row["held_out"], row["n_tokens"], row["n_known"])
            yield _batch(SCORES, *zip(*documents, [tokens] * len(sizes), row["base_score"], score))

    return rows.mapInArrow(run, SCORES)


def score_documents(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Learn from all folds but the first, then score every document."""
    split = docs.select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "text")
    blocks = written(document_blocks(split), "lm-blocks")
    trained = F.aggregate(F.zip_with("n_tokens", "held_out", lambda n, h: F.when(h, 0).otherwise(n)), F.lit(0).cast("bigint"), lambda s, n: s + n)
    every = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda s, n: s + n)
    sums = blocks.agg(F.sum(trained).alias("trained"), F.sum(every).alias("all")).first()
    tokens, parts = int(sums["trained"] or 0), max(1, -(-int(sums["all"] or 0) // PART_TOKENS))
    answers = written(totals(asked(blocks, parts)), "lm-totals")
    known = int(answers.filter("kind = 1").agg(F.sum("known")).first()[0] or 0)
    rows = written(counted(blocks, answers.drop("known"), tokens, known), "lm-counted")
    if tokens:
        weights = learned_weights(cell_columns(held_out_cells(rows, tokens).toArrow()), known)
    else:
        weights = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    return scored(rows, tokens, known, weights)
