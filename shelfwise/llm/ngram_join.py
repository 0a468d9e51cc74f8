"""Documents alike by their word shingles: an exact Jaccard self-join and its components.

1. Every text becomes a set of 64-bit shingle hashes; texts with equal sets are one class.
2. How often each shingle is held is counted on packed arrays of shortened hashes, dealt by hash.
   Texts are numbered within a block of some megabytes, so a shingle travels with its text's number
   there and its count returns to the block, which has the classes. Each block counts a class once.
   Shortening and copies in other blocks can only raise a count, so a count of one is proof that no
   other class holds the shingle.
3. A class orders its shingles from rare to common. Two classes can only be alike if they share one
   among the rarest quarter (and one) of either; those nobody else holds need no posting.
4. Postings meet in tiles of one shingle and neighbouring size bands (sizes that differ by more than
   the threshold allows never meet). First every class is compared with the best connected one of
   its tiles; most groups are one component after that.
5. Tiles that still hold several components compare the rest: bitmaps of hashed shingles bound the
   overlap from above (a bit set in one only is a shingle the other lacks), and pairs that pass
   are settled by exact intersection of the sorted sets. Tiles with many members are cut into a
   grid of cells of bounded size. Pairs inside one component need no comparison, and a pair that
   meets in several tiles is given by the first of them alone.
6. Components come from the exact links.

Nothing is capped: every pair that can be alike is compared or already connected.

Defined cases: null texts and texts without words have empty sets, are linked with nothing and are
components of their own; a text of fewer than ``k`` words is one shingle; equal sets are linked;
repeated rows share a component; a null doc_id never names a component unless no member has an id.
Rows are numbered as they are read, so a table must give them in the same order when read again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.folds import row_key, without_rows
from shelfwise.llm.words import SPACED, mix, pieces, shingles, words_of
from shelfwise.scratch import written

K, PERCENT = 5, 75
# Shingles counted together in one task, members of a tile's cell, and words of a needed-filter.
PART_SHINGLES, CELL_MEMBERS, FILTER_WORDS = 1_000_000, 400, 1 << 18
# Text made into sets at a time.
SLICE_BYTES = 1 << 21
# Tiles of a cell's members looked at together, and bitmap words compared together.
TILES_AT_ONCE, WORDS_AT_ONCE = 1024, 1 << 21

SETS = "doc_id BIGINT, row_key BIGINT, n BIGINT, class BIGINT, bits BINARY"
PACKED = "part INT, block BIGINT, hashes BINARY, places BINARY, classes BINARY, sizes BINARY"
SHARED = "part INT, block BIGINT, hashes BINARY, places BINARY, held BINARY, classes BINARY, sizes BINARY"
SHARED_NAMES = ["part", "block", "hashes", "places", "held", "classes", "sizes"]
POSTINGS = "class BIGINT, n BIGINT, weight BIGINT, token BIGINT"
PAIRS = "a BIGINT, b BIGINT"


def sets_of(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, each row's bounds in them, each row's class."""
    grams, rows = shingles(words_of(texts, SPACED), k)
    if (rows[1:] < rows[:-1]).any():
        order = np.argsort(rows, kind="stable")
        grams, rows = grams[order], rows[order]
    ends = np.searchsorted(rows, np.arange(len(texts) + 1)).tolist()
    for a, b in zip(ends, ends[1:]):
        grams[a:b].sort()
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    grams, rows = grams[fresh], rows[fresh]
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams), dtype=np.uint64)])
    turned = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
    n = np.diff(bounds).astype(np.uint64)
    one, two = sums[bounds[1:]] - sums[bounds[:-1]], turned[bounds[1:]] - turned[bounds[:-1]]
    return grams, bounds, mix(one ^ mix(two + n)).view(np.int64)


def bitmap(grams: np.ndarray) -> bytes:
    """One bit for each hash in a map of at least twice as many bits."""
    width = 1 << max(6, (2 * len(grams) - 1).bit_length()) if len(grams) else 64
    bits = np.zeros(width, np.uint8)
    bits[(grams & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def document_sets(docs: DataFrame, k: int = K) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                grams, bounds, classes = sets_of(batch.column(2), k)
                bits = [bitmap(grams[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [*batch.columns[:2], pa.array(np.diff(bounds)), pa.array(classes), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "n", "class", "bits"])

    return docs.select(F.col("doc_id").cast("bigint"), row_key(), F.col("text").cast("string")).mapInArrow(run, SETS)


def packed_shingles(docs: DataFrame, parts: int, k: int = K) -> DataFrame:
    """For each block and part of the hashes: shortened hashes in order, the place of each one's text in the block.

    One row of a block, in a part that changes from block to block, has the classes and sizes of its texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in pieces(whole, "text", 2 * SLICE_BYTES):
                grams, bounds, classes = sets_of(batch.column(0), k)
                sizes = np.diff(bounds)
                held = np.unique(classes, return_index=True)[1]
                held = held[sizes[held] > 0]
                if not len(held):
                    continue
                place = np.full(batch.num_rows, -1)
                place[held] = np.arange(len(held))
                rows = np.repeat(place, sizes)
                grams, rows = grams[rows >= 0], rows[rows >= 0].astype("<u2" if len(held) <= 1 << 16 else "<u4")
                codes = ((grams >> np.uint64(32)) % np.uint64(parts) << np.uint64(32)) | (grams & np.uint64(0xFFFFFFFF))
                order = np.argsort(codes)
                codes, rows = codes[order], rows[order]
                hashes = codes.astype("<u4")  # the lower half
                ends = np.searchsorted(codes, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
                there = np.flatnonzero(np.diff(ends))
                spans = [slice(a, b) for a, b in zip(ends[there], ends[there + 1])]
                named: list[list] = [[None] * len(there) for _ in range(2)]
                at = (block + (block >> 32)) % len(there)
                named[0][at], named[1][at] = classes[held].tobytes(), sizes[held].astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(there, pa.int32()),
                        pa.array(np.full(len(there), block)),
                        *(pa.array([v[span].tobytes() for span in spans], pa.binary()) for v in (hashes, rows)),
                        *(pa.array(v, pa.binary()) for v in named),
                    ],
                    names=["part", "block", "hashes", "places", "classes", "sizes"],
                )
                block += 1

    return docs.select(F.col("text").cast("string")).mapInArrow(run, PACKED)


def shared_shingles(packed: DataFrame) -> DataFrame:
    """The shingles that are held more than once, with how often, for each block and part of the hashes."""

    def merge(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(v.as_py(), "<u4") for v in table.column("hashes")]
        whole = np.concatenate(hashes)
        order = np.argsort(whole)
        ordered = whole[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        times = np.diff(np.append(starts, len(whole)))
        held = np.empty(len(whole), "<u4")
        held[order] = np.repeat(times, times)
        found: list[list] = [[], [], []]
        for mine, places, n in zip(hashes, table.column("places"), np.split(held, np.cumsum([len(h) for h in hashes])[:-1])):
            places = np.frombuffer(places.as_py(), _kind(places.as_py(), len(mine)))
            for column, v in zip(found, (mine, places, n)):
                column.append(v[n > 1].tobytes())
        columns = [table.column("part"), table.column("block"), *(pa.array(v, pa.binary()) for v in found)]
        answers = pa.table([*columns, table.column("classes"), table.column("sizes")], names=SHARED_NAMES)
        return answers.filter(np.array([len(v) > 0 for v in found[0]]) | answers.column("classes").is_valid().to_numpy())

    return packed.groupBy("part").applyInArrow(merge, SHARED)


def _kind(places: bytes, count: int) -> str:
    """Places take as many bytes as the block's number of texts asks for."""
    return f"<u{len(places) // count}" if count else "<u2"


def postings(shared: DataFrame, percent: int) -> DataFrame:
    """The shared ones among each class's rarest shingles: token, class, n, weight.

    One more than needed is taken, for two shingles of a text shortened to the same token. A class
    that lies in several blocks has the same postings in each.
    """

    def rarest(table: pa.Table) -> pa.Table:
        named = table.filter(table.column("classes").is_valid())
        if named.num_rows != 1:
            raise ValueError("the rows of a block changed between two reads")
        classes, sizes = (np.frombuffer(named.column(c)[0].as_py(), kind).astype(np.int64) for c, kind in (("classes", "<i8"), ("sizes", "<u4")))
        hashes = [np.frombuffer(v.as_py(), "<u4") for v in table.column("hashes")]
        answers = [len(h) for h in hashes]
        hashes = np.concatenate(hashes).astype(np.int64)
        held = np.concatenate([np.frombuffer(v.as_py(), "<u4") for v in table.column("held")]).astype(np.int64)
        places = np.concatenate([np.frombuffer(v.as_py(), _kind(v.as_py(), n)) for v, n in zip(table.column("places"), answers)]).astype(np.int64)
        tokens = (np.repeat(table.column("part").to_numpy().astype(np.int64), answers) << 32) | hashes
        order = np.lexsort((tokens, held, places))
        places, tokens, held = places[order], tokens[order], held[order]
        starts = np.flatnonzero(np.diff(places, prepend=-1))
        shared = np.diff(np.append(starts, len(places)))
        n_of = sizes[places[starts]]
        take = n_of - -(-n_of * percent // 100) + 2 - (n_of - shared)
        weight = np.repeat(np.add.reduceat(held, starts) if len(held) else held, shared)
        kept = np.arange(len(places)) - np.repeat(starts, shared) < np.repeat(take, shared)
        columns = classes[places], sizes[places], weight, tokens
        return pa.table([pa.array(v[kept]) for v in columns], names=["class", "n", "weight", "token"])

    return shared.groupBy("block").applyInArrow(rarest, POSTINGS)


def tiled(posts: DataFrame, percent: int) -> DataFrame:
    """Postings by shingle and size band, once at home and once as visitors of the next larger band."""
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    at = F.explode(F.array(F.struct(band.alias("band"), F.lit(True).alias("home")), F.struct((band + 1).alias("band"), F.lit(False).alias("home"))))
    return posts.select("token", "class", "n", "weight", at.alias("at")).select("token", "at.band", "at.home", "class", "n", "weight")


def leader_pairs(tiles: DataFrame) -> DataFrame:
    """Each class with the best connected class that leads most of its tiles."""
    rank = F.struct("weight", "class")
    lead = tiles.groupBy("token", "band").agg(F.max(rank)["class"].alias("leader"), F.count("*").alias("members"), F.max("home").alias("home"))
    lead = lead.filter("members > 1 AND home").select("token", "band", "leader")
    votes = tiles.join(lead, ["token", "band"]).filter(F.col("class") != F.col("leader")).groupBy("class", "leader").agg(F.count("*").alias("votes"))
    best = votes.groupBy("class").agg(F.max_by("leader", F.struct("votes", "leader")).alias("leader"))
    return best.select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")).distinct()


def _close(ones: np.ndarray, others: np.ndarray, sizes_one: np.ndarray, sizes_other: np.ndarray, percent: int) -> np.ndarray:
    """Which of all pairs may be alike by bitmaps of equal width."""
    missing = np.bitwise_count(ones[:, None, :] & ~others[None, :, :]).sum(axis=2, dtype=np.int64)
    lacking = np.bitwise_count(others[None, :, :] & ~ones[:, None, :]).sum(axis=2, dtype=np.int64)
    bound = np.minimum(sizes_one[:, None] - missing, sizes_other[None, :] - lacking)
    return 100 * bound >= percent * (sizes_one[:, None] + sizes_other[None, :] - bound)


def _folded(bits: list[bytes]) -> np.ndarray:
    """Bitmaps halved to the narrowest width among them."""
    width = min(map(len, bits))
    out = np.empty((len(bits), width // 8), np.uint64)
    for i, b in enumerate(bits):
        out[i] = np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, width // 8), axis=0)
    return out


def _met_before(tiles: pa.ListArray, tile: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which pairs meet in a tile of a smaller code too, where one of the two is at home.

    ``tiles``: the codes of each member's tiles, odd where it is at home.
    """
    codes, rows = tiles.flatten().to_numpy(), np.repeat(np.arange(len(tiles)), tiles.value_lengths().to_numpy())
    earlier = (codes & ~1) < tile
    codes, rows = codes[earlier], rows[earlier]
    at, held = np.unique(codes & ~1, return_inverse=True, return_counts=True)[1:]
    shared = held[at] > 1
    codes, rows, at = codes[shared], rows[shared], np.unique(at[shared], return_inverse=True)[1]
    met = np.zeros((len(one), len(two)), bool)
    for low in range(0, int(at.max()) + 1 if len(at) else 0, TILES_AT_ONCE):
        some = (at >= low) & (at < low + TILES_AT_ONCE)
        there = np.zeros((len(tiles), TILES_AT_ONCE), np.float32)
        there[rows[some], at[some] - low] = 1
        home = there.copy()
        home[rows[some], at[some] - low] = codes[some] & 1
        met |= (home[one] @ there[two].T + there[one] @ home[two].T) > 0
    return met


def rest_pairs(tiles: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that the bitmaps cannot rule out, from tiles with several."""
    part_of = tiles.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    held = part_of.groupBy("token", "band").agg(
        F.count("*").alias("members"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.max("home").alias("home"),
        F.sum(F.xxhash64("class", "home").cast("decimal(20,0)")).alias("same"),
    )
    several = held.filter("low <> high AND home").groupBy("band", "members", "same").agg(F.min("token").alias("token"))
    code = F.xxhash64("token", "band").bitwiseAND(F.lit(-2)).alias("tile")
    met = part_of.join(several.select("token", "band", "members"), ["token", "band"])
    met = written(met.select("token", "band", "home", "class", "n", "component", "members", code), "members")
    theirs = met.groupBy("class").agg(F.collect_list(F.col("tile") + F.col("home").cast("bigint")).alias("tiles"))
    cells = F.greatest(F.lit(1), F.ceil(F.col("members") / CELL_MEMBERS)).cast("int")
    mine = F.pmod(F.xxhash64("class"), cells).cast("int")
    grid = (
        met.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), cells - 1)))
        .select(
            "token", "band", "tile", "home", "class", "n", "component", "mine",
            F.least("mine", "other").alias("row"), F.greatest("mine", "other").alias("column"),
        )
        .join(sets.select("class", "bits").join(theirs, "class"), "class")
    )

    def compare(table: pa.Table) -> pa.Table:
        row, column = table.column("row")[0].as_py(), table.column("column")[0].as_py()
        home = np.array(table.column("home").to_pylist(), bool)
        kind, n, part, mine = (table.column(c).to_numpy() for c in ("class", "n", "component", "mine"))
        bits = _folded(table.column("bits").to_pylist())
        one, two = np.flatnonzero(mine == row), np.flatnonzero(mine == column)
        near = (part[one][:, None] != part[two][None, :]) & (home[one][:, None] | home[two][None, :])
        step = max(1, WORDS_AT_ONCE // max(1, len(two) * bits.shape[1]))
        for i in range(0, len(one), step):
            x = one[i : i + step]
            near[i : i + step] &= _close(bits[x], bits[two], n[x], n[two], percent)
        if near.any():
            near &= ~_met_before(table.column("tiles").combine_chunks(), table.column("tile")[0].as_py(), one, two)
        p, q = np.nonzero(near)
        a, b = kind[one[p]], kind[two[q]]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return grid.groupBy("token", "band", "row", "column").applyInArrow(compare, PAIRS)


def _classes_in(pairs: DataFrame) -> DataFrame:
    """The classes on either side, each once; sides are reduced before they meet."""
    one, two = (pairs.select(F.col(side).alias("class")).distinct() for side in ("a", "b"))
    return one.union(two).distinct()


def _needed(pairs: DataFrame) -> np.ndarray:
    """A filter of fixed size over the classes in ``pairs``; it may let others pass."""
    each = _classes_in(pairs)
    bit = F.pmod(F.col("class"), F.lit(FILTER_WORDS * 64))
    words = each.select((bit / 64).cast("bigint").alias("at"), F.expr(f"shiftleft(1L, CAST(pmod(class, {FILTER_WORDS * 64}) % 64 AS INT))").alias("bit"))
    found = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_WORDS, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def exact_links(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs that are alike, by intersection of their sorted sets.

    Sets are made again for the classes in ``pairs`` only, found by a filter of fixed size.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_needed(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = sent.value
        for whole in batches:
            for batch in pieces(whole, "text", SLICE_BYTES):
                grams, bounds, classes = sets_of(batch.column(0), k)
                bit = (classes % (FILTER_WORDS * 64)).astype(np.uint64)
                wanted = (needed[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
                _, first = np.unique(classes, return_index=True)
                rows = np.intersect1d(first, np.flatnonzero(wanted))
                lists = [grams[bounds[i] : bounds[i + 1]].view(np.int64) for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[rows]), pa.array(lists, pa.list_(pa.int64()))], names=["class", "shingles"]
                )

    made = docs.select(F.col("text").cast("string")).mapInArrow(run, "class BIGINT, shingles ARRAY<BIGINT>")
    wanted = _classes_in(pairs)
    made = written(made.join(wanted, "class", "left_semi").dropDuplicates(["class"]), "shingle-sets")
    side = lambda name: made.select(F.col("class").alias(name), F.col("shingles").alias(f"of_{name}"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * both >= percent * union).select("a", "b")


def similar_groups(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """Every document with its set's size, its class and its component's smallest doc_id."""
    sets = written(document_sets(docs, k), "sets")
    classes = sets.groupBy("class").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("doc_id").alias("least_id"))
    classes = written(classes, "classes")
    total = sets.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-int(total) // PART_SHINGLES))
    posts = written(postings(shared_shingles(packed_shingles(docs, parts, k)), percent), "postings")
    posts = written(posts.dropDuplicates(["class", "token"]), "postings")
    tiles = tiled(posts, percent)
    links = written(exact_links(docs, written(leader_pairs(tiles), "leaders"), k, percent), "links")
    found = written(components(links), "components")
    rest = written(rest_pairs(tiles, classes, found, percent), "pairs")
    more = written(exact_links(docs, rest, k, percent), "links")
    found = written(components(links.unionByName(more)), "components")
    named = classes.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").select("class", "component_id")
    return sets.join(named, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "class",
        "row_key",
    )


def one_of_each_group(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """The documents with the smallest doc_id of their component, with all their columns.

    Where no member has a doc_id all of them stay.
    """
    gone = similar_groups(docs, k, percent).filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    return without_rows(docs, written(gone.select("row_key").distinct(), "alike"))
