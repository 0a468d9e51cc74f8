"""Shards by a hierarchical weighted hash tree.

A document descends region, rack and shard. At each level every child draws ``-ln(u) / weight``
with ``u`` from a hash of the document's key, the child and the level, and the smallest draw wins:
children win in proportion to their weights, and a child whose weight grows only wins documents,
from its siblings alone. Movement stays in the subtrees whose weights change. ``with_shard`` adds a
shard as a region of its own, so it takes documents only into itself.

Defined cases: the key is doc_id alone (equal texts may part); a null doc_id is a key like others;
a null text has no bytes; repeated rows share a shard and get slots of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bytes counted for each document besides its text.
OVERHEAD = 16
# Blocks in which the slots of a shard are numbered; a block is what one task sorts.
BLOCKS = 1024


@dataclass(frozen=True)
class ShardTree:
    """``regions[i][j]`` lists the weights of the shards in rack j of region i, in shard order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    def __post_init__(self):
        if not all(w > 0 for region in self.regions for rack in region for w in rack):
            raise ValueError("weights must be above 0")

    @staticmethod
    def even(regions: int, racks: int, shards: int) -> ShardTree:
        return ShardTree((((1.0,) * shards,) * racks,) * regions)

    def with_shard(self, weight: float = 1.0) -> ShardTree:
        return ShardTree((*self.regions, ((weight,),)))

    @property
    def size(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def levels(self) -> list[list[list[tuple[int, float]]]]:
        """For each level, the (node, weight) children of each node of the level above."""
        regions, racks, shards = [], [], []
        for region in self.regions:
            regions.append((len(regions), sum(map(sum, region))))
            here = []
            for rack in region:
                here.append((len(shards), sum(rack)))
                first = sum(map(len, shards))
                shards.append([(first + i, w) for i, w in enumerate(rack)])
            racks.append(here)
        return [[regions], racks, shards]


def _drawn(key: Column, parent: Column, level: int, children: list[list[tuple[int, float]]]) -> Column:
    """The child of ``parent`` with the smallest weighted draw."""
    listed = F.array(
        *[F.array(*[F.struct(F.lit(n).alias("node"), F.lit(float(w)).alias("weight")) for n, w in row]) for row in children]
    )

    def draw(child: Column) -> Column:
        hashed = F.xxhash64(key, child["node"], F.lit(level))
        # 53 bits of the hash as a number above 0 and below 1
        share = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / F.lit(float(2**53))
        return F.struct((-F.log(share) / child["weight"]).alias("draw"), child["node"].alias("node"))

    return F.array_min(F.transform(F.element_at(listed, parent + 1), draw))["node"]


def with_shard_of(df: DataFrame, tree: ShardTree, key: str, name: str) -> DataFrame:
    """``df`` with the shard of its key in ``tree``; each level is a column of its own meanwhile."""
    parent = F.lit(0)
    for level, children in enumerate(tree.levels()):
        df = df.withColumn(f"_{name}_{level}", _drawn(F.col(key), parent, level, children))
        parent = F.col(f"_{name}_{level}")
    return df.withColumn(name, parent).drop(*[f"_{name}_{level}" for level in range(3)])


def with_slots(df: DataFrame, shard: str, order: list[str], blocks: int = BLOCKS) -> DataFrame:
    """``df`` with gapless numbers from 0 in each shard.

    A shard is numbered in hashed blocks: their sizes, at most shards x ``blocks`` rows, are summed
    up to each block's first number and broadcast, and rows are numbered inside a block.
    """
    placed = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    sizes = placed.groupBy(shard, "_block").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_first", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    inside = Window.partitionBy(shard, "_block").orderBy(*order)
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(starts), [shard, "_block"])
        .withColumn("slot", (F.col("_first") + F.col("_place") - 1).cast("bigint"))
        .drop("_block", "_first", "_place")
    )


def assign_shards(docs: DataFrame, tree: ShardTree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its size, checksum, shard, slot there, and shard once one more is added."""
    content = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    sized = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    sharded = with_shard_of(with_shard_of(sized, tree, "doc_id", "shard"), tree.with_shard(), "doc_id", "grown_shard")
    return with_slots(sharded, "shard", ["doc_id", "text_crc32", "size"])
