"""Operator 2: hierarchical weighted hash tree, native.

A tree of regions, racks and shards with weights. Each row descends it: on every level each
child draws ``ln(u) / weight`` from a hash of the row's key and the child's place, and the
largest draw wins, so a child gets a share in proportion to its weight, and a changed weight
moves rows only into or out of the subtrees whose weights changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Regions, of racks, of shard weights.
Tree = tuple[tuple[tuple[float, ...], ...], ...]
SLOT_BLOCKS = 4096


def uniform_tree(shards: int, racks: int = 2, per_rack: int = 4) -> Tree:
    """Equal shards in regions of ``racks`` racks of ``per_rack``; what is left over lies in
    regions of one shard each, so that ``grown`` trees differ by a new region only."""
    full = shards // (racks * per_rack)
    left = shards - full * racks * per_rack
    return (((1.0,) * per_rack,) * racks,) * full + (((1.0,),),) * left


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, in a region of its own: no other subtree's weight changes, so rows move
    only into the new shard. (A shard added to an old rack would also move rows between the
    racks' other shards, because the weights above it change.)"""
    return (*tree, ((weight,),))


def _draw(key: Column, place: list[Column], weight: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, *place), 11)
    unit = (bits + 1).cast("double") * F.lit(2.0**-53)
    return F.when(weight > 0, F.log(unit) / weight)


def _winner(key: Column, above: list[Column], width: int, weight) -> Column:
    """Index of the child with the largest draw; equal draws go to the larger index."""
    draws = [F.struct(_draw(key, [*above, F.lit(j)], weight(j)).alias("d"), F.lit(j).alias("j")) for j in range(width)]
    return (F.greatest(*draws) if width > 1 else draws[0])["j"]


def descend(df: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """``df`` with the shard number of each row's key (shards are numbered in tree order).

    A null key is a key like any other. Equal keys share a shard.
    """
    racks = max(len(r) for r in tree)
    leaves = max(len(k) for r in tree for k in r)
    rack_weights = [sum(r[j]) if j < len(r) else 0.0 for r in tree for j in range(racks)]
    leaf_weights, first, numbers = [], [], 0
    for r in tree:
        for j in range(racks):
            shards = r[j] if j < len(r) else ()
            leaf_weights += [shards[i] if i < len(shards) else 0.0 for i in range(leaves)]
            first.append(numbers)
            numbers += len(shards)

    def pick(values: list, at: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))

    k = F.col(f"`{key}`")
    region, rack = F.col("__region"), F.col("__rack")
    df = df.withColumn("__region", _winner(k, [F.lit("region")], len(tree), lambda j: F.lit(float(sum(map(sum, tree[j]))))))
    df = df.withColumn("__rack", _winner(k, [F.lit("rack"), region], racks, lambda j: pick(rack_weights, region * racks + j)))
    node = region * racks + rack
    shard = _winner(k, [F.lit("shard"), region, rack], leaves, lambda j: pick(leaf_weights, node * leaves + j))
    return df.withColumn(out, (pick(first, node) + shard).cast("int")).drop("__region", "__rack")


def with_slots(df: DataFrame, key: str, shard: str, blocks: int = SLOT_BLOCKS) -> DataFrame:
    """Gapless ``slot`` from 0 within each shard, whose rows never meet in one task.

    Rows of a shard are dealt to ``blocks`` blocks by key; counts per block (a table of
    shards x blocks rows) give each block its first slot, and rows are numbered per block.
    """
    df = df.withColumn("__block", F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(blocks)).cast("int"))
    sizes = df.groupBy(shard, "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(shard, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(shard, "__block").orderBy(*[c for c in df.columns if c not in (shard, "__block")])
    return (
        df.join(first, [shard, "__block"])
        .withColumn("slot", (F.col("__first") + F.row_number().over(inside) - 1).cast("long"))
        .drop("__block", "__first")
    )


def shard_rows(documents: DataFrame, tree: Tree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Law ``key``: the key and the tree alone decide, so equal texts under different keys may lie
    apart. Null text: no bytes, size 8, crc 0. Repeated rows share a shard and take a slot each.
    Empty input gives an empty result. Extra columns are left behind.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    slim = documents.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
    )
    slim = descend(descend(slim, "doc_id", tree, "shard"), "doc_id", grown(tree), "grown_shard")
    return with_slots(slim, "doc_id", "shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
