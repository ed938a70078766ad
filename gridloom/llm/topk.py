"""Operator 3: exact top-k by inner product over KD-trees, one tree per shard.

Vectors are dealt to shards by hash. A task takes one shard and one block of queries, builds a
KD-tree (median splits on the widest axis, each node with the tight bounding box of its rows)
and lets every query visit leaves best first: a box's bound is the largest inner product any
point in it could have. A query stops when its next bound is below its k-th best score so far.
That score travels: a first pass searches one shard per query block, the second pass searches
all other shards starting from the score found.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.tables import written

SHARD_ROWS = 16384
QUERY_ROWS = 8192
LEAF_ROWS = 128
EXACT = float(1 << 53)


def usable(vector: str) -> Column:
    """Not null, and no component null, NaN or infinite."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * float(scale)))


class Tree:
    """Leaves of a KD-tree with their boxes; rows keep their numbers in ``order``."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(points))
        self.points = points
        self.cuts: list[tuple[int, int]] = []
        self._split(0, len(points), leaf_rows)
        self.low = np.array([points[self.order[a:b]].min(0) for a, b in self.cuts]).reshape(len(self.cuts), points.shape[1])
        self.high = np.array([points[self.order[a:b]].max(0) for a, b in self.cuts]).reshape(len(self.cuts), points.shape[1])

    def _split(self, a: int, b: int, leaf_rows: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            rows = self.points[self.order[a:b]]
            if b - a <= leaf_rows or not rows.shape[1] or not (width := rows.max(0) - rows.min(0)).max() > 0:
                self.cuts.append((a, b))
                continue
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(rows[:, int(width.argmax())], middle)]
            todo += [(a + middle, b), (a, a + middle)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with any point of each box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """Per query the best (score, id) pairs of a shard that may be among its k best.

    ``floor`` is each query's k-th best score from elsewhere (lowest value: none). Scores equal to
    it are kept, because a tie goes to the smaller id. Queries go forward together: in round r
    each visits its r-th best box, and queries at one box are scored in one product.
    """
    n = len(queries)
    lowest = np.iinfo(np.int64).min
    scores = np.full((n, k), lowest, np.int64)
    names = np.full((n, k), np.iinfo(np.int64).max, np.int64)
    bounds = tree.bounds(queries)
    visit = np.argsort(-bounds, axis=1, kind="stable")
    active = np.arange(n)
    for r in range(len(tree.cuts)):
        kth = np.maximum(scores[active, k - 1], floor[active])
        box = visit[active, r]
        go = bounds[active, box] >= kth
        active, box = active[go], box[go]
        if not len(active):
            break
        grouped = np.argsort(box, kind="stable")
        for part in np.split(grouped, np.flatnonzero(np.diff(box[grouped])) + 1):
            who = active[part]
            a, b = tree.cuts[box[part[0]]]
            rows = tree.order[a:b]
            got = (queries[who] @ tree.points[rows].T).astype(np.int64)
            got[own[who][:, None] == ids[rows][None, :]] = lowest
            hopeful = (got >= np.maximum(scores[who, k - 1], floor[who])[:, None]) & (got > lowest)
            some = hopeful.any(1)
            if not some.any():
                continue
            who, got = who[some], np.where(hopeful[some], got[some], lowest)
            new_ids = np.where(got > lowest, np.broadcast_to(ids[rows], got.shape), np.iinfo(np.int64).max)
            both, both_ids = np.hstack([scores[who], got]), np.hstack([names[who], new_ids])
            best = np.lexsort((both_ids, ~both), axis=1)[:, :k]
            scores[who] = np.take_along_axis(both, best, 1)
            names[who] = np.take_along_axis(both_ids, best, 1)
    return scores, names


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    flat = np.concatenate(rows.to_list()) if len(rows) and width else np.zeros(0, np.int64)
    return flat.reshape(len(rows), width)


def _searcher(k: int, leaf_rows: int):
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = len(vectors["v"].iloc[0])
        points, asked = _matrix(vectors["v"], width), _matrix(queries["v"], width)
        top = float(np.abs(points).max(initial=0)) * float(np.abs(asked).max(initial=0)) * max(1, width)
        if top < EXACT:  # products of doubles are exact then, and much faster
            points, asked = points.astype(np.float64), asked.astype(np.float64)
        own, ids = queries["id"].to_numpy(), vectors["id"].to_numpy()
        floor = queries["floor"].to_numpy()
        scores, names = search(Tree(points, leaf_rows), ids, asked, own, floor, k)
        found = scores > np.iinfo(np.int64).min
        return pd.DataFrame({"query_id": np.broadcast_to(own[:, None], scores.shape)[found], "vec_id": names[found], "score": scores[found]})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query.

    Both inputs are (id long, v array<long>). A query's own id is no candidate; equal scores go to
    the smaller id. Vectors meet queries of their own length only. Rows that repeat an id are
    candidates each; a query id that repeats is asked once, with its smallest vector. Fewer than k
    candidates give fewer rows, empty tables give none. Scores must fit in 64 bits.
    """
    vectors = vectors.withColumn("size", F.size("v"))
    queries = queries.groupBy("id").agg(F.min("v").alias("v")).withColumn("size", F.size("v"))
    # Counts per length, one row per length of a vector that occurs.
    sizes = written(
        vectors.groupBy("size").agg(F.count("*").alias("n"))
        .join(queries.groupBy("size").agg(F.count("*").alias("m")), "size")
        .select("size", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), F.ceil(F.col("m") / query_rows).cast("int").alias("blocks")),
        "vector-sizes",
    )
    vectors = vectors.join(sizes, "size").withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.col("shards")).cast("int"))
    asked = queries.join(sizes, "size").withColumn("block", F.pmod(F.xxhash64(F.lit("q"), "id"), F.col("blocks")).cast("int"))
    asked = written(asked.withColumn("first", F.pmod(F.col("block"), F.col("shards"))), "vector-queries")
    keys = ["size", "shard", "block"]
    run = _searcher(k, leaf_rows)
    schema = "query_id long, vec_id long, score long"

    def visit(wanted: DataFrame, blocks: Column) -> DataFrame:
        left = vectors.withColumn("block", F.explode(blocks)).select(*keys, "id", "v")
        return left.groupBy(*keys).cogroup(wanted.select(*keys, "id", "v", "floor").groupBy(*keys)).applyInPandas(run, schema)

    # First pass: block b searches shard b modulo the number of shards.
    lowest = F.lit(-(1 << 63)).cast("long")
    mine = F.expr("filter(sequence(0, blocks - 1), b -> pmod(b, shards) = shard)")
    one = written(visit(asked.withColumns({"shard": F.col("first"), "floor": lowest}), mine), "vectors-first")
    kth = one.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(f"n >= {k}")
    asked = asked.join(kth.select(F.col("query_id").alias("id"), "worst"), "id", "left")
    asked = asked.withColumn("shard", F.explode(F.expr("filter(sequence(0, shards - 1), s -> s <> first)")))
    rest = F.expr("filter(sequence(0, blocks - 1), b -> pmod(b, shards) <> shard)")
    two = visit(asked.withColumn("floor", F.coalesce("worst", lowest)), rest)
    # The window keeps k rows per query and task before its shuffle.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = one.unionByName(two).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
