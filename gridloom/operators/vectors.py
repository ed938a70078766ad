"""Exact top-k by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.ordered import cname

#: Vectors a task scores at a time, and queries they meet at a time: bounds of a task's memory.
VECTORS_PER_SHARD = 16_384
QUERIES_PER_BLOCK = 8_192
_SLICE = 256
_ROUNDING = 1e-9

RESULT = "query bigint, match bigint, similarity double"


def has_cosine(vector: Column) -> Column:
    """Whether a vector has a direction: not null or empty, no null, NaN or infinite element, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    flat /= np.abs(flat).max(axis=1, keepdims=True)  # squares of very small or large elements stay in range
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _best(k: int):
    """The k best vectors of one shard for every query of one block."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        asked, ids, scores = [], [], []
        if vectors.num_rows and queries.num_rows:
            names, keys = vectors["key"].to_numpy(), queries["key"].to_numpy()
            matrix, wanted = _unit(vectors["v"], vectors.num_rows), _unit(queries["v"], queries.num_rows)
            for at in range(0, len(keys), _SLICE):
                near = wanted[at : at + _SLICE] @ matrix.T
                for key, asking, row in zip(keys[at : at + _SLICE], wanted[at : at + _SLICE], near):
                    # The k-th score by selection. All that may reach it are scored again by themselves, because the
                    # last digits of a matrix product depend on its shape and equal vectors must tie.
                    border = np.partition(row, len(row) - k)[len(row) - k] if k < len(row) else -np.inf
                    held = np.flatnonzero(row >= border - _ROUNDING)
                    exact = (matrix[held] * asking).sum(axis=1)
                    order = np.lexsort((names[held], -exact))[:k]
                    asked.append(np.full(len(order), key))
                    ids.append(names[held][order])
                    scores.append(exact[order])
        columns = [np.concatenate(c) if c else np.zeros(0, t) for c, t in ((asked, np.int64), (ids, np.int64), (scores, np.float64))]
        return pa.table([pa.array(c) for c in columns], names=["query", "match", "similarity"])

    return run


def top_k_similar(
    vectors: DataFrame, queries: DataFrame, k: int = 3, key: str = "vec_id",
    vector: str = "embedding", query_key: str = "query", query_vector: str = "vector",
    vectors_per_shard: int = VECTORS_PER_SHARD, queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """(query, match, similarity, rank): the k most similar vectors of each query.

    Vectors are dealt to shards and queries to blocks, by a hash of their key; every block meets every shard in a
    task of its own, which keeps the best k per query, so neither the driver nor a task ever holds more than
    a shard and a block, and the result shuffles k rows per query and shard. Both tables are scanned once
    (and their rows counted). What has no direction (see ``has_cosine``) or no key takes no part; a query is compared with
    vectors of its own length only. Ties go to the smaller id.
    """

    def slim(df: DataFrame, name: str, column: str) -> DataFrame:
        ready = df.select(cname(name).cast("bigint").alias("key"), cname(column).cast("array<double>").alias("v"))
        return ready.filter(F.col("key").isNotNull() & has_cosine(F.col("v"))).withColumn("dims", F.size("v"))

    shards = -(-vectors.count() // vectors_per_shard) or 1
    blocks = -(-queries.count() // queries_per_block) or 1

    def dealt(count: int) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(count)).cast("int")

    def all_of(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = slim(vectors, key, vector).withColumn("shard", dealt(shards)).withColumn("block", all_of(blocks))
    right = slim(queries, query_key, query_vector).withColumn("block", dealt(blocks)).withColumn("shard", all_of(shards))
    by = ["shard", "block", "dims"]
    partial = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_best(k), RESULT)
    best = Window.partitionBy("query").orderBy(F.desc("similarity"), "match")
    return partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mean_vectors(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """(query, vector): the mean vector of each group; vectors of different lengths in one group are an error.

    One aggregation in the JVM; tasks pass on one vector per group. Null vectors count for nothing.
    """
    known = vectors.filter(cname(vector).isNotNull()).select(
        cname(group).cast("bigint").alias("query"), array_to_vector(cname(vector).cast("array<double>")).alias("v")
    )
    return known.groupBy("query").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("vector"))
