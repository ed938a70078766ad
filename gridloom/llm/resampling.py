"""Operator 11: importance resampling towards a target distribution.

Word runs of corpus and target are counted in hashed buckets. The log ratio of a bucket's smoothed
shares is its gain; gains are one array, and a document's weight is the mean of its entries. Each
document adds a keyed Gumbel draw to its weight, and the highest scores are drawn: a sample without
replacement by importance. The border score is found by a distributed quickselect: random pivot
keys, exact counts of rows before, at and after each, until the k-th key itself is a pivot. Only the
winners are sorted and ranked.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.tables import LOWER, own_names, released, text_chunks, written
from gridloom.operators.ordered import cname, global_position

BUCKETS = 10_000
PIVOTS = 32
#: Words longer than this are finished one by one; shorter ones advance together, a byte at a time.
LONG = 48

WORDY = np.zeros(256, bool)
WORDY[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_steps() -> np.ndarray:
    """What one byte does to a CRC-32 (reflected polynomial 0xEDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_steps()


def crc_after(crc: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The CRC-32 of each string already read followed by ``data[start:stop]``; 0 stands for nothing read."""
    length = stop - start
    order = np.argsort(-length, kind="stable")
    state, first, length = ~crc[order].astype(np.uint32), start[order], length[order]
    # How many strings have more than j bytes.
    alive = np.searchsorted(-length, -np.arange(min(int(length[0]) if len(length) else 0, LONG)), "left")
    for j, n in enumerate(alive):
        state[:n] = _CRC[(state[:n] ^ data[first[:n] + j]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    state = ~state
    for i in range(int(np.searchsorted(-length, -LONG, "left"))):
        state[i] = zlib.crc32(data[first[i] + LONG : first[i] + length[i]].tobytes(), int(state[i]))
    out = np.empty_like(state)
    out[order] = state
    return out


def feature_chunks(column: pa.Array, runs: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words per row, row of each feature, bucket of each feature), about a megabyte of text each."""
    for row, offsets, raw in text_chunks(column):
        data = LOWER[raw]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = WORDY[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        stop = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        start = start[start < len(data)]
        words = np.diff(np.searchsorted(start, offsets))
        rows = np.repeat(np.arange(len(words)), words)
        at, crc, space = np.arange(len(start)), np.zeros(len(start), np.uint32), np.frombuffer(b" ", np.uint8)
        found = []
        for run in range(runs):
            if run:
                keep = at + run < len(start)
                keep[keep] = rows[at[keep]] == rows[at[keep] + run]
                at, crc = at[keep], crc[keep]
                crc = crc_after(crc, space, np.zeros(len(at), np.int64), np.ones(len(at), np.int64))
            crc = crc_after(crc, data, start[at + run], stop[at + run])
            found.append((rows[at], (crc % np.uint32(buckets)).astype(np.int64)))
        yield row, words, *(np.concatenate(x) for x in zip(*found))


def bucket_counts(texts: DataFrame, text: str = "text", runs: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of all texts; each task sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, bucket in feature_chunks(batch.column(0), runs, buckets):
                counts += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    slim = own_names(texts, **{text: "text"}).select(F.col("text").cast("string"))
    return slim.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of the target's smoothed share of each bucket over the corpus's: one entry per bucket.

    Both counts have at most ``buckets`` rows and are written, so that the texts are read once.
    """
    corpus, target = written(corpus, "corpus-counts"), written(target, "target-counts")
    total = [F.coalesce(c.agg(F.sum("n")).scalar(), F.lit(0)).cast("double") for c in (corpus, target)]
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    ).unionByName(corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t")))
    sums = both.groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    ratio = ((F.col("t") + 1) * (total[0] + buckets)) / ((F.col("s") + 1) * (total[1] + buckets))
    rows = sums.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()  # ``buckets`` rows
    released(corpus, target)
    out = np.zeros(buckets, np.int64)
    out[[r.bucket for r in rows]] = [r.gain for r in rows]
    return out


def weighted(documents: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", runs: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight: the floored mean of the gains of a text's features, 0 if none."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, words, owner, bucket in feature_chunks(batch.column(1), runs, buckets):
                here = slice(row, row + len(words))
                n_words[here] = words
                n_features[here] = np.bincount(owner, minlength=len(words))
                # Sums of whole numbers below 2^53 are exact in doubles.
                sums = np.bincount(owner, gain[bucket].astype(np.float64), minlength=len(words)).astype(np.int64)
                weight[here] = sums // np.maximum(n_features[here], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    slim = own_names(documents, **{key: "doc_id", text: "text"}).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """A Gumbel draw in thousandths, floored, that only seed and key decide (a null key as the empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def kth_key(rows: DataFrame, key: Sequence[str], k: int, pivots: int = PIVOTS, seed: int = 1) -> tuple | None:
    """The k-th smallest key (1-based) of whole-number columns; None beyond the number of rows.

    Each round draws random rows of the open interval that is left (the least of a seeded hash per slot, so
    a task that runs again draws the same) and counts the rows before and at each of them. The k-th key is
    a pivot or lies between two; a key that many rows share is one pivot. The driver sees ``pivots`` keys
    a round, whatever the rows.
    """

    def beside(column: tuple, op: str) -> Column:
        whole, bound = F.struct(*map(cname, key)), F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(key, column)])
        return whole < bound if op == "<" else whole > bound if op == ">" else whole == bound

    rows = rows.select(*[cname(c).cast("long").alias(c) for c in key])
    low = high = None
    before, turn = 0, 0
    while True:
        left = rows
        if low is not None:
            left = left.where(beside(low, ">"))
        if high is not None:
            left = left.where(beside(high, "<"))
        turn += 1
        draw = F.xxhash64(F.lit(seed), F.lit(turn), *map(cname, key))
        drawn = left.withColumn("_draw", draw).groupBy(F.pmod("_draw", F.lit(pivots)).alias("_slot")).agg(
            F.min_by(F.struct(*map(cname, key)), "_draw").alias("_pivot")
        )
        found = sorted({tuple(r["_pivot"]) for r in drawn.collect()})
        if not found:
            return None
        parts = [F.sum(beside(p, op).cast("long")) for p in found for op in "<="]
        counts = left.agg(*[c.alias(f"_{i}") for i, c in enumerate(parts)]).first()
        upto = [before + counts[2 * i] + counts[2 * i + 1] for i in range(len(found))]
        at = bisect.bisect_left(upto, k)
        if at < len(found):
            if before + counts[2 * at] < k:
                return found[at]
            high = found[at]
        if at:
            low, before = found[at - 1], upto[at - 1]


def resampled(
    documents: DataFrame, target: DataFrame, percent: int = 10, seed: int = 2024, least_words: int = 20,
    runs: int = 1, buckets: int = BUCKETS, key: str = "doc_id", text: str = "text", pivots: int = PIVOTS,
) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank; rank is null where it is not drawn.

    Features are all runs of 1 to ``runs`` words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
    Of the N documents with ``least_words`` words, floor(percent * N / 100) with the highest scores are drawn,
    ties to the smaller doc_id, then to fewer features; a null doc_id comes last and is hashed as the empty
    text. Rows that agree in all of these are the same row of the result, so it does not matter which is
    drawn. Repeated rows are documents of their own. Null texts are empty; a text without features has
    weight 0. An empty table gives no rows; an empty target is the even distribution. Extra columns
    count for nothing.
    """
    gain = gains(bucket_counts(documents, text, runs, buckets), bucket_counts(target, text, runs, buckets), buckets)
    scored = weighted(documents, gain, key, text, runs).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = written(
        scored.select(
            "doc_id", "n_features", "weight", "score",
            F.when(F.col("n_words") >= least_words, -F.col("score")).alias("_first"),
            F.col("doc_id").isNull().cast("long").alias("_nameless"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"),
        ),
        "scores",
    )
    order = ["_first", "_nameless", "_id", "n_features"]
    sampled = scored.where("_first IS NOT NULL")
    wanted = percent * sampled.count() // 100
    border = kth_key(sampled, order, wanted, pivots) if wanted else None
    result = ["doc_id", "n_features", "weight", "score", "rank"]
    if border is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*result)
    drawn = F.struct(*map(F.col, order)) <= F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(order, border)])
    drawn = F.col("_first").isNotNull() & drawn
    winners = global_position(scored.where(drawn), order, "rank")
    winners = winners.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")).cast("long"))
    others = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return winners.select(*result).unionByName(others.select(*result))
