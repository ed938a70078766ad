"""Operator 13: what each filter removes in every order, from one pass over the rows.

A document is reduced to the set of filters it fails (a bit mask). The states of a lattice are the
sets of filters already applied; an edge applies one more. Forward counts say how many orders reach
a state, backward counts how many lead from it to the end, so an edge lies on forward x backward
orders. The Shapley sum of a filter weighs the rows its edges remove by that number, and each step
of each order is read from the same edges. The documents are read once, whatever the orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.tables import own_names, written

LETTERS = "ABCDE"
#: Rows per part grow with the factorial of the filters: 7 give 35,280.
MOST_FILTERS = 7

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
_CONTINUATION = bytes(range(0x80, 0xC0))


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """How many orders reach each state from none, and how many lead from it to all filters."""
    full = (1 << filters) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(1, full + 1):
        forward[state] = sum(forward[state ^ (1 << f)] for f in range(filters) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        backward[state] = sum(backward[state | (1 << f)] for f in range(filters) if not state >> f & 1)
    return forward, backward


def edge_weights(filters: int) -> list[int]:
    """Orders through the edge (state, filter) at place ``state * filters + filter``; 0 where there is none."""
    forward, backward = path_counts(filters)
    return [
        0 if state >> f & 1 else forward[state] * backward[state | (1 << f)]
        for state in range(1 << filters)
        for f in range(filters)
    ]


def mask_counts(df: DataFrame, filters: Mapping[str, Column], part: Column, good: Column, toxic: Column) -> DataFrame:
    """part, mask, n, good, toxic of rows whose failures are given as one boolean column per filter.

    A null failure counts as passed, a null part as the empty string, a null good or toxic as false.
    """
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())), F.lit(0))
    flags = [F.coalesce(c.cast("boolean"), F.lit(False)).cast("long") for c in (good, toxic)]
    rows = df.select(
        F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
        flags[0].alias("good"), flags[1].alias("toxic"),
    )
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


def path_audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts per (part, mask).

    ``counts`` has part, mask (bit i: fails the filter ``letters[i]``), n, good and toxic; it may
    hold several rows per (part, mask). An empty table gives no rows. A part has at most two to the
    number of filters masks, so its list is short however many rows it stands for.
    """
    k = len(letters)
    if not 0 < k <= MOST_FILTERS or len(set(letters)) != k:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters with different letters")
    full, orders = (1 << k) - 1, ",".join(map("".join, permutations(letters)))
    weights = F.split(F.lit(",".join(map(str, edge_weights(k)))), ",").cast("array<bigint>")
    per_mask = counts.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])
    parts = per_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    # Rows left in each state: those that fail none of its filters.
    parts = parts.select("part", F.expr(f"""
        transform(sequence(0, {full}), s -> aggregate(
          filter(masks, m -> (m.mask & s) = 0), named_struct('n', 0L, 'good', 0L, 'toxic', 0L),
          (a, m) -> named_struct('n', a.n + m.n, 'good', a.good + m.good, 'toxic', a.toxic + m.toxic)))""").alias("left"))
    parts = parts.select("part", "left", weights.alias("weights"), F.expr(f"""
        flatten(transform(sequence(0, {full}), s -> transform(sequence(0, {k - 1}), f -> named_struct(
          'removed', left[s].n - left[s | shiftleft(1, f)].n,
          'good_lost', left[s].good - left[s | shiftleft(1, f)].good,
          'toxic_lost', left[s].toxic - left[s | shiftleft(1, f)].toxic))))""").alias("edges"))
    parts = parts.select("part", "left", "edges", F.expr(f"""
        transform(sequence(0, {k - 1}), f -> aggregate(sequence(0, {full}), 0L,
          (a, s) -> a + weights[s * {k} + f] * edges[s * {k} + f].removed))""").alias("shapley"))
    applied = " + ".join(f"CASE WHEN instr(substring(o, 1, t - 1), '{c}') > 0 THEN {1 << i} ELSE 0 END" for i, c in enumerate(letters))
    at = f"instr('{letters}', substring(o, t, 1)) - 1"
    steps = F.expr(f"""
        flatten(transform(split('{orders}', ','), o -> transform(sequence(1, {k}), t -> named_struct(
          'filter_order', o, 'step', t, 'state', {applied}, 'f', {at}))))""")
    read = F.expr(f"""
        transform(steps, p -> named_struct(
          'filter_order', p.filter_order, 'step', p.step,
          'kept', left[p.state | shiftleft(1, p.f)].n,
          'removed', edges[p.state * {k} + p.f].removed,
          'redundant', edges[p.f].removed - edges[p.state * {k} + p.f].removed,
          'unique_fails', left[{full} - shiftleft(1, p.f)].n - left[{full}].n,
          'good_lost', edges[p.state * {k} + p.f].good_lost,
          'toxic_lost', edges[p.state * {k} + p.f].toxic_lost,
          'shapley', shapley[p.f]))""")
    return parts.withColumn("steps", steps).select("part", F.inline(read))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, prints = [], []
        for value in batch.column(2):
            body = (value.as_py() or "").encode()
            words = body.split()  # of bytes: cut at 0x20 and 0x09 to 0x0D, nothing else
            points = len(body.translate(None, _CONTINUATION))
            masks.append(
                (len(words) < 50)
                | (100 * len(set(words)) < 65 * len(words)) << 1
                | (100 * (len(body) - len(body.translate(None, _UPPER))) > 5 * points) << 2
                | (len(body.translate(None, _SYMBOLS)) < len(body)) << 3
            )
            prints.append(hashlib.sha256(body).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(prints, pa.binary())],
            ["doc_id", "part", "mask", "print"],
        )


def document_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts per (source, mask) of the filters A to E of a text corpus.

    A: under 50 words; B: under 65 different words of 100; C: over 5 of 100 code points in A-Z; D: any of
    ``#$%&*|``; E: a smaller doc_id has the same text (compared by SHA-256). Null text: empty. Null source:
    empty string. A null doc_id is neither smaller nor larger than another, so such a row never fails E; nor
    do rows that repeat the smallest doc_id. A document is good or toxic if any of its labels says 1; labels
    of no document, and extra columns, count for nothing.

    No group of copies meets in one task: the smallest doc_id of a text is found per task before
    the shuffle (a limit of rank 1), and the copies are what is left of the total.
    """
    slim = own_names(documents, doc_id="doc_id", source="part", text="text").select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string")
    )
    seen = slim.mapInArrow(_measured, "doc_id long, part string, mask int, print binary")
    rows = seen.groupBy("doc_id", "part", "mask", "print").agg(F.count(F.lit(1)).alias("n"))
    marks = own_names(labels, doc_id="label_id", quality="quality", toxic="toxic").where("label_id IS NOT NULL")
    marks = marks.groupBy(F.col("label_id").cast("long").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    # Rows without doc_id are spread by their text and match no label.
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.xxhash64("print")), "nameless": F.col("doc_id").isNull()})
    marks = marks.withColumn("labelled", F.lit(False))
    joined = rows.join(marks, (F.col("key") == F.col("label_id")) & (F.col("nameless") == F.col("labelled")), "left")
    table = written(
        joined.select(
            "doc_id", "part", "mask", "print", "n",
            (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        ),
        "audit-rows",
    )
    first = table.where("doc_id IS NOT NULL").withColumn("place", F.rank().over(Window.partitionBy("print").orderBy("doc_id")))
    first = first.where("place = 1").drop("place").unionByName(table.where("doc_id IS NULL"))
    copy = 1 << 4

    def signed(df: DataFrame, bit: int, sign: int) -> DataFrame:
        return df.select("part", F.col("mask").bitwiseOR(bit).alias("mask"), *[(sign * F.col(c)).alias(c) for c in ("n", "good", "toxic")])

    firsts = first.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    signs = firsts.select("part", "mask", "n", "good", "toxic", F.explode(F.array(F.lit(0), F.lit(copy))).alias("bit"))
    signs = signs.select(
        "part", F.col("mask").bitwiseOR(F.col("bit")).alias("mask"),
        *[(F.when(F.col("bit") == 0, 1).otherwise(-1) * F.col(c)).alias(c) for c in ("n", "good", "toxic")],
    )
    return signed(table, copy, 1).unionByName(signs)
