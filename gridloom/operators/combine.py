"""Joins, unions and dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.ordered import cname, expand_rows, join_on_keys


def join_hourly(weather: DataFrame, demand: DataFrame, keys: Sequence[str] = ("zone", "datetime")) -> DataFrame:
    """Hours present on both sides. Zones without rows on one side simply give none."""
    return weather.join(demand, list(keys), "inner")


def append_new(history: DataFrame | None, new: DataFrame) -> DataFrame:
    """History followed by new rows, columns matched by name."""
    if history is None:
        return new
    return history.unionByName(new, allowMissingColumns=True)


def keep_first(df: DataFrame, keys: Sequence[str], sequence: str | Column) -> DataFrame:
    """One row per key: the one with the smallest ``sequence``; null is the largest, and equal
    sequences are decided by a hash of the row, so the order of the input plays no part.

    ``min_by`` is combined before the shuffle, so a key with very many copies does not gather
    in one task.
    """
    order = cname(sequence) if isinstance(sequence, str) else sequence
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(order.isNull(), order, F.xxhash64(*map(cname, rest or keys)))
    picked = df.groupBy(*map(cname, keys)).agg(
        F.min_by(F.struct(*map(cname, rest)), order).alias("_row")
    )
    return picked.select(
        *[cname(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def merge_history(
    history: DataFrame, new: DataFrame, keys: Sequence[str] = ("zone", "datetime"),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Append, then keep the first row per key; history wins over new rows."""
    both = append_new(
        history.withColumn("_source", F.lit(0)), new.withColumn("_source", F.lit(1))
    )
    sequence = F.struct(F.col("_source"), *map(cname, tie))
    return keep_first(both.withColumn("_sequence", sequence), keys, "_sequence").drop(
        "_source", "_sequence"
    )


def repeated_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The second and later copies of equal rows (over ``columns``, all by default).

    Copies are equal, so they are counted (combined before the shuffle) and written out again.
    """
    columns = list(columns or df.columns)
    counted = df.groupBy(*map(cname, columns)).agg(F.count(F.lit(1)).alias("_copies"))
    return expand_rows(counted.filter("_copies > 1"), F.col("_copies") - 1, "_copy").drop(
        "_copies", "_copy"
    )


def without_rows(df: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the removed ones."""
    return df.join(removed.select(*map(cname, keys)), list(keys), "left_anti")


def calendar_grid(
    df: DataFrame,
    keys: Sequence[str],
    order: str = "datetime",
    step_seconds: int = 3600,
    span_of: DataFrame | None = None,
) -> DataFrame:
    """Every step between the first and last time of ``span_of`` (``df``) for every group."""
    span = (df if span_of is None else span_of).agg(
        F.struct(F.min(cname(order)).alias("first"), F.max(cname(order)).alias("last"))
    ).scalar()
    groups = df.select(*map(cname, keys)).distinct()
    return grid_over(groups, order, span, df.schema[order].dataType, step_seconds)


def grid_over(groups: DataFrame, order: str, span: Column, kind: T.DataType, step_seconds: int = 3600) -> DataFrame:
    """Every step from ``span.first`` to ``span.last`` for every row of ``groups``."""
    steps = F.floor(
        F.timestamp_diff("SECOND", span["first"], span["last"]) / F.lit(step_seconds)
    ) + F.lit(1)
    return expand_rows(groups, steps, "_step").select(
        *map(cname, groups.columns),
        F.timestamp_add("SECOND", F.col("_step") * F.lit(step_seconds), span["first"])
        .cast(kind)
        .alias(order),
    )


def reindex(
    df: DataFrame,
    keys: Sequence[str],
    order: str = "datetime",
    step_seconds: int = 3600,
    span_of: DataFrame | None = None,
) -> DataFrame:
    """The table on its full calendar grid; missing steps have null measures."""
    grid = calendar_grid(df, keys, order, step_seconds, span_of)
    return join_on_keys(grid, df, [*keys, order], "left").select(*map(cname, df.columns))


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise if a key occurs twice."""
    twice = df.groupBy(*map(cname, keys)).count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"duplicate rows for key {list(keys)}; dedupe first")
    return df
