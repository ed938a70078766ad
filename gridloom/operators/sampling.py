"""Resampling with replacement, over-sampling, and thinning of one category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.combine import reindex
from gridloom.operators.ordered import (
    HASH_BLOCKS,
    attach,
    below_cuts,
    cname,
    cut_points,
    expand_rows,
    hash_block,
    join_on_keys,
    block_positions,
    seeded_order,
    time_block,
)
from gridloom.operators.splits import seeded_positions
from gridloom.operators.windows import impute_rolling_mean


def draws(sizes: DataFrame, wanted: Column, seed: int) -> DataFrame:
    """(group, draw, at): for each wanted draw a pseudo-random row number of its group.

    ``sizes`` has one row per group with its row count ``n``. The hash takes in the group, so groups
    of one size draw differently, and 60 bits leave no row of any real group out of reach.
    """
    groups = [c for c in sizes.columns if c != "n"]
    numbered = expand_rows(sizes.withColumn("_wanted", wanted), F.col("_wanted"), "draw")
    return numbered.withColumn(
        "at", (seeded_order(*groups, "draw", seed=seed) % F.col("n")) + F.lit(1)
    ).drop("_wanted", "n")


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(cname(group)).agg(F.count(F.lit(1)).alias("n"))


def sample_with_replacement(
    placed: DataFrame, sizes: DataFrame, group: str, position: str, wanted: Column, seed: int = 42
) -> DataFrame:
    """``wanted`` rows of each group, drawn with replacement from numbered rows.

    ``sizes`` holds the row count ``n`` of each group. Draws join rows on (group, row number): one
    hash join on an even key.
    """
    picks = draws(sizes, wanted, seed).withColumnRenamed("at", position)
    return join_on_keys(picks, placed, [group, position], "inner")


def resample_to_largest(
    df: DataFrame, group: str, key: str, seed: int = 42, blocks: int = HASH_BLOCKS
) -> DataFrame:
    """Every group resampled with replacement to the size of the largest group."""
    sizes = group_sizes(df, group)
    largest = sizes.agg(F.max("n")).scalar()
    placed = seeded_positions(df, [group], key, seed, "_at", blocks)
    sampled = sample_with_replacement(placed, sizes, group, "_at", largest, seed)
    return sampled.select("draw", *map(cname, df.columns))


def over_sample(
    df: DataFrame, group: str, key: str, seed: int = 42, blocks: int = HASH_BLOCKS
) -> DataFrame:
    """All rows, plus for each smaller group drawn copies up to the majority size.

    Rows of the majority group are neither numbered nor shuffled.
    """
    sizes = group_sizes(df, group)
    largest = sizes.agg(F.max("n")).scalar()
    smaller = sizes.filter(F.col("n") < largest)
    placed = seeded_positions(attach(df, smaller.select(cname(group)), [group], "left_semi"), [group], key, seed, "_at", blocks)
    copies = sample_with_replacement(placed, smaller, group, "_at", largest - F.col("n"), seed)
    return df.withColumn("copied", F.lit(False)).unionByName(
        copies.select(*map(cname, df.columns)).withColumn("copied", F.lit(True))
    )


def impute_and_resample(
    df: DataFrame, group: str, day: str, features: Sequence[str], seed: int = 42,
    step_seconds: int = 86400,
) -> DataFrame:
    """Daily grid per slice, rolling-3 imputation, then resampling to the largest slice.

    The largest slice is counted before the grid, as rows per slice of the input.
    """
    largest = group_sizes(df, group).agg(F.max("n")).scalar()
    grid = reindex(df, [group], day, step_seconds)
    filled = impute_rolling_mean(grid, features, [group], day)
    placed = block_positions(filled, [group], time_block(day, "year"), [cname(day)], "_at")
    sampled = sample_with_replacement(placed, group_sizes(grid, group), group, "_at", largest, seed)
    return sampled.select("draw", *map(cname, df.columns))


def thin_category(
    df: DataFrame, column: str, category: str | Column, share: float, key: str, seed: int = 42,
    blocks: int = HASH_BLOCKS,
) -> DataFrame:
    """Remove ``round(share · n)`` rows of one category, chosen by seeded order."""
    wanted = category if isinstance(category, Column) else F.lit(category)
    order = F.struct(seeded_order(key, seed=seed).alias("h"), cname(key).alias("id"))
    inside = df.filter(cname(column) == wanted)
    cuts = cut_points(
        inside, [], hash_block(seeded_order(key, seed=seed), blocks), order,
        lambda n: [F.round(n * F.lit(share)).cast("bigint")],
    )
    marked = below_cuts(df, [], order, cuts, 1, "_beyond")
    removed = F.coalesce((cname(column) == wanted) & (F.col("_beyond") == 0), F.lit(False))
    return marked.filter(~removed).drop("_beyond")
