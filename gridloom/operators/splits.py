"""Train / validation / test splits and folds.

Each split only needs the order value at a few positions per group. Those are found from counts
(``cut_points``); the rows themselves are compared with the cuts and never sorted or moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordered import (
    HASH_BLOCKS,
    HASH_RANGE,
    below_cuts,
    block_positions,
    cname,
    cut_points,
    global_position,
    hash_block,
    seeded_order,
    time_block,
    whole_parts,
)


def _share(total: Column, share: float) -> Column:
    """floor(total × share) in integers; the share is the nearest fraction with a denominator of a
    million at most, so 1/3 and 0.0004 are exact."""
    part = Fraction(share).limit_denominator(1_000_000)
    return whole_parts(total.cast("bigint") * F.lit(part.numerator), part.denominator)


def _hash_order(key: str, seed: int) -> Column:
    return F.struct(seeded_order(key, seed=seed).alias("h"), cname(key).alias("id"))


def chronological_split(
    df: DataFrame, keys: Sequence[str] = ("zone",), order: str = "datetime",
    train: float = 0.8, unit: str = "month",
) -> DataFrame:
    """First ``floor(n · train)`` rows of each group in time order are ``train``, rest ``test``."""
    cuts = cut_points(
        df, keys, time_block(order, unit), cname(order), lambda n: [_share(n, train)]
    )
    split = below_cuts(df, keys, cname(order), cuts, 1, "_beyond")
    return split.withColumn(
        "split", F.when(F.col("_beyond") == 0, "train").otherwise("test")
    ).drop("_beyond")


def stratified_split(
    df: DataFrame, strata: Sequence[str], key: str,
    test: float = 0.2, validation: float = 0.1, seed: int = 42,
    blocks: int = HASH_BLOCKS,
) -> DataFrame:
    """Test and validation shares of every stratum, chosen by seeded order of an integer key.

    Sizes are floored per stratum; a whole-table allocation may differ by one row per stratum.
    """
    block = hash_block(seeded_order(key, seed=seed), blocks)
    cuts = cut_points(
        df, strata, block, _hash_order(key, seed),
        lambda n: [_share(n, test), _share(n, test) + _share(n, validation)],
    )
    split = below_cuts(df, strata, _hash_order(key, seed), cuts, 2, "_beyond")
    named = (
        F.when(F.col("_beyond") == 0, "test")
        .when(F.col("_beyond") == 1, "validation")
        .otherwise("train")
    )
    return split.withColumn("split", named).drop("_beyond")


def random_split(df: DataFrame, key: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Test share of the whole table by seeded order."""
    return stratified_split(df, [], key, test, 0.0, seed)


def contiguous_folds(
    df: DataFrame, folds: int, order: Sequence[str], name: str = "fold"
) -> DataFrame:
    """Fold 0…k-1 as contiguous blocks of the order; the first n mod k folds have one row more.

    Only the order columns are range-sorted; the k-1 rows that end a fold become one struct that
    all rows are compared with.
    """
    by = F.struct(*map(cname, order))
    placed = global_position(df.select(*map(cname, order)), order, "_at")
    total = placed.agg(F.max("_at")).scalar()
    base, extra = F.floor(total / folds), total % folds
    ends = [base * (i + 1) + F.least(extra, F.lit(i + 1)) for i in range(folds - 1)]
    cuts = placed.agg(
        *[F.max(F.when(F.col("_at") == end, by)).alias(f"cut_{i}") for i, end in enumerate(ends)]
    )
    return below_cuts(df, [], by, cuts, folds - 1, name)


def hash_folds(df: DataFrame, folds: int, key: str, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold by seeded hash: no order, no shuffle."""
    return df.withColumn(name, whole_parts(seeded_order(key, seed=seed), HASH_RANGE // folds + 1).cast("int"))


def seeded_positions(
    df: DataFrame, keys: Sequence[str], key: str, seed: int = 42, name: str = "position",
    blocks: int = HASH_BLOCKS,
) -> DataFrame:
    """1-based place of every row in the seeded order of its group.

    A task sorts one of ``blocks`` hash blocks of a group: raise it with the rows per group.
    """
    order = seeded_order(key, seed=seed)
    return block_positions(df, keys, hash_block(order, blocks), [order, cname(key)], name)
