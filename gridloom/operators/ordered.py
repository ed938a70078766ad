"""Order-dependent building blocks that never need a whole group in one task.

A window over ``partitionBy(zone)`` puts one zone into one task, and one zone may hold a
third of all rows. The helpers here cut a group into ordered blocks, work inside the blocks
in parallel, and carry only a few rows (or one sum) per block across the borders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import checkpointed

HASH_RANGE = 1 << 60
HASH_BLOCKS = 16384
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def cname(name: str) -> Column:
    """A column by its literal name (names may hold dots or dashes)."""
    return F.col(f"`{name}`")


def seeded_order(*keys: str | Column, seed: int = 42) -> Column:
    """Hash of integer or text keys in [0, 2^60): the first 15 hex digits of an MD5, so any SQL engine
    finds the same number."""
    columns = [cname(k) if isinstance(k, str) else k for k in keys]
    joined = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def whole_parts(number: Column, size: int) -> Column:
    """How often ``size`` goes into a whole number, in integers."""
    return F.call_function("div", number, F.lit(size).cast("bigint"))


def hash_block(order: Column, blocks: int = HASH_BLOCKS) -> Column:
    """Ordered block of a seeded order; blocks are even because the hash is."""
    return whole_parts(order, HASH_RANGE // blocks)


def time_block(column: str, unit: str) -> Column:
    """Start of the calendar block a timestamp falls in; monotone in the timestamp."""
    if unit == "hour":
        return F.date_trunc("hour", cname(column))
    if unit == "day":
        return F.to_date(cname(column))
    return F.trunc(cname(column), unit)


def join_on_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Equi-join keeping the left key columns; ``null_safe`` lets null keys match.

    Series keys are never null and use the plain form, whose partitioning the window after
    it can reuse.
    """
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_right_{key}")
    matched = [cname(k).eqNullSafe(cname(f"_right_{k}")) for k in keys]
    joined = left.join(renamed, matched, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"_right_{k}" for k in keys])


#: A side of a join up to this size, measured on its rows, is sent to every task.
SENT_BYTES = 64 << 20
#: A larger one is repeated so often, and the other side dealt to so many parts per key.
SALTS = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as text, and 16 bytes per cell: one pass over a small table."""
    size = F.octet_length(F.to_json(F.struct(*map(cname, df.columns)))) + F.lit(16 * len(df.columns))
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]


def attach(
    df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", null_safe: bool = False,
    limit: int = SENT_BYTES,
) -> DataFrame:
    """Join a table with one row per group to a table that may be huge, without moving the huge one.

    ``small`` is made once, cut off from its lineage and measured. Up to ``limit`` bytes it is broadcast. A
    larger one is joined on (keys, salt): its rows are repeated ``SALTS`` times and the rows of a group are
    dealt evenly to them, so one group of very many rows is spread. ``how`` is any join that keeps
    rows of ``df`` only: inner, left, left_semi or left_anti; ``null_safe`` lets null keys match.
    """
    stored = checkpointed(small)
    if measured_bytes(stored) <= limit:
        return join_on_keys(df, F.broadcast(stored), keys, how, null_safe)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*map(cname, df.columns)), F.lit(SALTS)).cast("int"))
    repeated = stored.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return join_on_keys(salted, repeated, [*keys, "_salt"], how, null_safe).drop("_salt")


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    reach: int,
    columns: Callable[[Window], dict[str, Column]],
    unit: str | Column | None = "month",
) -> DataFrame:
    """Add window columns that look back at most ``reach`` rows inside each group.

    Rows are windowed inside (group, calendar block). Only the first ``reach`` rows of a block
    can see into an earlier block, so they are computed again from a second, small table that
    holds the first and last ``reach`` rows of every block. The result equals a window over
    the whole group. (group, ``order``) must be a key; then a block of an hourly series has at
    most 744 rows per month however many rows the group has. ``unit`` may also be an expression that
    grows with ``order``; ``unit=None`` is the plain window.
    """
    if unit is None:
        return df.withColumns(columns(Window.partitionBy(*map(cname, keys)).orderBy(cname(order))))
    block = Window.partitionBy(*map(cname, keys), F.col("_block")).orderBy(cname(order))
    whole = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    names = df.columns
    placed = (
        df.withColumn("_block", time_block(order, unit) if isinstance(unit, str) else unit)
        .withColumns(
            {
                "_place": F.row_number().over(block),
                "_size": F.count(F.lit(1)).over(whole),
                **columns(block),
            }
        )
    )
    added = [c for c in placed.columns if c not in names and not c.startswith("_")]
    inner = placed.filter(F.col("_place") > reach)
    borders = placed.filter(
        (F.col("_place") <= reach) | (F.col("_size") - F.col("_place") < reach)
    ).drop(*added)
    across = Window.partitionBy(*map(cname, keys)).orderBy(cname(order))
    opening = borders.withColumns(columns(across)).filter(F.col("_place") <= reach)
    kept = [cname(c) for c in [*names, *added]]
    return inner.select(*kept).unionByName(opening.select(*kept))


def running_totals(
    df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str]
) -> DataFrame:
    """Exact inclusive running sums per group, plus the next order value.

    ``df`` has one row per (group, order value). Rows are range-partitioned on (group, order),
    so even one huge group is spread; slice totals (one row per slice and group) carry the sums
    across slices. The sliced rows are checkpointed because the slice number must stay the
    same for both branches that read it.
    """
    sliced = checkpointed(
        df.repartitionByRange(*map(cname, keys), cname(order)).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    ahead = Window.partitionBy(*map(cname, keys)).orderBy("_slice")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*map(cname, keys), F.col("_slice")).agg(
        F.min(cname(order)).alias("_first"), *[F.sum(cname(s)).alias(f"_sum_{s}") for s in sums]
    )
    carried = totals.select(
        *map(cname, keys),
        "_slice",
        F.lead("_first").over(ahead).alias("_first_of_next"),
        *[F.coalesce(F.sum(cname(f"_sum_{s}")).over(before), F.lit(0)).alias(f"_before_{s}")
          for s in sums],
    )
    inside = Window.partitionBy(*map(cname, keys), F.col("_slice")).orderBy(cname(order))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = join_on_keys(sliced, carried, [*keys, "_slice"], "inner")
    return joined.select(
        *map(cname, df.columns),
        *[(F.sum(cname(s)).over(upto) + cname(f"_before_{s}")).alias(f"running_{s}")
          for s in sums],
        F.coalesce(F.lead(cname(order)).over(inside), F.col("_first_of_next")).alias(
            f"next_{order}"
        ),
    )


def global_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """1-based position of every row in one total order, without a one-task window.

    ``order`` must identify rows. One range shuffle sorts the table; the row id that Spark
    hands out per partition gives the place inside it, and the sizes of the partitions before
    (one row per partition, hence broadcast) give the offset.
    """
    columns = [cname(c) for c in order]
    sorted_rows = checkpointed(
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_row", _ROW_BITS))
    sizes = sorted_rows.groupBy("_slice").count()
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    in_slice = F.col("_row") - F.shiftleft(F.col("_slice"), _ROW_BITS)
    return (
        sorted_rows.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_offset") + in_slice + F.lit(1))
        .drop("_slice", "_offset", "_row")
    )


def block_positions(
    df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[Column], name: str
) -> DataFrame:
    """1-based position inside each group, in an order that ``block`` is monotone in.

    Each (group, block) is numbered by itself; block sizes carry the offset. Use it when an
    even block exists (a seeded hash, the month of an hourly series).
    """
    blocked = df.withColumn("_block", block)
    sizes = blocked.groupBy(*map(cname, keys), F.col("_block")).count()
    earlier = (
        Window.partitionBy(*map(cname, keys))
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *map(cname, keys), "_block", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*map(cname, keys), F.col("_block")).orderBy(*order)
    return (
        join_on_keys(blocked, offsets, [*keys, "_block"], "inner", null_safe=True)
        .withColumn(name, F.col("_offset") + F.row_number().over(inside))
        .drop("_block", "_offset")
    )


def cut_points(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Column,
    positions: Callable[[Column], Sequence[Column]],
) -> DataFrame:
    """Per group, the order value found at each wanted position: columns ``cut_0``, ``cut_1``…

    ``positions`` turns the group size into 1-based positions (0 gives a null cut). Sizes per
    block locate the one block that holds each position, and only rows of those blocks are
    sorted; all other rows are merely counted.
    """
    # Keys and order values alone are kept, so the wide rows are read once here.
    slim = checkpointed(df.select(*map(cname, keys), block.alias("_block"), order.alias("_order")))
    sizes = slim.groupBy(*map(cname, keys), F.col("_block")).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*map(cname, keys))
    upto = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = sizes.select(
        *map(cname, keys),
        "_block",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
        F.sum("_n").over(upto).alias("_upto"),
        F.sum("_n").over(group).alias("_total"),
    )
    wanted = [p.cast("bigint") for p in positions(F.col("_total"))]
    spans = spans.withColumn("_wanted", F.array(*wanted)).withColumn(
        "_wanted",
        F.filter("_wanted", lambda p: (p > F.col("_before")) & (p <= F.col("_upto"))),
    )
    holding = spans.filter(F.size("_wanted") > 0).drop("_upto")
    inside = Window.partitionBy(*map(cname, keys), F.col("_block")).orderBy("_order")
    found = (
        attach(slim, holding, [*keys, "_block"], "inner", null_safe=True)
        .withColumn("_at", F.col("_before") + F.row_number().over(inside))
        .filter(F.array_contains("_wanted", F.col("_at")))
    )
    again = positions(F.col("_total"))
    return found.groupBy(*map(cname, keys)).agg(
        *[
            F.max(F.when(F.col("_at") == p.cast("bigint"), F.col("_order"))).alias(f"cut_{i}")
            for i, p in enumerate(again)
        ]
    )


def below_cuts(
    df: DataFrame, keys: Sequence[str], order: Column, cuts: DataFrame, count: int, name: str
) -> DataFrame:
    """Add how many cuts of its group each row lies beyond (0 = at or before the first)."""
    marked = df.withColumn("_order", order)
    if keys:
        joined = attach(marked, cuts, keys, "left", null_safe=True)
        limits = [F.col(f"cut_{i}") for i in range(count)]
    else:
        one = cuts.select(F.struct("*")).scalar()
        joined = marked
        limits = [one[f"cut_{i}"] for i in range(count)]
    beyond = sum(
        (F.coalesce(F.col("_order") > limit, F.lit(True)).cast("int") for limit in limits),
        F.lit(0),
    )
    return joined.withColumn(name, beyond).drop("_order", *[f"cut_{i}" for i in range(count)])


def expand_rows(df: DataFrame, times: Column, name: str, per_block: int = 1000) -> DataFrame:
    """Repeat each row ``times`` times, numbered 0…times-1.

    A row becomes runs of ``per_block`` squared copies, the runs are cut into blocks of ``per_block``, the blocks
    are dealt out by a shuffle on (row, block) and unrolled there. So one row with a huge count is spread over
    the cluster, and no array is longer than ``per_block`` numbers, or the number of runs. The partition
    number is given, because adaptive execution would merge the few small rows that stand for many.
    """
    setting = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = int(setting) if setting.isdigit() else 200
    run = per_block * per_block

    def numbers(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(first, last))

    blocks = (
        df.withColumn("_times", times.cast("bigint"))
        .filter(F.col("_times") > 0)
        .withColumn("_run", numbers(F.lit(0).cast("bigint"), whole_parts(F.col("_times") - 1, run)))
        .withColumn("_part", numbers(
            F.col("_run") * per_block,
            F.least(F.col("_run") * per_block + (per_block - 1), whole_parts(F.col("_times") - 1, per_block))))
        .drop("_run")
        .repartition(spread, *map(cname, df.columns), F.col("_part"))
    )
    first = F.col("_part") * per_block
    last = F.least(first + (per_block - 1), F.col("_times") - 1)
    return blocks.withColumn(name, numbers(first, last)).drop("_times", "_part")
