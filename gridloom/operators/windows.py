"""Rolling, lag, fill and tail operators on hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators.ordered import cname, join_on_keys, over_blocks, time_block



def rolling_columns(window: Window, columns: Sequence[str], rows: int, what: str) -> dict[str, Column]:
    """``<column>_rolling_mean`` / ``_std`` over the last ``rows`` rows, null before that many."""
    frame = window.rowsBetween(1 - rows, 0)
    stat = {"mean": F.avg, "std": F.stddev_samp}[what]
    return {
        f"{c}_rolling_{what}": F.when(
            F.count(cname(c)).over(frame) == rows, stat(cname(c)).over(frame)
        )
        for c in columns
    }


def lag_columns(window: Window, columns: Sequence[str], lags: Sequence[int]) -> dict[str, Column]:
    return {f"{c}_lag_{n}": F.lag(cname(c), n).over(window) for n in lags for c in columns}


def rolling(
    df: DataFrame,
    what: str = "mean",
    columns: Sequence[str] = tuple(schemas.ROLLED),
    rows: int = schemas.WINDOW_ROWS,
    keys: Sequence[str] = ("zone",),
    order: str = "datetime",
    unit: str | Column | None = "month",
) -> DataFrame:
    return over_blocks(
        df, keys, order, rows - 1, lambda w: rolling_columns(w, columns, rows, what), unit
    )


def lagged(
    df: DataFrame,
    columns: Sequence[str] = tuple(schemas.ROLLED),
    lags: Sequence[int] = tuple(schemas.LAGS),
    keys: Sequence[str] = ("zone",),
    order: str = "datetime",
    unit: str | Column | None = "month",
) -> DataFrame:
    return over_blocks(df, keys, order, max(lags), lambda w: lag_columns(w, columns, lags), unit)


def engineer_features(
    df: DataFrame,
    keys: Sequence[str] = ("zone",),
    order: str = "datetime",
    rows: int = schemas.WINDOW_ROWS,
    unit: str | Column | None = "month",
) -> DataFrame:
    """Rolling means, rolling deviations and lags in one window pass, then complete rows.

    The first ``max(lag)`` rows of every group fall away.
    """

    def build(window: Window) -> dict[str, Column]:
        return {
            **rolling_columns(window, schemas.ROLLED, rows, "mean"),
            **rolling_columns(window, schemas.ROLLED, rows, "std"),
            **lag_columns(window, schemas.ROLLED, schemas.LAGS),
        }

    reach = max(rows - 1, *schemas.LAGS)
    return over_blocks(df, keys, order, reach, build, unit).na.drop("any")


def cyclic_month(df: DataFrame, column: str = "datetime") -> DataFrame:
    """Month of the year as a point on the circle, 6 decimals."""
    angle = F.month(cname(column)) * F.lit(2) * F.pi() / F.lit(12)
    return df.withColumns(
        {"month_sin": F.round(F.sin(angle), 6), "month_cos": F.round(F.cos(angle), 6)}
    )


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("zone",),
    order: str = "datetime",
    forward: bool = True,
    backward: bool = True,
    unit: str = "month",
) -> DataFrame:
    """Forward fill, then backward fill, inside each group.

    The last (first) value known in each block travels over a table with one row per block;
    inside a block the fill is an ordinary window.
    """
    # Both directions run from the frame's start: a frame that ends at "unbounded following"
    # would be evaluated again for every row.
    block = Window.partitionBy(*map(cname, keys), F.col("_block"))
    upto = (Window.unboundedPreceding, Window.currentRow)
    back = block.orderBy(cname(order)).rowsBetween(*upto)
    ahead = block.orderBy(cname(order).desc()).rowsBetween(*upto)
    blocked = df.withColumn("_block", time_block(order, unit))

    known = blocked.groupBy(*map(cname, keys), F.col("_block")).agg(
        *[F.max_by(cname(c), F.when(cname(c).isNotNull(), cname(order))).alias(f"_last_{c}")
          for c in columns],
        *[F.min_by(cname(c), F.when(cname(c).isNotNull(), cname(order))).alias(f"_first_{c}")
          for c in columns],
    )
    series = Window.partitionBy(*map(cname, keys)).orderBy("_block")
    earlier = series.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*map(cname, keys)).orderBy(F.desc("_block")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = known.select(
        *map(cname, keys),
        "_block",
        *[F.last(cname(f"_last_{c}"), ignorenulls=True).over(earlier).alias(f"_from_{c}")
          for c in columns],
        *[F.last(cname(f"_first_{c}"), ignorenulls=True).over(later).alias(f"_to_{c}")
          for c in columns],
    )
    joined = join_on_keys(blocked, carried, [*keys, "_block"], "inner")
    filled = {}
    for c in columns:
        steps = [cname(c)]
        if forward:
            steps += [F.last(cname(c), ignorenulls=True).over(back), cname(f"_from_{c}")]
        if backward:
            steps += [F.last(cname(c), ignorenulls=True).over(ahead), cname(f"_to_{c}")]
        filled[c] = F.coalesce(*steps).alias(c)
    return joined.select(*[filled.get(c, cname(c)) for c in df.columns])


def impute_rolling_mean(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: str,
    rows: int = 3,
    unit: str | None = "year",
) -> DataFrame:
    """Missing values become the mean of the known values among the last ``rows`` rows."""

    def build(window: Window) -> dict[str, Column]:
        frame = window.rowsBetween(1 - rows, 0)
        return {f"{c}_near": F.avg(cname(c)).over(frame) for c in columns}

    near = over_blocks(df, keys, order, rows - 1, build, unit)
    return near.select(
        *[
            F.coalesce(cname(c).cast("double"), cname(f"{c}_near")).alias(c)
            if c in columns
            else cname(c)
            for c in df.columns
        ]
    )


def last_rows(
    df: DataFrame,
    count: int = schemas.WINDOW_ROWS + 1,
    keys: Sequence[str] = ("zone",),
    order: Sequence[str] = ("datetime",),
    oldest: bool = False,
) -> DataFrame:
    """The newest (or oldest) ``count`` rows of each group.

    Spark keeps at most ``count`` rows per group and task before the shuffle, so a large group
    never travels whole.
    """
    columns = [cname(c).asc() if oldest else cname(c).desc() for c in order]
    ranked = Window.partitionBy(*map(cname, keys)).orderBy(*columns)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(
        F.col("_rank") <= count
    ).drop("_rank")
