"""Min-max scaling, its inverse, and label codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators.cleaning import numeric_columns
from gridloom.operators.ordered import attach, cname, global_position



def min_max_map(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long table (column, min, max): one aggregation, one row per column."""
    columns = list(columns or numeric_columns(df, schemas.NOT_SCALED))
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.min(cname(c)).cast("double").alias("min"),
                F.max(cname(c)).cast("double").alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(
        F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))]))
    )


#: Bounds that differ by a smaller share of the larger one differ by rounding only.
NO_SPREAD = 1e-12


def unit_interval(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); null for a constant column, also one that rounding makes uneven."""
    spread = F.abs(high - low) > NO_SPREAD * F.greatest(F.abs(low), F.abs(high))
    return F.when(spread, F.try_divide(value.cast("double") - low, high - low))


def shift_cyclic(df: DataFrame) -> DataFrame:
    """Month sine and cosine from [-1, 1] to [0, 1]."""
    return df.withColumns(
        {c: (cname(c) + 1) / 2 for c in ("month_sin", "month_cos") if c in df.columns}
    )


def scale_min_max(
    df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Scale numeric columns to [0, 1] over each group, or over the table if no key is given.

    Bounds come from an aggregation (partial sums first) that is measured and sent to the rows, so a
    group is never sorted, gathered or moved.
    """
    columns = list(columns or numeric_columns(df, schemas.NOT_SCALED))
    extremes = [
        f(cname(c)).cast("double").alias(f"_{n}_{c}")
        for c in columns
        for n, f in (("min", F.min), ("max", F.max))
    ]
    if keys:
        bounds = df.groupBy(*map(cname, keys)).agg(*extremes)
        joined = attach(df, bounds, keys, "left", null_safe=True)
        low = {c: cname(f"_min_{c}") for c in columns}
        high = {c: cname(f"_max_{c}") for c in columns}
    else:
        one = df.agg(F.struct(*extremes)).scalar()
        joined = df
        low = {c: one[f"_min_{c}"] for c in columns}
        high = {c: one[f"_max_{c}"] for c in columns}
    scaled = [
        unit_interval(cname(c), low[c], high[c]).alias(c) if c in columns else cname(c)
        for c in df.columns
    ]
    return joined.select(*scaled).transform(shift_cyclic)


def scale_with_map(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Scale with stored bounds; a numeric column without stored bounds is an error."""
    columns = numeric_columns(df, schemas.NOT_SCALED)
    missing = [c for c in columns if c not in bounds]
    if missing:
        raise KeyError(f"no stored bounds for {missing}")
    return df.withColumns(
        {
            c: unit_interval(cname(c), F.lit(float(bounds[c][0])), F.lit(float(bounds[c][1])))
            for c in columns
        }
    ).transform(shift_cyclic)


def scale_with_table(df: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``scale_with_map`` with the (column, min, max) table as a scalar lookup."""
    stored = bounds.agg(
        F.map_from_entries(
            F.collect_list(F.struct(cname("column"), F.struct(cname("min"), cname("max"))))
        )
    ).scalar()
    return df.withColumns(
        {c: unit_interval(cname(c), stored[c]["min"], stored[c]["max"]) for c in columns}
    )


def descale(value: Column, low: Column | float, high: Column | float, swapped: bool = False) -> Column:
    """Inverse of min-max. ``swapped`` exchanges the bounds: high - value * (high - low)."""
    low = F.lit(float(low)) if isinstance(low, (int, float)) else low
    high = F.lit(float(high)) if isinstance(high, (int, float)) else high
    if swapped:
        return value * (low - high) + high
    return value * (high - low) + low


def label_dictionary(df: DataFrame, column: str, code: str | None = None) -> DataFrame:
    """(value, code) with codes 0… in text order of the distinct values.

    A range sort numbers the distinct values, however many there are.
    """
    code = code or f"{column}_code"
    values = df.select(cname(column)).filter(cname(column).isNotNull()).distinct()
    return global_position(values, [column], "_at").select(
        cname(column), (F.col("_at") - 1).alias(code)
    )


def encode_labels(
    df: DataFrame, column: str, dictionary: DataFrame, code: str | None = None, unseen: str = "error"
) -> DataFrame:
    """Add the code of a label. Unseen labels raise (``error``) or get -1 (``mark``)."""
    code = code or f"{column}_code"
    joined = attach(df, dictionary.withColumnRenamed(f"{column}_code", code), [column], "left", null_safe=True)
    if unseen == "error":
        told = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(cname(column).cast("string"), F.lit("null"))))
        return joined.withColumn(
            code,
            F.when(cname(code).isNotNull(), cname(code)).otherwise(told.cast("bigint")),
        )
    return joined.withColumn(code, F.coalesce(cname(code), F.lit(-1).cast("bigint")))


def decode_labels(df: DataFrame, column: str, dictionary: DataFrame, code: str | None = None) -> DataFrame:
    """Label text for a code."""
    code = code or f"{column}_code"
    return attach(df, dictionary.withColumnRenamed(f"{column}_code", code), [code], "left", null_safe=True)
