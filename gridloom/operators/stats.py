"""Summary statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators import gram
from gridloom.operators.cleaning import numeric_columns
from gridloom.operators.ordered import cname


def group_mean(df: DataFrame, by: str | Column, metric: str, name: str = "mean") -> DataFrame:
    """Mean per group, largest first."""
    column = cname(by) if isinstance(by, str) else by
    return df.groupBy(column).agg(F.avg(cname(metric)).alias(name)).orderBy(F.desc(name))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls): one pass."""
    wide = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), F.count_if(cname(c).isNull()).alias("nulls")).alias(f"_{i}")
            for i, c in enumerate(df.columns)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(df.columns))])))


#: Bins per wanted position and pass, and values at or below which a bin is not cut further but read out.
BINS, FEW = 512, 4096


def quantiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float], bins: int = BINS, few: int = FEW) -> DataFrame:
    """(feature, n, q_0, q_1, …): exact, linearly interpolated quantiles of many columns.

    Selection by counting: every position lies between two bounds; one pass counts the rows of equal bins
    between them, for all columns and positions at once, and the bin that holds the position gives the next
    bounds. When few distinct values are left between the bounds, or none between neighbouring numbers,
    they are counted and read out. Nothing is sorted and no value is moved: what is shuffled are the counts
    of ``bins`` bins per position, and then the counts of at most ``few`` rows' values. A position lost in
    a narrow crowd of very many distinct values takes more passes. Nulls and NaN are not values.
    """
    spark = df.sparkSession
    values = df.select(*[F.nanvl(cname(c).cast("double"), F.lit(None)).alias(f"_{i}") for i, c in enumerate(columns)])
    ends = values.agg(*[F.struct(F.count(f"_{i}"), F.min(f"_{i}"), F.max(f"_{i}")).alias(f"_{i}") for i in range(len(columns))]).first()
    # A wanted place (0-based): its column, the bounds it lies in and the rows below them. All of this is a few numbers.
    open_places, known = {}, {}
    for i in range(len(columns)):
        n, low, high = ends[i]
        for q in fractions:
            at = (n - 1) * float(q)
            for place in {math.floor(at), math.ceil(at)} if n else ():
                open_places[i, place] = (low, high, 0, n)
    while open_places:
        by_span: dict[tuple, list[int]] = {}
        for (i, place), (low, high, below, inside) in open_places.items():
            if low == high:
                known[i, place] = low
            else:
                by_span.setdefault((i, low, high, below, inside), []).append(place)
        spans, cells, open_places = list(by_span), [], {}
        for s, (i, low, high, below, inside) in enumerate(spans):
            value, edges = F.col(f"_{i}"), np.linspace(low, high, bins + 1) if math.isfinite(high - low) else None
            if edges is None:  # infinities, or bounds too far apart for a difference: by sign first
                item = F.when(value.isin(float("-inf"), float("inf")), F.signum(value) * 2).otherwise(F.signum(value))
            elif inside <= few or len(np.unique(edges)) < bins + 1:
                item = value  # the values themselves: few rows, or numbers with hardly another between them
            else:
                width = (high - low) / bins
                item = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("double")
            cells.append(F.when(value.between(F.lit(low), F.lit(high)), F.struct(F.lit(s).alias("span"), item.alias("item"), value.alias("value"))))
        if not spans:
            break
        hits = values.select(F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("x"))
        counted = hits.groupBy("x.span", "x.item").agg(F.count(F.lit(1)).alias("n"), F.min("x.value").alias("low"), F.max("x.value").alias("high"))
        found: dict[int, list] = {}
        for r in counted.orderBy("span", "item").collect():
            found.setdefault(r.span, []).append(r)
        for s, (i, _, _, below, _) in enumerate(spans):
            for place in by_span[spans[s]]:
                before = below
                for r in found[s]:
                    if place < before + r.n:
                        # The bin's own least and greatest value are the next bounds: they shrink in every pass.
                        open_places[i, place] = (r.low, r.high, before, r.n)
                        break
                    before += r.n
    rows = []
    for i, c in enumerate(columns):
        n, blended = ends[i][0], []
        for q in fractions:
            at = (n - 1) * float(q)
            if not n:
                blended.append(None)
                continue
            low, high = known[i, math.floor(at)], known[i, math.ceil(at)]
            blended.append(low if low == high else low + (high - low) * (at - math.floor(at)))
        if n:
            rows.append((c, n, *blended))
    layout = ", ".join(["feature string", "n bigint", *[f"q_{i} double" for i in range(len(fractions))]])
    return spark.createDataFrame(rows, layout)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(cname(c)).alias("count"),
                F.avg(cname(c)).cast("double").alias("mean"),
                F.stddev_samp(cname(c)).alias("std"),
                F.min(cname(c)).cast("double").alias("min"),
                F.max(cname(c)).cast("double").alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    moments = wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "feature", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"), F.col("q_2").alias("p75")
    )
    return moments.join(quartiles, "feature", "left")


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value (first in text order on ties) and its count."""
    texts = df.select(*[cname(c).cast("string").alias(c) for c in columns])
    counted = (
        texts.unpivot([], [cname(c) for c in columns], "feature", "text")
        .filter("text IS NOT NULL")
        .groupBy("feature", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("feature").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("text", F.struct((-F.col("n")).alias("n"), F.col("text"))).alias("top"),
        F.max("n").alias("freq"),
    )


def median_cut(df: DataFrame, column: str) -> Column:
    """The exact median of a column as a scalar."""
    return quantiles(df, [column], [0.5]).select("q_0").scalar()


CORRELATION = "feature_1 string, feature_2 string, correlation double"


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature_1, feature_2, correlation) for every ordered pair, each over the rows where both are known.

    The sums of all pairs come from one array aggregate (see ``gram``), so the plan does not grow with the
    number of pairs; the matrix is one small row. A constant column has null correlations.
    """
    names = list(columns or numeric_columns(df))
    found = gram.correlation_matrix(df, names)
    cells = [
        (a, b, None if np.isnan(found[i, j]) else float(found[i, j]))
        for i, a in enumerate(names) for j, b in enumerate(names) if i != j
    ]
    return df.sparkSession.createDataFrame(cells, CORRELATION)


def strong_pairs(
    df: DataFrame, columns: Sequence[str], target: str, threshold: float = 0.7
) -> DataFrame:
    """Pairs correlated beyond the threshold, and the member that is closer to the target.

    Each pair is named once, the later column first.
    """
    names = list(columns)
    wanted = names if target in names else [*names, target]
    found = gram.correlation_matrix(df, wanted)
    np.fill_diagonal(found, 1.0)
    to_target = found[:, wanted.index(target)]
    cells = []
    for i, a in enumerate(names):
        for j, b in enumerate(names[:i]):
            if abs(found[i, j]) > threshold:  # not for an unknown correlation
                # Rounded, so that two copies of one column tie whatever order the sums were taken in.
                closer = round(abs(to_target[i]), 9) > round(abs(to_target[j]), 9)
                cells.append((a, b, *(None if np.isnan(x) else float(x) for x in (found[i, j], to_target[i], to_target[j])), a if closer else b))
    return df.sparkSession.createDataFrame(cells, f"{CORRELATION}, target_1 double, target_2 double, keep string")


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """mse, mae and r2 in one pass: the total sum of squares comes from the variance."""
    y, e = cname(truth).cast("double"), cname(truth).cast("double") - cname(predicted).cast("double")
    return df.filter(y.isNotNull() & cname(predicted).isNotNull()).agg(
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
        F.count(F.lit(1)).alias("rows"),
    )
