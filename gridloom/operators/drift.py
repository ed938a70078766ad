"""Two-sample drift: Kolmogorov-Smirnov, PSI, Wasserstein, Jensen-Shannon, chi-square.

All numeric columns go through one job: the two samples are turned long once, to
(feature, value, side). ``side`` 0 is the baseline, 1 the new sample. Every long table is first
reduced to counts per distinct value or bin, which Spark combines before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.cleaning import numeric_columns
from gridloom.operators.ordered import cname, running_totals

KS_TERMS = 100
PSI_EPSILON = 1e-10


def split_at_time(df: DataFrame, order: str = "datetime", start: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Baseline rows before ``start`` and new rows from it on; default start = last time."""
    if start is None:
        start = df.agg(F.max(cname(order))).scalar()
    return df.filter(cname(order) < start), df.filter(cname(order) >= start)


def common_columns(baseline: DataFrame, new: DataFrame, wanted: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """Numeric columns present on both sides, and the wanted ones that are not."""
    both = [c for c in numeric_columns(baseline) if c in numeric_columns(new)]
    if wanted is None:
        return both, []
    return [c for c in wanted if c in both], [c for c in wanted if c not in both]


def long_samples(baseline: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, side) without nulls."""

    def one_side(df: DataFrame, side: int) -> DataFrame:
        values = df.select(*[cname(c).cast("double").alias(c) for c in columns])
        return (
            values.unpivot([], [cname(c) for c in columns], "feature", "value")
            .filter("value IS NOT NULL")
            .withColumn("side", F.lit(side))
        )

    return one_side(baseline, 0).unionByName(one_side(new, 1))


def side_of(order: str, start: Column) -> Column:
    """0 before ``start``, 1 from it on, null without a time: the two samples as a column of one table."""
    return F.when(cname(order) < start, 0).when(cname(order) >= start, 1)


def long_rows(df: DataFrame, side: Column, columns: Sequence[str]) -> DataFrame:
    """(feature, value, side) without nulls, of two samples that lie in one table: one scan."""
    values = df.select(side.alias("side"), *[cname(c).cast("double").alias(c) for c in columns]).filter("side IS NOT NULL")
    long = values.unpivot(["side"], [cname(c) for c in columns], "feature", "value")
    return long.filter("value IS NOT NULL").select("feature", "value", "side")


def counts_by_side(df: DataFrame, side: Column, columns: Sequence[str]) -> DataFrame:
    """``sample_counts`` of two samples that lie in one table."""
    return _counted(long_rows(df, side, columns))


def sample_counts(baseline: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n_baseline, n_new): all the numeric tests below start from these counts."""
    return _counted(long_samples(baseline, new, columns))


def _counted(long: DataFrame) -> DataFrame:
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("n_baseline"),
        F.count_if(F.col("side") == 1).alias("n_new"),
    )


def cumulative_shares(counts: DataFrame) -> DataFrame:
    """Both empirical distribution functions at every distinct value of every feature."""
    running = running_totals(counts, ["feature"], "value", ["n_baseline", "n_new"])
    weighted = F.col("value") * F.col("n_baseline")
    sizes = running.groupBy("feature").agg(
        F.sum("n_baseline").alias("size_baseline"),
        F.sum("n_new").alias("size_new"),
        F.try_divide(F.sum(weighted), F.sum("n_baseline")).alias("mean_baseline"),
    )
    # One row per numeric column of the input table.
    return running.join(F.broadcast(sizes), "feature").withColumns(
        {
            "share_baseline": F.try_divide(F.col("running_n_baseline"), F.col("size_baseline")),
            "share_new": F.try_divide(F.col("running_n_new"), F.col("size_new")),
        }
    )


def distances(counts: DataFrame) -> DataFrame:
    """Per feature, from one pass over the shares: the largest gap between the distribution
    functions, the area between them, the sample sizes and the baseline's deviation."""
    shares = cumulative_shares(counts)
    gap = F.abs(F.col("share_baseline") - F.col("share_new"))
    width = F.col("next_value") - F.col("value")
    off_mean = F.col("value") - F.col("mean_baseline")
    return shares.groupBy("feature").agg(
        F.max(gap).alias("gap"),
        F.sum(gap * width).alias("area"),
        F.max("size_baseline").alias("size_baseline"),
        F.max("size_new").alias("size_new"),
        F.sqrt(
            F.try_divide(F.sum(off_mean * off_mean * F.col("n_baseline")), F.max("size_baseline"))
        ).alias("spread"),
    )


def kolmogorov_p(statistic: Column, size_a: Column, size_b: Column) -> Column:
    """Asymptotic two-sided p-value; exact small-sample tables would differ a little."""
    scaled = statistic * F.sqrt(size_a * size_b / (size_a + size_b))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda total, j: total
        + F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * j * j * scaled * scaled),
    )
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    # The series converges too slowly below 0.2, where p is 1 to 12 decimals.
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(bounded)


def ks_from(found: DataFrame, threshold: float = 0.05) -> DataFrame:
    """``ks_test`` from the distances."""
    p_value = kolmogorov_p(
        F.col("gap"), F.col("size_baseline").cast("double"), F.col("size_new").cast("double")
    )
    return found.select(
        "feature", F.col("gap").alias("statistic"), "size_baseline", "size_new",
        p_value.alias("p_value"),
    ).withColumn("drift", F.col("p_value") < threshold)


def wasserstein_from(found: DataFrame, floor: float = 0.001) -> DataFrame:
    """``wasserstein`` from the distances."""
    return found.select(
        "feature",
        F.col("area").alias("distance"),
        (F.col("area") / F.greatest(F.col("spread"), F.lit(floor))).alias("normalised"),
    )


def ks_test(counts: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Per feature: Kolmogorov-Smirnov statistic, p_value and drift = p below the threshold."""
    return ks_from(distances(counts), threshold)


def wasserstein(counts: DataFrame, floor: float = 0.001) -> DataFrame:
    """Area between the two distribution functions, also over the baseline's deviation."""
    return wasserstein_from(distances(counts), floor)


def histogram(counts: DataFrame, bins: int = 10, edges: str = "own") -> DataFrame:
    """(feature, side, bin, n): equal-width bins, last bin closed.

    ``edges='own'`` bins each side between its own extremes (so a pure shift is invisible);
    ``edges='baseline'`` bins both sides between the baseline's, outer values in the end bins.
    A constant column is widened by 0.5 on both sides, which puts all rows in the middle bin.
    """
    sides = F.array(
        *[
            F.struct(F.lit(side).alias("side"), F.col(name).alias("n"))
            for side, name in ((0, "n_baseline"), (1, "n_new"))
        ]
    )
    long = counts.select("feature", "value", F.inline(sides)).filter("n > 0")
    by = ["feature", "side"] if edges == "own" else ["feature"]
    source = long if edges == "own" else long.filter("side = 0")
    # One row per numeric column and side.
    limits = source.groupBy(*by).agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    flat = F.col("_low") == F.col("_high")
    limits = limits.select(
        *by,
        F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"),
        F.when(flat, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("_high"),
    )
    position = F.floor((F.col("value") - F.col("_low")) * bins / (F.col("_high") - F.col("_low")))
    place = F.least(F.lit(bins - 1), F.greatest(F.lit(0), position)).cast("int")
    return (
        long.join(F.broadcast(limits), by)
        .groupBy("feature", "side", place.alias("bin"))
        .agg(F.sum("n").alias("n"))
    )


def binned(df: DataFrame, side: Column, columns: Sequence[str], bins: int = 10, edges: str = "own") -> DataFrame:
    """``histogram`` of two samples that lie in one table, in two aggregations.

    The first finds the extremes of all columns in one row, the second counts (column, side, bin), with the bin by
    arithmetic: no distinct value is shuffled, whatever the number of rows.
    """
    ready = df.select(side.alias("side"), *[cname(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    ready = ready.filter("side IS NOT NULL")
    part = {s: F.col("side") == s for s in (0, 1)}
    ends = ready.agg(*[
        f(F.when(part[s], F.col(f"_{i}"))).alias(f"{n}_{i}_{s}")
        for i in range(len(columns)) for s in (0, 1) for n, f in (("low", F.min), ("high", F.max))
    ]).first()  # four numbers per column

    def place(i: int, s: int) -> Column:
        low, high = (ends[f"{n}_{i}_{s if edges == 'own' else 0}"] for n in ("low", "high"))
        if low is None:
            return F.lit(None).cast("int")
        low, high = (low - 0.5, high + 0.5) if low == high else (low, high)
        position = F.floor((F.col(f"_{i}") - F.lit(low)) * bins / (F.lit(high) - F.lit(low)))
        return F.least(F.lit(bins - 1), F.greatest(F.lit(0), position)).cast("int")

    cells = [
        F.struct(F.lit(c).alias("feature"), F.when(F.col(f"_{i}").isNotNull(), F.when(part[0], place(i, 0)).otherwise(place(i, 1))).alias("bin"))
        for i, c in enumerate(columns)
    ]
    long = ready.select("side", F.inline(F.array(*cells))).filter("bin IS NOT NULL")
    return long.groupBy("feature", "side", "bin").agg(F.count(F.lit(1)).alias("n"))


def psi(
    counts: DataFrame,
    bins: int = 10,
    threshold: float = 0.2,
    epsilon: float = PSI_EPSILON,
    edges: str = "own",
) -> DataFrame:
    """Population stability index per feature; features empty on one side are left out."""
    return psi_from(histogram(counts, bins, edges), bins, threshold, epsilon)


def psi_by_side(
    df: DataFrame, side: Column, columns: Sequence[str], bins: int = 10, threshold: float = 0.2,
    epsilon: float = PSI_EPSILON, edges: str = "own",
) -> DataFrame:
    """``psi`` of two samples that lie in one table, from two aggregations (see ``binned``)."""
    return psi_from(binned(df, side, columns, bins, edges), bins, threshold, epsilon)


def psi_from(
    counted: DataFrame, bins: int = 10, threshold: float = 0.2, epsilon: float = PSI_EPSILON
) -> DataFrame:
    """``psi`` from counts per (feature, side, bin)."""
    # At most features × 2 × bins rows from here on.
    wide = counted.groupBy("feature").agg(
        *[
            F.sum(F.when((F.col("side") == s) & (F.col("bin") == b), F.col("n")).otherwise(0)).alias(
                f"_{s}_{b}"
            )
            for s in (0, 1)
            for b in range(bins)
        ]
    )
    sizes = [sum((F.col(f"_{s}_{b}") for b in range(bins)), F.lit(0)) for s in (0, 1)]
    terms = []
    for b in range(bins):
        share = [F.try_divide(F.col(f"_{s}_{b}"), sizes[s]) + epsilon for s in (0, 1)]
        terms.append((share[0] - share[1]) * F.ln(share[0] / share[1]))
    return (
        wide.filter((sizes[0] > 0) & (sizes[1] > 0))
        .select("feature", sum(terms, F.lit(0.0)).alias("psi"))
        .withColumn("drift", F.col("psi") > threshold)
    )


def category_counts(baseline: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, n_baseline, n_new) of text columns."""

    def one_side(df: DataFrame, side: int) -> DataFrame:
        texts = df.select(*[cname(c).cast("string").alias(c) for c in columns])
        return (
            texts.unpivot([], [cname(c) for c in columns], "feature", "category")
            .filter("category IS NOT NULL")
            .withColumn("side", F.lit(side))
        )

    return (
        one_side(baseline, 0)
        .unionByName(one_side(new, 1))
        .groupBy("feature", "category")
        .agg(
            F.count_if(F.col("side") == 0).alias("n_baseline"),
            F.count_if(F.col("side") == 1).alias("n_new"),
        )
    )


def category_counts_by_side(df: DataFrame, side: Column, columns: Sequence[str]) -> DataFrame:
    """``category_counts`` of two samples that lie in one table."""
    texts = df.select(side.alias("side"), *[cname(c).cast("string").alias(c) for c in columns]).filter("side IS NOT NULL")
    long = texts.unpivot(["side"], [cname(c) for c in columns], "feature", "category").filter("category IS NOT NULL")
    return long.groupBy("feature", "category").agg(
        F.count_if(F.col("side") == 0).alias("n_baseline"), F.count_if(F.col("side") == 1).alias("n_new")
    )


def chi2_tail(statistic: float, freedom: int) -> float:
    """Upper tail of the chi-square distribution for whole degrees of freedom."""
    if freedom < 1 or statistic <= 0:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    half = statistic / 2
    shape, tail = (0.5, math.erfc(math.sqrt(half))) if freedom % 2 else (1.0, math.exp(-half))
    while shape < freedom / 2 - 1e-9:
        tail += math.exp(shape * math.log(half) - half - math.lgamma(shape + 1))
        shape += 1
    return min(1.0, tail)


@F.pandas_udf(T.DoubleType())
def chi2_tail_column(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """``chi2_tail`` over one row per feature."""
    return pd.Series([chi2_tail(s, int(f)) for s, f in zip(statistic, freedom)])


def category_drift(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon distance and goodness-of-fit chi-square per text column.

    The chi-square compares new counts with baseline shares; a category new to the baseline
    makes it infinite. Category sums are combined before the shuffle on the feature.
    """
    sizes = counts.groupBy("feature").agg(
        F.sum("n_baseline").alias("size_baseline"), F.sum("n_new").alias("size_new")
    )
    joined = counts.join(F.broadcast(sizes), "feature")
    p = F.col("n_baseline") / F.col("size_baseline")
    q = F.col("n_new") / F.col("size_new")
    middle = (p + q) / 2
    part = F.when(p > 0, p * F.ln(p / middle)).otherwise(0.0) + F.when(
        q > 0, q * F.ln(q / middle)
    ).otherwise(0.0)
    expected = p * F.col("size_new")
    infinite = F.lit(float("inf"))
    term = F.when(expected > 0, (F.col("n_new") - expected) ** 2 / expected).otherwise(infinite)
    both = joined.filter("size_baseline > 0 AND size_new > 0")
    return both.groupBy("feature").agg(
        F.sqrt(F.greatest(F.lit(0.0), F.sum(part) / 2)).alias("js_distance"),
        F.sum(term).alias("chi2"),
        (F.count(F.lit(1)) - 1).cast("int").alias("freedom"),
    )


def report_from(
    found: DataFrame,
    categories: DataFrame | None,
    judge: str = "distance",
    p_threshold: float = 0.05,
    distance_threshold: float = 0.1,
) -> DataFrame:
    """The drift report from numeric distances and category drift.

    ``judge`` is ``"p_value"`` or ``"distance"``.
    """
    if judge not in ("p_value", "distance"):
        raise ValueError(f"unknown judge {judge!r}")
    small = judge == "p_value"
    if small:
        numeric = ks_from(found).select("feature", F.lit("ks_p_value").alias("test"),
                                        F.col("p_value").alias("drift_score"))
        flag = F.col("drift_score") < p_threshold
    else:
        numeric = wasserstein_from(found).select(
            "feature", F.lit("wasserstein_normalised").alias("test"),
            F.col("normalised").alias("drift_score"))
        flag = F.col("drift_score") > distance_threshold
    scored = numeric
    if categories is not None and small:
        scored = numeric.unionByName(categories.select(
            "feature", F.lit("chi_square_p_value").alias("test"),
            chi2_tail_column("chi2", "freedom").alias("drift_score")))
    elif categories is not None:
        scored = numeric.unionByName(categories.select(
            "feature", F.lit("jensen_shannon").alias("test"),
            F.col("js_distance").alias("drift_score")))
    return scored.withColumn("drift_detected", flag)


def drift_report(
    baseline: DataFrame,
    new: DataFrame,
    numeric: Sequence[str],
    text: Sequence[str] = (),
    judge: str = "distance",
    p_threshold: float = 0.05,
    distance_threshold: float = 0.1,
) -> DataFrame:
    """One row per column: test name, drift score, drift flag.

    ``judge="p_value"`` decides by Kolmogorov-Smirnov and chi-square, meant for samples of up to about
    1000 rows; ``"distance"`` by normalised Wasserstein and Jensen-Shannon.
    """
    categories = category_drift(category_counts(baseline, new, text)) if text else None
    return report_from(
        distances(sample_counts(baseline, new, numeric)), categories,
        judge, p_threshold, distance_threshold,
    )


def drift_report_by_side(
    df: DataFrame, side: Column, numeric: Sequence[str], text: Sequence[str] = (), judge: str = "distance",
    p_threshold: float = 0.05, distance_threshold: float = 0.1,
) -> DataFrame:
    """``drift_report`` of two samples that lie in one table: one scan per kind of column."""
    categories = category_drift(category_counts_by_side(df, side, text)) if text else None
    return report_from(
        distances(counts_by_side(df, side, numeric)), categories, judge, p_threshold, distance_threshold
    )


def dataset_drift(report: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of drifted columns; the dataset drifts from ``share`` on."""
    return report.agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if("drift_detected").alias("drifted_columns"),
        F.try_divide(F.count_if("drift_detected"), F.count(F.lit(1))).alias("share_drifted"),
    ).withColumn("dataset_drift", F.coalesce(F.col("share_drifted") >= share, F.lit(False)))
