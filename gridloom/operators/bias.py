"""Slice bias, coverage bias, metric frames by group, and mitigation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.combine import append_new, grid_over
from gridloom.operators.cleaning import in_groups, not_in_groups
from gridloom.operators.ordered import attach, cname, join_on_keys
from gridloom.operators.windows import fill_gaps
from gridloom.session import checkpointed


def slice_means(df: DataFrame, slices: Sequence[str], metric: str) -> DataFrame:
    """(slice, mean, rows) for each value of each slice column, all in one pass."""
    marks = [F.grouping(cname(c)).alias(f"_out_{i}") for i, c in enumerate(slices)]
    grouped = df.groupingSets([[cname(c)] for c in slices], *map(cname, slices)).agg(
        F.avg(cname(metric)).alias("mean"), F.count(F.lit(1)).alias("rows"), *marks
    )
    name = F.coalesce(
        *[
            F.when(F.col(f"_out_{i}") == 0, F.concat(F.lit(f"{c}_"), cname(c).cast("string")))
            for i, c in enumerate(slices)
        ]
    )
    return grouped.select(name.alias("slice"), "mean", "rows").filter("slice IS NOT NULL")


def biased_slices(means: DataFrame, ratio: float = 0.2) -> DataFrame:
    """Slices whose mean is off the plain mean of slice means by more than ``ratio`` of it."""
    overall = means.agg(F.avg("mean")).scalar()
    return means.withColumn("overall", overall).filter(
        F.abs(F.col("mean") - F.col("overall")) > F.lit(ratio) * F.col("overall")
    )


def slice_bias_by_feature(
    df: DataFrame, slices: Sequence[str], features: Sequence[str], ratio: float = 0.2
) -> DataFrame:
    """Slice bias of many features at once: (feature, slice, mean, overall).

    All feature means come from one grouping; only the small result is turned long.
    """
    marks = [F.grouping(cname(c)).alias(f"_out_{i}") for i, c in enumerate(slices)]
    grouped = df.groupingSets([[cname(c)] for c in slices], *map(cname, slices)).agg(
        *[F.avg(cname(f)).cast("double").alias(f"_mean_{f}") for f in features], *marks
    )
    name = F.coalesce(
        *[
            F.when(F.col(f"_out_{i}") == 0, F.concat(F.lit(f"{c}_"), cname(c).cast("string")))
            for i, c in enumerate(slices)
        ]
    )
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), cname(f"_mean_{f}").alias("mean")) for f in features]
    )
    means = grouped.select(name.alias("slice"), F.inline(pairs)).filter("slice IS NOT NULL")
    overall = means.groupBy("feature").agg(F.avg("mean").alias("overall"))
    return means.join(overall, "feature").filter(
        F.abs(F.col("mean") - F.col("overall")) > F.lit(ratio) * F.col("overall")
    )


def largest_slice(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(cname(column)).count().agg(F.max("count").alias("rows"))


def coverage(df: DataFrame, target: str, group: str) -> DataFrame:
    """Share of non-null targets per group, and one overall row (``scope``).

    Truth and prediction are the same not-null flag, so the accuracy is 1 by construction.
    """
    flag = cname(target).isNotNull().cast("int")
    return df.groupingSets([[cname(group)], []], cname(group)).agg(
        F.when(F.grouping(cname(group)) == 1, "overall").otherwise("group").alias("scope"),
        F.avg(flag).alias("selection_rate"),
        F.avg((flag == flag).cast("int")).alias("accuracy"),
        F.count(F.lit(1)).alias("rows"),
    )


def group_difference(frame: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Largest minus smallest group value of each metric."""
    return frame.filter("scope = 'group'").agg(
        *[(F.max(cname(m)) - F.min(cname(m))).alias(f"{m}_difference") for m in metrics]
    )


def metric_frame(
    df: DataFrame, truth: str, predicted: str, groups: Sequence[str], complete: bool = False
) -> DataFrame:
    """mse and mae per (crossed) group, and one overall row.

    ``complete`` adds group combinations without rows, with null metrics.
    """
    error = cname(truth).cast("double") - cname(predicted).cast("double")
    frame = df.groupingSets([[cname(g) for g in groups], []], *map(cname, groups)).agg(
        F.when(F.grouping(cname(groups[0])) == 1, "overall").otherwise("group").alias("scope"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count(F.lit(1)).alias("rows"),
    )
    if not complete or len(groups) == 1:
        return frame
    present = frame.filter("scope = 'group'")
    combos = present.select(cname(groups[0])).distinct()
    for g in groups[1:]:
        values = present.agg(F.collect_set(cname(g))).scalar()
        combos = combos.withColumn(g, F.explode(values))
    absent = combos.join(present.select(*map(cname, groups)), list(groups), "left_anti")
    return frame.unionByName(
        absent.withColumn("scope", F.lit("group")).withColumn("rows", F.lit(0).cast("bigint")),
        allowMissingColumns=True,
    )


def metric_ratios(frame: DataFrame, metric: str) -> DataFrame:
    """Between-group ratio both ways, and the worst ratio to the overall value."""
    overall = frame.filter("scope = 'overall'").select(cname(metric)).scalar()
    value = cname(metric)
    against = F.least(F.try_divide(value, overall), F.try_divide(overall, value))
    return frame.filter("scope = 'group'").agg(
        F.try_divide(F.min(value), F.max(value)).alias("ratio_min_max"),
        F.try_divide(F.max(value), F.min(value)).alias("ratio_max_min"),
        F.min(against).alias("ratio_to_overall"),
    )


def biased_groups(frame: DataFrame, metric: str = "mae", multiplier: float = 1.5) -> DataFrame:
    """Groups whose metric differs from the overall value by more than multiplier × overall."""
    overall = frame.filter("scope = 'overall'").select(cname(metric)).scalar()
    return (
        frame.filter("scope = 'group'")
        .withColumn("overall", overall)
        .withColumn(f"{metric}_difference", F.abs(cname(metric) - F.col("overall")))
        .filter(cname(f"{metric}_difference") > F.lit(multiplier) * F.col("overall"))
    )


def balanced_weights(df: DataFrame, group: str, name: str = "weight") -> DataFrame:
    """Weight n / (k · n_g) per row: every group weighs the same in total."""
    sizes = df.groupBy(cname(group)).agg(F.count(F.lit(1)).alias("_n"))
    whole = sizes.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = sizes.select(
        cname(group), (whole["n"] / (whole["k"] * F.col("_n"))).alias(name)
    )
    return attach(df, weights, [group], "left", null_safe=True)


def under_covered(df: DataFrame, target: str, group: str, threshold: float = 0.05) -> DataFrame:
    """Groups whose coverage differs from the overall coverage by more than the threshold."""
    rates = coverage(df, target, group)
    overall = rates.filter("scope = 'overall'").select("selection_rate").scalar()
    return rates.filter("scope = 'group'").filter(
        F.abs(F.col("selection_rate") - overall) > threshold
    )


def fill_biased_groups(
    df: DataFrame,
    target: str,
    group: str,
    order: str = "datetime",
    step_seconds: int = 3600,
    threshold: float = 0.05,
) -> DataFrame:
    """Biased groups get the full calendar and filled measures; the others stay as they are.

    (group, ``order``) must be a key (see ``require_unique``).
    """
    # One scan: coverage and time span per group, and of the whole table.
    flag = cname(target).isNotNull().cast("int")
    facts = checkpointed(df.groupingSets([[cname(group)], []], cname(group)).agg(
        F.grouping(cname(group)).alias("_all"), F.avg(flag).alias("_rate"),
        F.min(cname(order)).alias("first"), F.max(cname(order)).alias("last"),
    ))
    whole = facts.filter("_all = 1")
    off = F.abs(F.col("_rate") - whole.select("_rate").scalar()) > threshold
    flagged = checkpointed(facts.filter("_all = 0").filter(off).select(cname(group)))
    span = whole.select(F.struct("first", "last")).scalar()
    biased = in_groups(df, flagged, group)
    grid = grid_over(flagged.filter(cname(group).isNotNull()), order, span, df.schema[order].dataType, step_seconds)
    on_grid = join_on_keys(grid, biased, [group, order], "left").select(*map(cname, df.columns))
    measures = [c for c in df.columns if c not in (group, order)]
    mended = fill_gaps(on_grid, measures, [group], order)
    return append_new(mended, not_in_groups(df, flagged, group))


def high_low(column: Column, cut: Column) -> Column:
    """``high`` above the cut, else ``low``."""
    return F.when(column > cut, "high").otherwise("low")
