"""One row per group is attached without moving the rows; large sides are salted; scans are counted."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators import bias, cleaning, drift, ordered, scaling, splits
from tests.helpers import as_set


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    """A table larger than the default broadcast threshold, one group with a third of all rows."""
    path = str(tmp_path_factory.mktemp("big") / "t")
    group = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 50))
    rows = spark.range(400_000).select(
        F.col("id").alias("row_id"), group.cast("string").alias("zone"), F.rand(1).alias("x"), F.rand(2).alias("y"),
        F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_rows_are_not_moved(big):
    listed = big.sparkSession.createDataFrame([("hot",), ("g1",)], "zone string")
    for df in (
        scaling.scale_min_max(big, ["zone"], ["x"]), bias.balanced_weights(big, "zone"),
        cleaning.in_groups(big, listed, "zone"), cleaning.not_in_groups(big, listed, "zone"),
        splits.stratified_split(big, ["zone"], "row_id"), splits.chronological_split(big.withColumn("t", F.timestamp_seconds("row_id")), order="t"),
    ):
        plan = plan_of(df)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert "hashpartitioning" not in plan and plan.count("FileScan") <= 2


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_equals_broadcast(big, how, null_safe):
    rows = big.select("row_id", "zone").limit(5000)
    small = rows.where("zone IS NULL OR zone IN ('hot', 'g1', 'g2')").groupBy("zone").count()
    salted = ordered.attach(rows, small, ["zone"], how, null_safe, limit=0)
    assert as_set(salted) == as_set(ordered.attach(rows, small, ["zone"], how, null_safe))


def test_histogram_and_counts_are_one_scan(big):
    side = F.when(F.col("row_id") < 100_000, 0).otherwise(1)
    counted = drift.binned(big, side, ["x", "y"])
    plan = plan_of(counted)
    assert plan.count("FileScan") == 1 or plan.count("Final Plan") == 1
    old, new = big.where("row_id < 100000"), big.where("row_id >= 100000")
    for edges in ("own", "baseline"):
        assert as_set(drift.binned(big, side, ["x", "y"], edges=edges)) == as_set(drift.histogram(drift.sample_counts(old, new, ["x", "y"]), edges=edges))
    assert as_set(drift.counts_by_side(big.limit(1000), side, ["x"])) == as_set(
        drift.sample_counts(big.limit(1000).where("row_id < 100000"), big.limit(1000).where("row_id >= 100000"), ["x"]))
