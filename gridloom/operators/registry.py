"""Model runs and model versions as tables: gates, promotion, roll-back.

``model_runs``: run_id, run_name, metrics map<string,double>, start_ts.
``model_versions``: name, version, stage, run_id.
All rules work on every model name at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, run_name string, metrics map<string,double>, start_ts timestamp"
VERSION_SCHEMA = "name string, version bigint, stage string, run_id string"

PRODUCTION, ARCHIVED, NO_STAGE = "Production", "Archived", "None"


def log_runs(runs: DataFrame, path: str) -> None:
    """Append runs to the run table."""
    runs.write.mode("append").parquet(path)


def best_run(runs: DataFrame, metric: str = "R2") -> DataFrame:
    """The run with the highest metric, with its model type (run name up to the first ``_``)."""
    return (
        runs.withColumn("score", F.col("metrics")[metric])
        .orderBy(F.desc_nulls_last("score"), "run_id")
        .limit(1)
        .withColumn("model_type", F.substring_index("run_name", "_", 1))
    )


def registrable(runs: DataFrame, min_r2: float = 0.3, max_mse: float = 0.01) -> DataFrame:
    """Runs good enough to register; a run without both metrics is skipped."""
    return runs.filter((F.col("metrics")["R2"] > min_r2) & (F.col("metrics")["MSE"] < max_mse))


def passes_gate(
    mse: Column, mae: Column, r2: Column,
    max_mse: float = 1000.0, max_mae: float = 1000.0, min_r2: float = 0.7,
) -> Column:
    """The evaluation gate; a missing metric does not pass."""
    return F.coalesce((mse <= max_mse) & (mae <= max_mae) & (r2 >= min_r2), F.lit(False))


def may_serve(mae_before: Column, mae_after: Column) -> Column:
    """Serve a mitigated model if its error, at 4 decimals, is not worse."""
    return F.round(mae_after, 4) <= F.round(mae_before, 4)


def current_production(versions: DataFrame) -> DataFrame:
    """Newest version in production per model."""
    return (
        versions.filter(F.col("stage") == PRODUCTION)
        .groupBy("name")
        .agg(F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id"))
    )


def latest_archived(versions: DataFrame) -> DataFrame:
    """Newest archived version per model: the one to go back to."""
    return (
        versions.filter(F.col("stage") == ARCHIVED)
        .groupBy("name")
        .agg(F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id"))
    )


def list_models(versions: DataFrame) -> DataFrame:
    """One row per model: how many versions, the newest one, the one in production."""
    return versions.groupBy("name").agg(
        F.count(F.lit(1)).alias("versions"),
        F.max("version").alias("latest"),
        F.max(F.when(F.col("stage") == PRODUCTION, F.col("version"))).alias("production"),
    )


def with_previous(versions: DataFrame) -> DataFrame:
    """Add the version before each version of the same model."""
    by_version = Window.partitionBy("name").orderBy("version")
    return versions.withColumn("previous", F.lag("version").over(by_version))


def move_stage(versions: DataFrame, name: str, version: int, stage: str) -> DataFrame:
    """Put one version into a stage."""
    chosen = (F.col("name") == name) & (F.col("version") == version)
    return versions.withColumn("stage", F.when(chosen, stage).otherwise(F.col("stage")))


def promote(versions: DataFrame, runs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Promote candidates (name, candidate version) where no version is in production or the
    candidate's R2 is higher; the versions they replace are archived."""
    columns = versions.columns
    scored = versions.join(
        runs.select("run_id", F.col("metrics")["R2"].alias("_r2")), "run_id", "left"
    ).join(candidates.select("name", "candidate"), "name", "left")
    lowest = F.lit(float("-inf"))
    facts = scored.groupBy("name").agg(
        F.max_by(
            F.coalesce(F.col("_r2"), lowest),
            F.when(F.col("stage") == PRODUCTION, F.col("version")),
        ).alias("_current"),
        F.max(
            F.when(F.col("version") == F.col("candidate"), F.coalesce(F.col("_r2"), lowest))
        ).alias("_new"),
    )
    accepted = F.col("_new").isNotNull() & (
        F.col("_current").isNull() | (F.col("_new") > F.col("_current"))
    )
    is_candidate = F.coalesce(F.col("version") == F.col("candidate"), F.lit(False))
    stage = (
        F.when(accepted & is_candidate, PRODUCTION)
        .when(accepted & (F.col("stage") == PRODUCTION), ARCHIVED)
        .otherwise(F.col("stage"))
    )
    return scored.join(facts, "name").withColumn("stage", stage).select(*columns)


def roll_back(versions: DataFrame) -> DataFrame:
    """Swap production for the version before it; models without one stay as they are."""
    columns = versions.columns
    current = with_previous(versions).join(
        current_production(versions).select("name", F.col("version").alias("_current")),
        "name",
        "left",
    )
    target = current.withColumn(
        "_target",
        F.max(F.when(F.col("version") == F.col("_current"), F.col("previous"))).over(
            Window.partitionBy("name")
        ),
    )
    stage = (
        F.when(F.col("_target").isNull(), F.col("stage"))
        .when(F.col("version") == F.col("_target"), PRODUCTION)
        .when(F.col("version") == F.col("_current"), ARCHIVED)
        .otherwise(F.col("stage"))
    )
    return target.withColumn("stage", stage).select(*columns)
