"""What is known of a table's columns as a small state that merges, so rules never need the history.

One row per column: rows and nulls seen, bounds, types, and for chosen text columns the set of
values up to a limit. The state of two batches merged is the state of their union, so each accepted
batch adds its own state to the one saved before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.ordered import cname
from gridloom.operators.quality import ColumnRule
from gridloom.sources import snapshots

STATE = (
    "column string, types array<string>, rows bigint, nulls bigint, min double, max double, "
    "values array<string>, overflow boolean"
)
#: A set of more values is given up: ``values`` is null and ``overflow`` is true from then on.
VALUE_LIMIT = 1000


def column_state(df: DataFrame, value_sets: Sequence[str] = (), limit: int = VALUE_LIMIT) -> DataFrame:
    """The state of one table: one aggregation over all columns, one more per column of ``value_sets``.

    Values are made distinct before the shuffle, and each task passes on the first ``limit + 1`` of them, so
    a column with too many values costs no more than one that just fits.
    """
    facts = []
    for i, field in enumerate(df.schema.fields):
        column, number = cname(field.name), isinstance(field.dataType, T.NumericType)
        bounds = [f(column).cast("double") if number else F.lit(None).cast("double") for f in (F.min, F.max)]
        facts.append(
            F.struct(
                F.lit(field.name).alias("column"), F.array(F.lit(field.dataType.simpleString())).alias("types"),
                F.count(F.lit(1)).alias("rows"), F.count_if(column.isNull()).alias("nulls"),
                bounds[0].alias("min"), bounds[1].alias("max"),
            ).alias(f"_{i}")
        )
    wide = df.agg(*facts)
    state = wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(facts))])))
    sets = None
    for name in value_sets:
        text = cname(name).cast("string")
        held = df.where(text.isNotNull()).select(text.alias("value")).distinct().orderBy("value").limit(limit + 1)
        one = held.agg(F.sort_array(F.collect_list("value")).alias("values")).select(F.lit(name).alias("column"), "values")
        sets = one if sets is None else sets.unionByName(one)
    if sets is None:
        return state.withColumns({"values": F.lit(None).cast("array<string>"), "overflow": F.lit(False)})
    return _limited(state.join(F.broadcast(sets), "column", "left"), F.lit(False), limit)  # one row per chosen column


def _limited(state: DataFrame, overflow, limit: int) -> DataFrame:
    over = F.coalesce(F.size("values") > limit, F.lit(False)) | overflow
    return state.withColumn("overflow", over).withColumn("values", F.when(~F.col("overflow"), F.col("values")))


def merge_states(states: DataFrame, limit: int = VALUE_LIMIT) -> DataFrame:
    """One state per column from any number of them, in any order."""
    merged = states.groupBy("column").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"),
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.max(F.col("values").isNotNull()).alias("_held"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("values")))).alias("values"),
        F.max("overflow").alias("_over"),
    )
    merged = merged.withColumn("values", F.when(F.col("_held"), F.col("values")))
    return _limited(merged, F.col("_over"), limit).drop("_held", "_over")


def rules_of(state: DataFrame) -> list[ColumnRule]:
    """The state as rules: a column of one type, nullable if a null was seen, with its bounds and values.

    One row per column comes to the driver. Columns that came with different types get no rule.
    """
    rows = state.where(F.size("types") == 1).collect()
    return [
        ColumnRule(r["column"], r["types"][0], r["nulls"] > 0, r["min"], r["max"], None if r["values"] is None else tuple(r["values"]))
        for r in rows
    ]


def saved_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose state was saved."""
    if not snapshots.exists(spark, path):
        return []
    return sorted(r.batch for r in spark.read.schema(f"{STATE}, batch bigint").json(path).select("batch").distinct().collect())


def load_state(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest saved state, or the newest of a batch before ``before``."""
    numbers = [n for n in saved_numbers(spark, path) if before is None or n < before]
    return spark.read.schema(STATE).json(f"{path.rstrip('/')}/batch={numbers[-1]}") if numbers else None


def save_merged(
    batch: DataFrame, path: str, number: int | None = None, value_sets: Sequence[str] = (), limit: int = VALUE_LIMIT
) -> DataFrame:
    """Add an accepted batch to the state before it and save the result as the state of ``number``.

    Repeating a batch under its number writes the same state again.
    """
    spark = batch.sparkSession
    known = saved_numbers(spark, path)
    number = (known[-1] + 1 if known else 0) if number is None else number
    own, old = column_state(batch, value_sets, limit), load_state(spark, path, number)
    merged = merge_states(own if old is None else old.unionByName(own), limit)
    target = f"{path.rstrip('/')}/batch={number}"
    merged.coalesce(1).write.mode("overwrite").json(target)  # one row per column
    return spark.read.schema(STATE).json(target)
