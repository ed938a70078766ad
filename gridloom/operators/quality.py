"""Inferred schemas, validation, anomaly repair and the gate."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.cleaning import clip_negatives, fill_zero
from gridloom.operators.ordered import cname


@dataclass(frozen=True)
class ColumnRule:
    """What is known of one column: type, nullability, bounds of numbers, allowed values of text."""

    column: str
    type: str
    nullable: bool
    min: float | None = None
    max: float | None = None
    values: tuple[str, ...] | None = None


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def schema_statistics(df: DataFrame) -> DataFrame:
    """(column, type, nullable, min, max): one aggregation over all columns."""
    facts = []
    for i, field in enumerate(df.schema.fields):
        column = cname(field.name)
        low = F.min(column).cast("double") if _is_number(field) else F.lit(None).cast("double")
        high = F.max(column).cast("double") if _is_number(field) else F.lit(None).cast("double")
        facts.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                (F.count_if(column.isNull()) > 0).alias("nullable"),
                low.alias("min"),
                high.alias("max"),
            ).alias(f"_{i}")
        )
    wide = df.agg(*facts)
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(facts))])))


def infer_rules(df: DataFrame) -> list[ColumnRule]:
    """The schema statistics as rules: one row per column comes to the driver."""
    return [ColumnRule(**row.asDict()) for row in schema_statistics(df).collect()]


def rules_to_json(rules: Sequence[ColumnRule]) -> str:
    return json.dumps([asdict(r) for r in rules], indent=1)


def rules_from_json(text: str) -> list[ColumnRule]:
    return [_rule(entry) for entry in json.loads(text)]


def _rule(entry: dict) -> ColumnRule:
    values = entry.get("values")
    return ColumnRule(**{**entry, "values": None if values is None else tuple(values)})


_LAYOUT = "column string, type string, nullable boolean, min double, max double, values array<string>"


def save_rules(spark: SparkSession, rules: Sequence[ColumnRule], path: str) -> None:
    kept = [(r.column, r.type, r.nullable, r.min, r.max, None if r.values is None else list(r.values)) for r in rules]
    spark.createDataFrame(kept, _LAYOUT).coalesce(1).write.mode("overwrite").json(path)


def load_rules(spark: SparkSession, path: str) -> list[ColumnRule]:
    return [_rule(r.asDict()) for r in spark.read.schema(_LAYOUT).json(path).collect()]


def _same_kind(rule: ColumnRule, field: T.StructField) -> bool:
    return rule.type == field.dataType.simpleString()


def _checks(rules: Sequence[ColumnRule], df: DataFrame) -> list[tuple[str, str, Column]]:
    """(column, check, failed?) for every rule that can be tested on a row."""
    fields = {f.name: f for f in df.schema.fields}
    checks = []
    for rule in rules:
        field = fields.get(rule.column)
        if field is None:
            continue
        value = cname(rule.column)
        if not _same_kind(rule, field):
            readable = value.try_cast(rule.type)
            checks.append((rule.column, "type", value.isNotNull() & readable.isNull()))
            value = readable
        if not rule.nullable:
            checks.append((rule.column, "not_null", cname(rule.column).isNull()))
        if rule.min is not None:
            low = value.cast("double") < F.lit(rule.min)
            checks.append((rule.column, "min", F.coalesce(low, F.lit(False))))
        if rule.max is not None:
            high = value.cast("double") > F.lit(rule.max)
            checks.append((rule.column, "max", F.coalesce(high, F.lit(False))))
        if rule.values is not None:
            known = F.array_contains(F.lit(list(rule.values)).cast("array<string>"), cname(rule.column).cast("string"))
            checks.append((rule.column, "value", F.coalesce(~known, F.lit(False))))
    return checks


def missing_columns(df: DataFrame, rules: Sequence[ColumnRule]) -> list[str]:
    return [r.column for r in rules if r.column not in df.columns]


def violations(df: DataFrame, rules: Sequence[ColumnRule], keys: Sequence[str]) -> DataFrame:
    """Every failing cell: key columns, column, check, value as text."""
    checks = _checks(rules, df)
    found = F.array(
        *[
            F.when(
                failed,
                F.struct(
                    F.lit(column).alias("column"),
                    F.lit(check).alias("check"),
                    cname(column).cast("string").alias("found"),
                ),
            )
            for column, check, failed in checks
        ]
    )
    return df.select(
        *map(cname, keys), F.inline(F.filter(found, lambda c: c.isNotNull()))
    )


def violation_counts(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """(column, check, failures) for every check, all in one pass; missing columns count 1."""
    checks = _checks(rules, df)
    absent = [
        F.struct(F.lit(c).alias("column"), F.lit("present").alias("check"),
                 F.lit(1).cast("bigint").alias("failures"))
        for c in missing_columns(df, rules)
    ]
    if not checks:
        layout = "column string, check string, failures bigint"
        empty = df.sparkSession.createDataFrame([], layout)
        return df.sparkSession.range(1).select(F.inline(F.array(*absent))) if absent else empty
    wide = df.agg(
        *[
            F.struct(
                F.lit(column).alias("column"),
                F.lit(check).alias("check"),
                F.count_if(failed).alias("failures"),
            ).alias(f"_{i}")
            for i, (column, check, failed) in enumerate(checks)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(checks))], *absent)))


def verdict(counts: DataFrame) -> DataFrame:
    """One row: is the batch valid, how many checks failed, how many cells."""
    return counts.agg(
        (F.coalesce(F.sum("failures"), F.lit(0)) == 0).alias("valid"),
        F.count_if(F.col("failures") > 0).alias("failed_checks"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("failed_cells"),
    )


def fix_anomalies(df: DataFrame) -> DataFrame:
    """Null numbers to 0, distinct rows, negatives to 0 — in this order."""
    return fill_zero(df).dropDuplicates().transform(clip_negatives)


def violation_free(df: DataFrame, rules: Sequence[ColumnRule]) -> bool:
    """The verdict alone: one aggregated row reaches the driver."""
    return bool(verdict(violation_counts(df, rules)).first()["valid"])


def gate(df: DataFrame, rules: Sequence[ColumnRule], quarantine: str | None = None) -> bool:
    """The real verdict on a batch; a rejected batch is written aside."""
    accepted = violation_free(df, rules)
    if not accepted and quarantine:
        df.write.mode("append").parquet(quarantine)
    return accepted
