"""Column states merge to the state of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import quality, rulestate

LAYOUT = "z string, `a.b` int, x double, d date"


def table(spark, n=300):
    rng = random.Random(n)
    rows = [(rng.choice(["p", "q", None, f"v{i % 7}"]), rng.choice([None, i]), rng.uniform(-5, 5), None) for i in range(n)]
    return spark.createDataFrame(rows, LAYOUT)


def as_rows(state):
    return sorted(map(str, state.select("column", "types", "rows", "nulls", "min", "max", "values", "overflow").collect()))


@pytest.mark.parametrize("limit", [3, 9, 100])
def test_merged_state_is_the_state_of_all_rows(spark, tmp_path, limit):
    df, path = table(spark), str(tmp_path / "state")
    for i in range(4):
        rulestate.save_merged(df.filter(F.pmod(F.xxhash64("x"), F.lit(4)) == i), path, value_sets=["z"], limit=limit)
    assert rulestate.saved_numbers(spark, path) == [0, 1, 2, 3]
    whole = rulestate.column_state(df, ["z"], limit)
    assert as_rows(rulestate.load_state(spark, path)) == as_rows(whole)
    assert whole.where("column = 'z'").first().overflow == (limit < 9)
    bounds = {r.column: (r.type, r.nullable, r.min, r.max) for r in quality.infer_rules(df)}
    assert {r.column: (r.type, r.nullable, r.min, r.max) for r in rulestate.rules_of(whole)} == bounds


def test_a_repeated_batch_writes_the_same_state(spark, tmp_path):
    df, path = table(spark, 20), str(tmp_path / "state")
    rulestate.save_merged(df, path, 0)
    for _ in range(2):
        rulestate.save_merged(df, path, 1)
    assert rulestate.load_state(spark, path).where("column = 'x'").first().rows == 40


def test_empty_tables_and_changed_types(spark):
    empty = rulestate.column_state(table(spark, 5).limit(0), ["z"])
    assert {r["rows"] for r in empty.collect()} == {0}
    other = rulestate.column_state(spark.range(3).select(F.col("id").alias("x")))
    merged = rulestate.merge_states(rulestate.column_state(table(spark, 5)).unionByName(other))
    assert merged.where("column = 'x'").first().types == ["bigint", "double"]
    assert "x" not in {r.column for r in rulestate.rules_of(merged)}


def test_values_are_checked_and_survive_saving(spark, tmp_path):
    rules = [quality.ColumnRule("z", "string", True, values=("p", "q"))]
    path = str(tmp_path / "rules")
    quality.save_rules(spark, rules, path)
    assert quality.load_rules(spark, path) == rules == quality.rules_from_json(quality.rules_to_json(rules))
    df = spark.createDataFrame([("p",), ("x",), (None,)], "z string")
    assert [tuple(r) for r in quality.violations(df, rules, ["z"]).collect()] == [("x", "z", "value", "x")]
