"""Schema inference, validation, repair, gate."""

import pytest

from gridloom.operators import cleaning, quality
from gridloom.plans import jobs
from gridloom.session import scratch_path
from gridloom.sources import snapshots
from pyspark.sql import functions as F
from tests.helpers import hour

LAYOUT = "zone string, visibility int, HeatIndexF double"


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("a", 5, 50.0), ("b", 9, 70.0)], LAYOUT)


def failing(df, rules):
    return {(r.column, r.check): r.failures for r in quality.violation_counts(df, rules).collect() if r.failures}


def test_rows_validate_against_their_own_schema(known):
    rules = quality.infer_rules(known)
    assert quality.violation_free(known, rules)


def test_every_violation_is_found(spark, known):
    rules = quality.infer_rules(known)
    bad = spark.createDataFrame([("a", -5, None), (None, 12, 60.0)], LAYOUT)
    assert failing(bad, rules) == {
        ("visibility", "min"): 1, ("visibility", "max"): 1, ("HeatIndexF", "not_null"): 1, ("zone", "not_null"): 1}
    cells = {(r.visibility, r.column, r.check, r.found) for r in quality.violations(bad, rules, ["visibility"]).collect()}
    # The key column and the failing column may be the same one.
    assert (12, "visibility", "max", "12") in cells and (-5, "HeatIndexF", "not_null", None) in cells
    found = quality.verdict(quality.violation_counts(bad, rules)).first()
    assert (found.valid, found.failed_checks, found.failed_cells) == (False, 4, 4)


def test_missing_column_and_unreadable_text(spark, known):
    rules = quality.infer_rules(known)
    text = spark.createDataFrame([("a", "7"), ("b", "many"), ("b", "99")], "zone string, visibility string")
    assert failing(text, rules) == {("HeatIndexF", "present"): 1, ("visibility", "type"): 1, ("visibility", "max"): 1}


def test_no_rules_accept_everything(spark, known):
    assert quality.violation_free(known, [])
    only_absent = quality.violation_counts(known, [quality.ColumnRule("gone", "int", True)])
    assert [tuple(r) for r in only_absent.collect()] == [("gone", "present", 1)]


def test_validation_does_not_change_rows(spark, known):
    bad = spark.createDataFrame([("a", None, None)], LAYOUT)
    before = bad.collect()
    quality.violation_free(bad, quality.infer_rules(known))
    assert bad.collect() == before


def test_rules_survive_json(spark, known):
    rules = quality.infer_rules(known)
    assert quality.rules_from_json(quality.rules_to_json(rules)) == rules
    path = scratch_path(spark, "rules")
    quality.save_rules(spark, rules, path)
    assert sorted(quality.load_rules(spark, path), key=str) == sorted(rules, key=str)


def test_fix_anomalies(spark):
    df = spark.createDataFrame([("a", -5, None), ("a", -5, None), ("b", 3, -2.0)], LAYOUT)
    found = sorted(tuple(r) for r in quality.fix_anomalies(df).collect())
    assert found == [("a", 0, 0.0), ("b", 3, 0.0)]


def test_repair_order_may_leave_equal_rows(spark):
    df = spark.createDataFrame([("a", -5, 1.0), ("a", -6, 1.0)], LAYOUT)
    assert quality.fix_anomalies(df).count() == 2


def test_rejected_batch_is_set_aside(spark, known):
    path = scratch_path(spark, "aside")
    bad = spark.createDataFrame([("a", 500, 60.0)], LAYOUT)
    assert quality.gate(bad, quality.infer_rules(known), path) is False
    assert spark.read.parquet(path).collect() == bad.collect()


def raw_rows(spark, hours, value=lambda i: i % 17):
    from gridloom import schemas

    rows = []
    for zone in ("a", "b"):
        for i in hours:
            row = {f.name: (i * 7 + len(f.name)) % 23 for f in schemas.RAW_SCHEMA.fields}
            row.update(datetime=hour(i), zone=zone, value=value(i), precipMM=float(i % 5), precipInches=float(i % 3))
            row["subba-name"], row["value-units"] = zone.upper(), "megawatthours"
            rows.append(tuple(row[f.name] for f in schemas.RAW_SCHEMA.fields))
    return spark.createDataFrame(rows, schemas.RAW_SCHEMA)


def test_daily_increment_merges_or_rejects(spark):
    history = jobs.preprocess(raw_rows(spark, range(0, 100))).cache()
    store, aside = scratch_path(spark, "store"), scratch_path(spark, "aside")
    accepted = jobs.daily_increment(history, raw_rows(spark, range(80, 130)), store=store, quarantine=aside)
    assert accepted.accepted and accepted.version == 1
    published = snapshots.read_version(spark, store)
    assert published.count() == published.select("zone", "datetime").distinct().count() == 2 * (130 - 6)
    strict = [quality.ColumnRule("value", "double", False, 0.0, 0.5)]
    refused = jobs.daily_increment(history, raw_rows(spark, range(80, 130)), strict, store, aside)
    assert not refused.accepted and refused.merged is None
    assert snapshots.latest_version(spark, store) == 1
    assert spark.read.parquet(aside).count() > 0


def test_daily_increment_into_a_month_table(spark):
    from gridloom.streaming.ingest import overwrite_months, partition_months

    table = scratch_path(spark, "table")
    history = jobs.preprocess(raw_rows(spark, range(0, 100))).cache()
    overwrite_months(partition_months(history), table)
    found = jobs.daily_increment(history, raw_rows(spark, range(80, 130)), table=table)
    whole = jobs.daily_increment(history, raw_rows(spark, range(80, 130)))
    assert sorted(map(str, found.merged.select(*whole.merged.columns).collect())) == sorted(map(str, whole.merged.collect()))


def test_preprocess_keeps_32_columns_and_bounds(spark):
    found = jobs.preprocess(raw_rows(spark, range(60)))
    assert len(found.columns) == 32
    row = found.agg(F.min("value"), F.max("value"), F.count("*")).first()
    assert tuple(row) == (0.0, 1.0, 2 * 54)


def test_unknown_scope_is_refused(spark):
    with pytest.raises(ValueError, match="scope"):
        jobs.preprocess(raw_rows(spark, range(10)), scope="zone")


def test_text_nan_and_retyping(spark):
    df = spark.createDataFrame([("nan", float("nan")), ("x", 1.0)], "a string, b double")
    assert [tuple(r) for r in cleaning.text_nan_to_null(df).collect()] == [(None, None), ("x", 1.0)]
    raw = spark.createDataFrame(
        [("2019-06-05T17", "COAS", "13395", "oops", "0.3"), ("2019-06-05 18:00:00", "FWES", "3442", "7", None)],
        "datetime string, zone string, value string, tempF string, precipMM string")
    found = cleaning.retype_raw(raw).collect()
    assert [(str(r.datetime), r.zone, r.value, r.tempF, r.precipMM) for r in found] == [
        ("2019-06-05 17:00:00", "COAS", 13395, 0, 0.3), ("2019-06-05 18:00:00", "FWES", 3442, 7, 0.0)]
