"""Incremental ingest equals the batch result; replays are harmless."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.operators import combine, windows
from gridloom.operators.quality import ColumnRule
from gridloom.streaming import ingest
from tests.helpers import as_set, hour, series

LAYOUT = "zone string, datetime timestamp_ntz, value double"
FIRST = [("a", hour(i), float(i)) for i in range(1000)] + [("b", hour(i), 1.0) for i in range(50)]
SECOND = [("a", hour(i), -1.0) for i in range(900, 1100)] + [("b", hour(10), None)]


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / x) for x in ("landed", "table", "progress", "aside")]


def run(spark, folders, schema, **options):
    landed, table, progress, aside = folders
    stream = ingest.landed_stream(spark, landed, schema, files_per_batch=1)
    ingest.ingest(stream, table, progress, quarantine=aside, **options).awaitTermination()
    return spark.read.parquet(table)


def test_stream_equals_batch_and_goes_on_later(spark, folders):
    first, second = (spark.createDataFrame(rows, LAYOUT) for rows in (FIRST, SECOND))
    first.coalesce(1).write.parquet(folders[0])
    run(spark, folders, first.schema)
    second.coalesce(1).write.mode("append").parquet(folders[0])
    found = run(spark, folders, first.schema)
    expected = combine.merge_history(first, second.na.drop())
    assert as_set(found.select(*first.columns)) == as_set(expected)
    assert dict(found.dtypes)["month"] == "string"


def test_replayed_batch_changes_nothing(spark, folders):
    first = spark.createDataFrame(FIRST, LAYOUT)
    for _ in range(2):
        ingest.merge_batch(first, folders[1], ["zone", "datetime"])
    assert as_set(spark.read.parquet(folders[1]).select(*first.columns)) == as_set(first)


def test_untouched_months_are_not_rewritten(spark, folders, tmp_path):
    first = spark.createDataFrame(FIRST, LAYOUT)  # January and February
    ingest.merge_batch(first, folders[1], ["zone", "datetime"])
    january = sorted(p.name for p in (tmp_path / "table" / "month=2024-01").iterdir())
    ingest.merge_batch(spark.createDataFrame([("a", hour(1200), 5.0)], LAYOUT), folders[1], ["zone", "datetime"])
    assert sorted(p.name for p in (tmp_path / "table" / "month=2024-01").iterdir()) == january
    assert spark.read.parquet(folders[1]).count() == len(FIRST) + 1


def test_bad_batch_is_set_aside_whole(spark, folders):
    good, bad = spark.createDataFrame(FIRST, LAYOUT), spark.createDataFrame([("a", hour(5000), 9e9)], LAYOUT)
    good.coalesce(1).write.parquet(folders[0])
    bad.coalesce(1).write.mode("append").parquet(folders[0])
    rules = [ColumnRule("value", "double", True, -1e6, 1e6)]
    found = run(spark, folders, good.schema, rules=rules)
    assert found.count() == len(FIRST)
    assert spark.read.parquet(folders[3]).count() == 1


def test_overlap_is_dropped_by_key(spark, folders):
    landed, table, progress, _ = folders
    spark.createDataFrame(FIRST, LAYOUT).write.parquet(landed)
    spark.createDataFrame(FIRST, LAYOUT).write.mode("append").parquet(landed)
    stream = ingest.landed_stream(spark, landed, spark.createDataFrame([], LAYOUT).schema)
    (ingest.dedupe_overlap(stream).writeStream.format("parquet").option("path", table)
     .option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(table).count() == len(FIRST)


def test_features_follow_late_and_out_of_order_batches(spark, folders, tmp_path):
    whole = series(spark, {"hot": 1200, "b": 200, "late": 20}, gap=0.3)
    whole = whole.withColumn("n", F.row_number().over(Window.partitionBy("zone").orderBy("datetime")))
    part = F.when(F.col("n") % 7 == 3, 2).when(F.col("n") > 600, 1).otherwise(0)
    parts = whole.withColumn("part", F.when(F.col("zone") == "late", 2).otherwise(part)).drop("n").cache()
    features = str(tmp_path / "features")
    for i in (1, 0, 2):
        batch = parts.filter(F.col("part") == i).drop("part")
        batch.coalesce(1).write.mode("append").parquet(folders[0])
        run(spark, folders, batch.schema, features=features)
    expected = windows.cyclic_month(windows.engineer_features(parts.drop("part"), unit=None))
    found = spark.read.parquet(features)
    assert as_set(found.select(*expected.columns)) == as_set(expected)


def test_history_is_searched_when_recent_months_have_too_few_rows(spark, folders, tmp_path):
    features = str(tmp_path / "features")
    layout = "zone string, datetime timestamp_ntz, tempF double, windspeedMiles double, humidity double, value double"
    old = spark.createDataFrame([("a", hour(i), float(i), 1.0, 2.0, 3.0) for i in range(10)], layout)
    new = spark.createDataFrame([("a", hour(24 * 200 + i), 50.0 + i, 1.0, 2.0, 3.0) for i in range(2)], layout)
    for batch in (old, new):
        ingest.merge_batch(batch, folders[1], ["zone", "datetime"])
        ingest.refresh_features(batch, folders[1], features)
    expected = windows.cyclic_month(windows.engineer_features(old.unionByName(new), unit=None))
    assert as_set(spark.read.parquet(features).select(*expected.columns)) == as_set(expected)


def deliver(spark, folders, parts, files_per_batch, sequence=()):
    landed, table, progress, late = folders
    marks = landed + "-marks"
    for part in parts:
        spark.createDataFrame(part, LAYOUT).coalesce(1).write.mode("append").parquet(landed)
    stream = ingest.landed_stream(spark, landed, spark.createDataFrame([], LAYOUT).schema, files_per_batch=files_per_batch)
    ingest.merge_overlap(stream, table, late, marks, progress, sequence=sequence).awaitTermination()


def test_late_rows_are_merged_and_listed(spark, folders):
    parts = [[("a", hour(i), 1.0) for i in range(1000 + p, 1400, 4)] for p in range(2)]
    late = [("a", hour(i), 2.0) for i in (3, 700)] + [("a", hour(1399), 2.0), ("b", hour(900), 2.0), ("b", hour(1300), 2.0)]
    deliver(spark, folders, [*parts, late], 1)
    found = spark.read.parquet(folders[1])
    assert found.count() == sum(map(len, parts)) + 5
    schema = spark.createDataFrame([], LAYOUT).schema
    listed = ingest.late_rows(spark, folders[3], schema).where("batch = 2").collect()
    assert sorted((r.zone, r.datetime) for r in listed) == [("a", hour(3)), ("a", hour(700)), ("b", hour(900))]
    assert {r.batch: r.late_rows for r in ingest.late_counts(spark, folders[3], schema).collect()}[2] == 3


@pytest.mark.parametrize("files_per_batch", [1, 2, 100])
def test_any_order_and_split_of_files_gives_the_batch_result(spark, tmp_path, files_per_batch):
    import random

    rng = random.Random(3)
    rows = [("ab"[rng.randrange(2)], hour(rng.randrange(3000)), float(rng.randrange(9))) for _ in range(1200)]
    rows += [("a", None, 5.0), ("a", None, 4.0)]
    parts = [rows[i::5] for i in range(5)]
    expected = as_set(combine.keep_first(spark.createDataFrame(rows, LAYOUT), ["zone", "datetime"], "value"))
    for turn in range(2):
        folders = [str(tmp_path / f"{turn}-{x}") for x in ("landed", "table", "progress", "late")]
        deliver(spark, folders, parts[::-1] if turn else parts, files_per_batch, ["value"])
        assert as_set(spark.read.parquet(folders[1]).select("zone", "datetime", "value")) == expected


def test_replay_of_a_late_batch_keeps_its_border(spark, folders):
    for number, newest in enumerate((hour(500), hour(900), hour(2000))):
        spark.createDataFrame([(newest,)], "newest timestamp_ntz").write.json(f"{folders[0]}/batch={number}")
    assert ingest.late_border(spark, folders[0], 0, "7 days") is None
    assert ingest.late_border(spark, folders[0], 2, "7 days") == hour(900 - 168)


def test_only_touched_months_are_read(spark, folders):
    first = spark.createDataFrame(FIRST, LAYOUT)  # January and February
    ingest.merge_batch(first, folders[1], ["zone", "datetime"])
    new = ingest.partition_months(spark.createDataFrame([("a", hour(999), 7.0)], LAYOUT))
    merged = ingest.merged_months(new, folders[1], ["zone", "datetime"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "FileScan" in line]
    assert filters and all("PartitionFilters: [" in line and "2024-02" in line and "2024-01" not in line for line in filters)
    assert {r.month for r in merged.select("month").distinct().collect()} == {"2024-02"}


def test_rules_grow_with_accepted_batches(spark, folders, tmp_path):
    state = str(tmp_path / "state")
    batches = [[("a", hour(i), float(i % 50)) for i in range(100)], [("a", hour(200), 10.0)], [("a", hour(201), 99.0)], [("new", hour(202), 1.0)]]
    for batch in batches:
        spark.createDataFrame(batch, LAYOUT).coalesce(1).write.mode("append").parquet(folders[0])
    run(spark, folders, spark.createDataFrame([], LAYOUT).schema, state=state, value_sets=["zone"])
    assert spark.read.parquet(folders[1]).count() == 101
    assert {r.value for r in spark.read.parquet(folders[3]).collect()} == {99.0, 1.0}
