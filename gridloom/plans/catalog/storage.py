"""Sources, sinks and landed payloads (S, K, F3): written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.functions import calendar
from gridloom.operators import bias, quality, regions, registry, scaling, splits
from gridloom.operators.ordered import cname
from gridloom.plans.catalog.base import (
    Tables, entry, r, rq, sql, stamp_q, timed,
)
from gridloom.plans.catalog.measures import EXTREMES, FRAME, RULED, frame
from gridloom.plans.catalog.rows import NEAR
from gridloom.plans.catalog.series import ORDERED
from gridloom.session import scratch_path
from gridloom.sources import dimensions, files, landed, snapshots

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
EVENTS_SQL = f"SELECT event_id, {stamp_q('ts', 'ts')}, user_id, event_type, value FROM events"
RAW_LIST = ", ".join(
    stamp_q("datetime") if f.name == "datetime" else f'"{f.name}"' for f in schemas.RAW_SCHEMA.fields)


def slim_events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts", "user_id", "event_type", "value")


@entry("s1_csv_scan", EVENTS_SQL)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-csv")
    files.write_csv(slim_events(t), path)
    return timed(files.read_csv(t.spark, path, EVENT_SCHEMA), "ts")


@entry("s3_csv_folders", EVENTS_SQL)
def _(t: Tables) -> DataFrame:
    old, new = (scratch_path(t.spark, "events-csv") for _ in range(2))
    files.write_csv(slim_events(t).filter("ts < timestamp_ntz'2024-01-16'"), old)
    files.write_csv(slim_events(t).filter("ts >= timestamp_ntz'2024-01-16'"), new)
    return timed(files.read_csv(t.spark, [old, new], EVENT_SCHEMA), "ts")


@entry("s4_json_records", sql(f"SELECT {RAW_LIST} FROM raw", "raw"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "raw-json")
    files.write_json_records(t.raw, path)
    return timed(files.read_json_records(t.spark, path, schemas.RAW_SCHEMA))


def demand_payload(t: Tables) -> DataFrame:
    """One demand answer per zone and day, as JSON text; the day after a zone's last one answers with total "0"."""
    row = F.struct(
        calendar.hour_label(F.col("datetime")).alias("period"), F.col("zone").alias("subba"),
        cname("subba-name"), F.lit("ERCO").alias("parent"), F.lit("Texas").alias("parent-name"),
        F.col("value").cast("string").alias("value"), cname("value-units"))
    days = t.raw.groupBy("zone", F.to_date("datetime").alias("day")).agg(
        F.sort_array(F.collect_list(row)).alias("data"))
    empty = days.groupBy("zone").agg(F.date_add(F.max("day"), 1).alias("day")).withColumn(
        "data", F.array().cast(days.schema["data"].dataType))
    total = F.size("data").cast("string")
    return days.unionByName(empty).select(
        "zone", F.to_json(F.struct(F.struct(total.alias("total"), "data").alias("response"))).alias("answer"))


def weather_payload(t: Tables) -> DataFrame:
    """One weather answer per zone and day, as JSON text; measures are text, hours ``0`` … ``2300``."""
    measures = [cname(c).cast("string").alias(c) for c in [*schemas.WEATHER_INTEGERS, *schemas.WEATHER_DOUBLES]]
    label = F.array(F.struct(F.lit("clear").alias("value")))
    hour = F.struct(
        (F.hour("datetime") * 100).cast("string").alias("time"), *measures,
        *[F.lit("0").alias(c) for c in ("tempC", "windspeedKmph", "winddirDegree", "winddir16Point")],
        label.alias("weatherIconUrl"), label.alias("weatherDesc"))
    days = t.raw.groupBy("zone", F.date_format("datetime", "yyyy-MM-dd").alias("date")).agg(
        F.collect_list(hour).alias("hourly"))
    weather = F.struct(F.array(F.struct("date", "hourly")).alias("weather"))
    return days.select("zone", F.to_json(F.struct(weather.alias("data"))).alias("answer"))


def parsed(payload: DataFrame, schema) -> DataFrame:
    return payload.select("zone", F.from_json("answer", schema).alias("_a")).select("zone", "_a.*")


@entry("s5_demand_payload", sql(
    """SELECT zone, strftime(datetime, '%Y-%m-%dT%H') AS datetime, "subba-name", CAST(value AS VARCHAR) AS value, "value-units"
    FROM raw""", "raw"))
def _(t: Tables) -> DataFrame:
    return landed.demand_hours(parsed(demand_payload(t), schemas.DEMAND_PAYLOAD), "zone")


@entry("s6_weather_payload", sql(
    "SELECT zone, strftime(datetime, '%Y-%m-%d') AS date, count(*) AS hours FROM raw GROUP BY 1, 2", "raw"))
def _(t: Tables) -> DataFrame:
    days = landed.weather_days(parsed(weather_payload(t), schemas.WEATHER_PAYLOAD), "zone")
    return days.select("zone", "date", F.size("hourly").cast("bigint").alias("hours"))


WEATHER_TEXT = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in schemas.WEATHER_INTEGERS)


@entry("f3_weather_hours", sql(
    f"SELECT zone, strftime(datetime, '%Y-%m-%dT%H') AS datetime, {WEATHER_TEXT} FROM raw", "raw"))
def _(t: Tables) -> DataFrame:
    days = landed.weather_days(parsed(weather_payload(t), schemas.WEATHER_PAYLOAD), "zone")
    return landed.weather_hours(days, "zone").drop(*schemas.WEATHER_DOUBLES)


@entry("s7_zone_dimension", sql(
    "SELECT c_mktsegment AS region, CAST(c_custkey AS VARCHAR) AS zone, lat, lon FROM places", "places"))
def _(t: Tables) -> DataFrame:
    at = F.create_map(F.col("c_custkey").cast("string"), F.array("lat", "lon"))
    texts = t.places.select(F.to_json(F.create_map("c_mktsegment", at)).alias("regions"))
    return dimensions.zones_from_json(texts, "regions")


@entry("s8_region_dimension", sql(
    """SELECT region, rlat || ',' || rlon AS coordinates, count(*) AS customers, CAST(max(len(companies)) AS BIGINT) AS companies
    FROM near GROUP BY 1, 2""", "places", more=NEAR))
def _(t: Tables) -> DataFrame:
    counted = regions.with_region(t.places).groupBy("region").agg(F.count(F.lit(1)).alias("customers"))
    dimension = dimensions.market_regions(t.spark)
    at = F.concat_ws(
        ",", *[F.split_part("coordinates", F.lit(","), F.lit(i)).cast("double").cast("string") for i in (1, 2)])
    return counted.join(dimension, "region").select(
        "region", at.alias("coordinates"), "customers", F.size("companies").cast("bigint").alias("companies"))


@entry("s9_min_max_file", sql(EXTREMES, "raw"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "min-max")
    dimensions.min_max_json(scaling.min_max_map(t.raw)).write.text(path)
    return dimensions.read_min_max(t.spark, path)


@entry("k7_min_max_json", sql(EXTREMES, "raw"))
def _(t: Tables) -> DataFrame:
    text = dimensions.min_max_json(scaling.min_max_map(t.raw))
    stored = F.from_json("value", "map<string, struct<min: double, max: double>>")
    return text.select(F.explode(stored).alias("column", "range")).select("column", "range.min", "range.max")


@entry("s10_versioned_read", sql(f"SELECT {RAW_LIST} FROM raw", "raw"))
def _(t: Tables) -> DataFrame:
    store = scratch_path(t.spark, "store")
    snapshots.publish(t.raw.filter("zone = 'view'"), store, "raw")
    snapshots.publish(t.raw, store, "raw")
    return timed(snapshots.read_version(t.spark, store))


@entry("k4_publish_snapshot", sql("SELECT 1::BIGINT AS version, 'hourly' AS name, count(*) AS rows FROM hourly", "hourly"))
def _(t: Tables) -> DataFrame:
    store = scratch_path(t.spark, "store")
    snapshots.publish(t.hourly, store, "hourly")
    return snapshots.manifest(t.spark, store).select(F.col("version").cast("bigint"), "name", "rows")


@entry("k5_retention", sql("SELECT v AS version, 'hourly' AS name, count(*) AS rows FROM hourly, (SELECT unnest([2, 3]) AS v) GROUP BY 1", "hourly"))
def _(t: Tables) -> DataFrame:
    store = scratch_path(t.spark, "store")
    for part in (t.hourly.filter("zone = 'view'"), t.hourly, t.hourly):
        snapshots.publish(part, store, "hourly")
    snapshots.retain(t.spark, store, 2)
    return snapshots.manifest(t.spark, store).select("version", "name", "rows")


RUNS = """scored AS (SELECT *, (value + guess) / 2.0::DOUBLE AS blend, CAST(min(value) OVER () AS DOUBLE) AS lo,
  CAST(max(value) OVER () AS DOUBLE) AS hi FROM predicted),
 errors AS (SELECT zone, CAST(day(datetime) AS BIGINT) AS version, (value - lo) / (hi - lo) AS y,
  (value - blend) / (hi - lo) AS e FROM scored),
 runs AS (SELECT zone || '_' || version AS run_id, zone AS name, version, avg(e * e) AS "MSE", avg(abs(e)) AS "MAE",
  1 - sum(e * e) / nullif(var_pop(y) * count(*), 0) AS "R2" FROM errors GROUP BY zone, version)"""
VERSIONS = """versions AS (SELECT name, version, CASE WHEN version = newest - 2 THEN 'Production'
  WHEN version < newest - 2 THEN 'Archived' ELSE 'None' END AS stage, run_id, "R2"
  FROM (SELECT *, max(version) OVER (PARTITION BY name) AS newest FROM runs))"""


def runs(t: Tables) -> DataFrame:
    """One model run per zone and day: a blend predictor scored on that day's scaled value."""
    span = t.predicted.agg(F.struct(F.min("value").cast("double").alias("lo"), F.max("value").cast("double").alias("hi"))).scalar()
    width = span["hi"] - span["lo"]
    blend = (F.col("value") + F.col("guess")) / F.lit(2.0)
    scored = t.predicted.select(
        "zone", F.dayofmonth("datetime").cast("bigint").alias("version"),
        ((F.col("value") - span["lo"]) / width).alias("y"), ((F.col("value") - blend) / width).alias("e"))
    square = F.col("e") * F.col("e")
    found = scored.groupBy("zone", "version").agg(
        F.avg(square).alias("MSE"), F.avg(F.abs("e")).alias("MAE"),
        (F.lit(1.0) - F.try_divide(F.sum(square), F.var_pop("y") * F.count(F.lit(1)))).alias("R2"))
    run_id = F.concat_ws("_", "zone", F.col("version").cast("string"))
    metrics = F.map_from_arrays(F.array(F.lit("R2"), F.lit("MSE"), F.lit("MAE")), F.array("R2", "MSE", "MAE"))
    return found.select(
        run_id.alias("run_id"), run_id.alias("run_name"), metrics.alias("metrics"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("start_ts"))


def versions(t: Tables) -> DataFrame:
    """Each day's run as a version: the third newest is in production, older ones are archived."""
    listed = runs(t).select(
        F.substring_index("run_id", "_", 1).alias("name"),
        F.substring_index("run_id", "_", -1).cast("bigint").alias("version"), "run_id")
    newest = listed.groupBy("name").agg(F.max("version").alias("_newest"))
    behind = F.col("_newest") - F.col("version")
    stage = F.when(behind == 2, "Production").when(behind > 2, "Archived").otherwise("None")
    return listed.join(newest, "name").select("name", "version", stage.alias("stage"), "run_id")


@entry("s12_list_models", sql(
    """SELECT name, count(*) AS versions, max(version) AS latest, max(version) FILTER (stage = 'Production') AS production
    FROM versions GROUP BY 1""", "predicted", more=f"{RUNS}, {VERSIONS}"))
def _(t: Tables) -> DataFrame:
    return registry.list_models(versions(t))


TEST_SPLIT = f"""SELECT event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type {ORDERED}) AS rn,
 count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE """


def saved_splits(t: Tables) -> str:
    path = scratch_path(t.spark, "splits")
    slim = t.events.select("event_id", "event_type", "value").withColumn("Unnamed: 0", F.col("event_id"))
    files.write_splits(splits.stratified_split(slim, ["event_type"], "event_id"), path)
    return path


@entry("s13_saved_split", TEST_SPLIT + "rn <= (n * 200) // 1000")
def _(t: Tables) -> DataFrame:
    return files.read_split(t.spark, saved_splits(t), "test")


@entry("s14_trainer_input", TEST_SPLIT + "rn > (n * 200) // 1000 + (n * 100) // 1000")
def _(t: Tables) -> DataFrame:
    return files.read_split(t.spark, saved_splits(t), "train")


@entry("k8_save_splits", f"""SELECT split, count(*) AS rows FROM (SELECT CASE WHEN rn <= (n * 200) // 1000 THEN 'test'
 WHEN rn <= (n * 200) // 1000 + (n * 100) // 1000 THEN 'validation' ELSE 'train' END AS split FROM (SELECT
 row_number() OVER (PARTITION BY event_type {ORDERED}) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events)) GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return t.spark.read.parquet(saved_splits(t)).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@entry("k1_csv_write", sql(
    """SELECT zone, strftime(datetime, '%Y-%m-%dT%H') AS datetime, CAST(value AS VARCHAR) AS value FROM hourly""", "hourly"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "hourly-csv")
    files.write_csv(t.hourly.select("zone", "datetime", "value"), path, hour_columns=["datetime"])
    return files.read_csv(t.spark, path, "zone string, datetime string, value string")


@entry("k2_csv_append", EVENTS_SQL)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-csv")
    for kind in ("event_type IN ('click', 'view')", "event_type NOT IN ('click', 'view')"):
        files.write_csv(slim_events(t).filter(kind), path, mode="append")
    return timed(files.read_csv(t.spark, path, EVENT_SCHEMA), "ts")


@entry("k3_json_column", sql(f"""SELECT zone, {stamp_q("datetime")}, value FROM hourly""", "hourly"))
def _(t: Tables) -> DataFrame:
    records = t.hourly.groupBy("zone", F.to_date("datetime").alias("day")).agg(
        F.to_json(F.collect_list(F.struct("zone", "datetime", "value"))).alias("records"))
    rows = files.json_records(records, "records", "struct<zone: string, datetime: timestamp_ntz, value: bigint>")
    return timed(rows)


@entry("k6_schema_file", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) FILTER ("{c}" IS NULL) > 0 AS nullable, """
    + (f'CAST(min("{c}") AS DOUBLE) AS min, CAST(max("{c}") AS DOUBLE) AS max' if kind == "bigint" else "NULL::DOUBLE AS min, NULL::DOUBLE AS max")
    + " FROM patchy" for c, kind in RULED.items()), "patchy"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "schema")
    quality.save_rules(t.spark, quality.infer_rules(t.patchy), path)
    rows = [(x.column, x.type, x.nullable, x.min, x.max) for x in quality.load_rules(t.spark, path)]
    return t.spark.createDataFrame(rows, "column string, type string, nullable boolean, min double, max double")


@entry("k9_demand_export", sql(
    """SELECT strftime(datetime, '%Y-%m-%dT%H') AS period, zone AS subba, "subba-name", 'ERCO' AS parent, 'Texas' AS "parent-name",
    CAST(value AS VARCHAR) AS value, "value-units" FROM raw""", "raw"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "demand-csv")
    files.write_csv(landed.demand_export(parsed(demand_payload(t), schemas.DEMAND_PAYLOAD)), path)
    return files.read_csv(t.spark, path, schemas.DEMAND_ROW)


@entry("k10_findings_report", sql(
    f"""SELECT count(*) > 0 AS bias_detected, CAST(list(zone ORDER BY zone) AS VARCHAR) AS affected, {rq('max(o)', 4)} AS overall_mae
    FROM (SELECT *, (SELECT mae FROM frame WHERE scope = 'overall') AS o FROM frame WHERE scope = 'group')
    WHERE abs(mae - o) > 0.01::DOUBLE * o""", "predicted", more=FRAME))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "report")
    found = bias.biased_groups(frame(t), "mae", 0.01).agg(
        (F.count(F.lit(1)) > 0).alias("bias_detected"),
        F.sort_array(F.collect_list("zone")).alias("affected_groups"),
        F.round(F.max("overall"), 4).alias("overall_mae"))
    files.write_report(found, path)
    layout = "bias_detected boolean, affected_groups array<string>, overall_mae double"
    report = files.read_report(t.spark, path, layout)
    shown = F.concat(F.lit("["), F.concat_ws(", ", "affected_groups"), F.lit("]"))
    return report.select("bias_detected", shown.alias("affected"), r("overall_mae", 4).alias("overall_mae"))


@entry("k12_metric_frames", sql(f"SELECT 'before' AS run, zone, scope, {rq('mae', 4)} AS mae, rows FROM frame", "predicted", more=FRAME))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "frames")
    frame(t).withColumn("run", F.lit("before")).write.partitionBy("run").parquet(path)
    return t.spark.read.parquet(path).select("run", "zone", "scope", r("mae", 4).alias("mae"), "rows")
