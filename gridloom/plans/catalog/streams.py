"""Streaming ingest, run over everything that has landed and read back (ST)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.quality import ColumnRule
from gridloom.plans.catalog.base import Tables, entry, rounded, rq, sql, stamp_q, timed
from gridloom.plans.catalog.rows import FEATURE_SQL
from gridloom.plans.catalog.series import FEATURE_NAMES
from gridloom.session import scratch_path
from gridloom.streaming import ingest

HOURLY_LIST = f'zone, {stamp_q("datetime")}, "tempF", "windspeedMiles", humidity, value'


def landed(t: Tables) -> str:
    """The hourly table and, once more, its last seven days, as two deliveries of files."""
    folder = scratch_path(t.spark, "landed")
    t.hourly.write.parquet(folder)
    t.recent.write.mode("append").parquet(folder)
    return folder


@entry("st1_incremental_ingest", sql(f"SELECT {HOURLY_LIST} FROM hourly", "hourly"))
def _(t: Tables) -> DataFrame:
    stream = ingest.landed_stream(t.spark, landed(t), t.hourly.schema)
    table = scratch_path(t.spark, "table")
    rules = [ColumnRule("zone", "string", False), ColumnRule("datetime", "timestamp_ntz", False)]
    ingest.ingest(stream, table, scratch_path(t.spark, "progress"), rules).awaitTermination()
    return timed(t.spark.read.parquet(table).select(*t.hourly.columns))


# Three deliveries, dealt by the clock hour: each reaches over the whole time span, so much of the later ones is late.
DELIVERIES = 3


def delivered(t: Tables) -> list[DataFrame]:
    """The hourly table in three deliveries by hour of day, the last one with the newest seven days again."""
    parts = [t.hourly.filter((F.hour("datetime") * 2 + F.dayofmonth("datetime")) % DELIVERIES == i) for i in range(DELIVERIES)]
    return [*parts[:-1], parts[-1].unionByName(t.recent)]


@entry("st2_overlap_dedupe", sql(f"SELECT {HOURLY_LIST} FROM hourly", "hourly"))
def _(t: Tables) -> DataFrame:
    folder, table, late, marks, progress = (scratch_path(t.spark, n) for n in ("landed", "deduped", "late", "marks", "progress"))
    for part in delivered(t):
        part.repartition(2).write.mode("append").parquet(folder)
    stream = ingest.landed_stream(t.spark, folder, t.hourly.schema, files_per_batch=2)
    ingest.merge_overlap(stream, table, late, marks, progress).awaitTermination()
    return timed(t.spark.read.parquet(table).select(*t.hourly.columns))


@entry("st2_late_rows", sql(
    """SELECT a.part AS batch, zone, count(*) AS late_rows FROM parted a
    JOIN (SELECT b.part, max(e.datetime) - INTERVAL 7 DAY AS border FROM (SELECT DISTINCT part FROM parted) b JOIN parted e ON e.part < b.part GROUP BY 1) m
    ON a.part = m.part AND a.datetime < m.border GROUP BY 1, 2""", "hourly", "recent",
    more=f"""parted AS (SELECT CAST((hour(datetime) * 2 + day(datetime)) % {DELIVERIES} AS BIGINT) AS part, * FROM hourly
    UNION ALL SELECT {DELIVERIES - 1}, * FROM recent)"""))
def _(t: Tables) -> DataFrame:
    folder, table, late, marks, progress = (scratch_path(t.spark, n) for n in ("landed", "deduped", "late", "marks", "progress"))
    for part in delivered(t):  # each delivery is a batch of its own, whatever its files
        part.write.mode("append").parquet(folder)
        stream = ingest.landed_stream(t.spark, folder, t.hourly.schema, files_per_batch=1_000_000)
        ingest.merge_overlap(stream, table, late, marks, progress).awaitTermination()
    rows = ingest.late_rows(t.spark, late, t.hourly.schema)
    return rows.groupBy("batch", "zone").agg(F.count(F.lit(1)).alias("late_rows"))


@entry("st1_incremental_features", sql(
    f"SELECT zone, {stamp_q('datetime')}, " + ", ".join(f"""{rq(f'"{c}"')} AS "{c}\"""" for c in FEATURE_NAMES)
    + f""" FROM (SELECT *, {FEATURE_SQL}, row_number() OVER w AS _place FROM hourly WINDOW w AS (PARTITION BY zone ORDER BY datetime),
    w6 AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)) WHERE _place > 6""", "hourly"))
def _(t: Tables) -> DataFrame:
    stream = ingest.landed_stream(t.spark, landed(t), t.hourly.schema)
    table, features = scratch_path(t.spark, "table"), scratch_path(t.spark, "features")
    ingest.ingest(stream, table, scratch_path(t.spark, "progress"), features=features).awaitTermination()
    return timed(rounded(t.spark.read.parquet(features).select("zone", "datetime", *FEATURE_NAMES), FEATURE_NAMES))
