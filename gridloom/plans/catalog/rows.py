"""Projections, filters, scalar functions, sorts, unions and dedupe (P, F, T, U)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.functions import calendar, geo, text
from gridloom.operators import cleaning, combine, regions, report, scaling, windows
from gridloom.operators.ordered import cname, global_position
from gridloom.plans.catalog.base import (
    Tables, entry, r, rounded, rq, sql, stamp, stamp_q, timed,
)
from gridloom.session import scratch_path
from gridloom.sources import landed
from gridloom.sources.dimensions import MARKET_REGIONS

PATCHY_LIST = f'zone, {stamp_q("datetime")}, "tempF", "windspeedMiles", humidity, value'
COMPLETE = '"tempF" IS NOT NULL AND humidity IS NOT NULL AND value IS NOT NULL'
TWICE = "twice AS (SELECT * FROM patchy UNION ALL SELECT * FROM patchy WHERE datetime >= " \
    "(SELECT max(datetime) FROM patchy) - INTERVAL 7 DAY)"


def twice(t: Tables) -> DataFrame:
    """The patchy table with its last seven days delivered a second time."""
    newest = t.patchy.agg(F.max("datetime")).scalar()
    again = t.patchy.filter(F.col("datetime") >= newest - F.expr("INTERVAL 7 DAYS"))
    return t.patchy.unionByName(again)


@entry("p1_drop_null_rows", sql(f"SELECT {PATCHY_LIST} FROM patchy WHERE {COMPLETE}", "patchy"))
def _(t: Tables) -> DataFrame:
    return timed(cleaning.drop_incomplete(t.patchy))


@entry("p2_clean", sql(f"SELECT DISTINCT {PATCHY_LIST} FROM twice WHERE {COMPLETE}", "patchy", more=TWICE))
def _(t: Tables) -> DataFrame:
    return timed(cleaning.clean(twice(t)))


@entry("p3_drop_columns", sql(f'SELECT zone, {stamp_q("datetime")}, value FROM hourly', "hourly"))
def _(t: Tables) -> DataFrame:
    return timed(t.hourly.drop("tempF", "windspeedMiles", "humidity"))


@entry("p4_rename_period", f"SELECT event_id, {stamp_q('ts')}, value FROM events")
def _(t: Tables) -> DataFrame:
    period = t.events.select("event_id", F.col("ts").alias("period"), "value")
    return timed(period.withColumnRenamed("period", "datetime"))


@entry("p5_column_first", f"SELECT {stamp_q('ts', 'ts')}, event_id, user_id, event_type, value FROM events")
def _(t: Tables) -> DataFrame:
    return timed(cleaning.first_columns(t.events, "ts").drop("props"), "ts")


@entry("p6_constant_column", "SELECT event_id, 'COAS' AS zone FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id").withColumn("zone", F.lit("COAS"))


FEATURE_SQL = ",\n ".join(
    [f'CASE WHEN count("{c}") OVER w6 = 6 THEN avg("{c}") OVER w6 END AS "{c}_rolling_mean"' for c in schemas.ROLLED]
    + [f'CASE WHEN count("{c}") OVER w6 = 6 THEN stddev_samp("{c}") OVER w6 END AS "{c}_rolling_std"' for c in schemas.ROLLED]
    + [f'lag("{c}", {n}) OVER w AS "{c}_lag_{n}"' for n in schemas.LAGS for c in schemas.ROLLED]
)
MONTH_SQL = "round(sin(2 * pi() * month(datetime) / 12), 6) AS month_sin, " \
    "round(cos(2 * pi() * month(datetime) / 12), 6) AS month_cos"
# Cleaned raw rows with window features and cyclic month; the first six rows per zone are gone.
FEATURED = f"""featured AS (
 SELECT *, {MONTH_SQL} FROM (
  SELECT *, {FEATURE_SQL}, row_number() OVER w AS _place
  FROM (SELECT DISTINCT * FROM raw)
  WINDOW w AS (PARTITION BY zone ORDER BY datetime),
         w6 AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
 WHERE _place > 6)"""
FLOATS = [c for c in schemas.FINAL_COLUMNS if "rolling" in c or "month" in c or c == "precipMM"]


def final_list(wrap=None) -> str:
    """The 32 columns as a SQL list, measures rounded (after ``wrap``)."""
    cells = []
    for c in schemas.FINAL_COLUMNS:
        if c == "datetime":
            cells.append(stamp_q("datetime"))
        elif c in ("zone", "subba-name"):
            cells.append(f'"{c}"')
        else:
            cells.append(f"""{rq(wrap(c) if wrap else f'"{c}"')} AS "{c}\"""")
    return ", ".join(cells)


def shown(df: DataFrame) -> DataFrame:
    """Rounded measures and text time."""
    measures = [c for c in df.columns if c not in ("datetime", "zone", "subba-name")]
    shaped = rounded(df, measures)
    return timed(shaped) if "datetime" in df.columns else shaped


@entry("p7_select_final", sql(f"SELECT {final_list()} FROM featured", "raw", more=FEATURED))
def _(t: Tables) -> DataFrame:
    featured = windows.cyclic_month(windows.engineer_features(cleaning.clean(t.raw)))
    return shown(cleaning.select_final(featured))


MODEL_SQL = ", ".join(f"""{rq(f'"{c}"')} AS "{c}\"""" for c in [*schemas.MODEL_FEATURES, "value"]) + ', "subba-name"'


@entry("p8_model_projection", sql(f"SELECT {MODEL_SQL} FROM featured", "raw", more=FEATURED))
def _(t: Tables) -> DataFrame:
    featured = windows.cyclic_month(windows.engineer_features(cleaning.clean(t.raw)))
    return shown(cleaning.model_columns(featured))


@entry("p9_since_date", sql(
    f"""SELECT {MODEL_SQL} FROM featured WHERE datetime >= TIMESTAMP '2024-01-20 00:00:00'""",
    "raw", more=FEATURED))
def _(t: Tables) -> DataFrame:
    featured = windows.cyclic_month(windows.engineer_features(cleaning.clean(t.raw)))
    return shown(cleaning.model_columns(featured, since="2024-01-20 00:00:00"))


@entry("p10_text_range", sql(
    "SELECT zone, strftime(datetime, '%Y-%m-%dT%H') AS hour, value FROM hourly "
    "WHERE strftime(datetime, '%Y-%m-%dT%H') < '2024-01-15T23'", "hourly"))
def _(t: Tables) -> DataFrame:
    labelled = t.hourly.select("zone", calendar.hour_label(F.col("datetime")).alias("hour"), "value")
    return labelled.filter(F.col("hour") < "2024-01-15T23")


@entry("p11_equality_slice", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def _(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


LOW_ZONES = "low_zones AS (SELECT zone FROM hourly GROUP BY zone HAVING avg(humidity) < " \
    "(SELECT avg(humidity) FROM hourly))"


def low_zones(t: Tables) -> DataFrame:
    """Zones that are drier than the table's mean."""
    mean = t.hourly.agg(F.avg("humidity")).scalar()
    return t.hourly.groupBy("zone").agg(F.avg("humidity").alias("h")).filter(F.col("h") < mean).select("zone")


@entry("p12_not_in_groups", sql(
    f"SELECT {PATCHY_LIST} FROM hourly h WHERE NOT EXISTS (SELECT 1 FROM low_zones z WHERE z.zone = h.zone)",
    "hourly", more=LOW_ZONES))
def _(t: Tables) -> DataFrame:
    return timed(cleaning.not_in_groups(t.hourly, low_zones(t), "zone")).select(
        "zone", "datetime", "tempF", "windspeedMiles", "humidity", "value")


@entry("p13_in_list", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'error')")
def _(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type").isin("click", "view", "error")).select("event_id", "event_type")


@entry("p14_both_known", sql(
    f"""SELECT zone, {stamp_q("datetime")}, "tempF", value FROM patchy WHERE "tempF" IS NOT NULL AND value IS NOT NULL""",
    "patchy"))
def _(t: Tables) -> DataFrame:
    kept = t.patchy.filter(F.col("tempF").isNotNull() & F.col("value").isNotNull())
    return timed(kept.select("zone", "datetime", "tempF", "value"))


NUMERIC = [c for c in [*schemas.WEATHER_INTEGERS, *schemas.WEATHER_DOUBLES, "value"]]


@entry("p15_numeric_columns", sql(
    "SELECT " + ", ".join(f"""{rq(f'sum("{c}")', 2)} AS "{c}\"""" for c in NUMERIC) + " FROM raw", "raw"))
def _(t: Tables) -> DataFrame:
    picked = cleaning.numeric_columns(t.raw, schemas.NOT_SCALED)
    return t.raw.agg(*[r(F.sum(cname(c)), 2).alias(c) for c in picked])


@entry("p16_fill_zero", sql(
    f"""SELECT zone, {stamp_q("datetime")}, coalesce("tempF", 0) AS "tempF", "windspeedMiles",
    coalesce(humidity, 0) AS humidity, coalesce(value, 0) AS value FROM patchy""", "patchy"))
def _(t: Tables) -> DataFrame:
    return timed(cleaning.fill_zero(t.patchy))


@entry("p17_clip_negatives", sql(
    f"""SELECT zone, {stamp_q("datetime")}, greatest("WindChillF", 0) AS "WindChillF",
    greatest(value, 0) AS value, "WindChillC" FROM raw""", "raw"))
def _(t: Tables) -> DataFrame:
    clipped = cleaning.clip_negatives(t.raw)
    return timed(clipped.select("zone", "datetime", "WindChillF", "value", "WindChillC"))


@entry("p18_text_nan", sql(
    """SELECT event_id, nullif(CASE WHEN k < 10 THEN 'nan' ELSE event_type END, 'nan') AS kind FROM readings""",
    "readings"))
def _(t: Tables) -> DataFrame:
    marked = t.readings.select(
        "event_id", F.when(F.col("k") < 10, "nan").otherwise(F.col("event_type")).alias("kind"))
    return cleaning.text_nan_to_null(marked)


@entry("p19_number_or_zero", """SELECT l_orderkey, l_linenumber,
 coalesce(TRY_CAST(code AS DOUBLE), 0.0) AS amount,
 CAST(trunc(coalesce(TRY_CAST(code AS DOUBLE), 0.0)) AS BIGINT) AS whole
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS VARCHAR)
 ELSE l_returnflag END AS code FROM lineitem)""")
def _(t: Tables) -> DataFrame:
    code = F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("string")).otherwise(F.col("l_returnflag"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        cleaning.to_number_or_zero(code, integer=False).alias("amount"),
        cleaning.to_number_or_zero(code).alias("whole"))


@entry("p20_coerce_or_null", f"""SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS level,
 TRY_CAST(o_orderstatus AS DOUBLE) AS status,
 strftime(try_strptime(strftime(o_orderdate, '%Y-%m-%dT%H'), '%Y-%m-%dT%H'), '%Y-%m-%d %H:%M:%S') AS ordered,
 strftime(try_strptime(o_orderpriority, '%Y-%m-%dT%H'), '%Y-%m-%d %H:%M:%S') AS malformed FROM orders""")
def _(t: Tables) -> DataFrame:
    day = calendar.hour_label(F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey",
        cleaning.to_number_or_null(F.substring("o_orderpriority", 1, 1)).alias("level"),
        cleaning.to_number_or_null(F.col("o_orderstatus")).alias("status"),
        stamp(cleaning.to_hour_or_null(day), "ordered"),
        stamp(cleaning.to_hour_or_null(F.col("o_orderpriority")), "malformed"))


@entry("p21_features_only", sql('SELECT "tempF", "windspeedMiles", humidity FROM hourly', "hourly"))
def _(t: Tables) -> DataFrame:
    return cleaning.features_only(t.hourly)


PRICES = """prices AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS date,
 max(o_totalprice) AS "Close", count(*) AS "Volume" FROM orders GROUP BY 1, 2)"""
ITEMS = """items AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_orderpriority AS item,
 make_date(year(o_orderdate), 1, 1) AS period, max(o_totalprice) AS value FROM orders GROUP BY 1, 2, 3)"""


def prices(t: Tables) -> DataFrame:
    """Orders as a price history: customer = ticker."""
    return t.orders.groupBy(
        F.col("o_custkey").cast("string").alias("ticker"), F.to_date("o_orderdate").alias("date")
    ).agg(F.max("o_totalprice").alias("Close"), F.count(F.lit(1)).alias("Volume"))


def items(t: Tables) -> DataFrame:
    """Orders as balance-sheet cells: customer × priority × year."""
    return t.orders.groupBy(
        F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderpriority").alias("item"),
        F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("period"),
    ).agg(F.max("o_totalprice").alias("value"))


HISTORY = """history AS (SELECT ticker, strftime(date, '%Y-%m-%d') AS "Date", "Close", "Volume" FROM prices
 WHERE date >= (SELECT max(date) FROM prices) - INTERVAL 12 MONTH)"""
SHEET = """kept AS (SELECT ticker, period FROM (SELECT ticker, period, row_number() OVER
  (PARTITION BY ticker ORDER BY period DESC) AS rk FROM (SELECT DISTINCT ticker, period FROM items)) WHERE rk <= 3),
 cells AS (SELECT i.* FROM items i JOIN kept USING (ticker, period)),
 sheet AS (SELECT c.* FROM cells c JOIN (SELECT ticker, item, count(value) AS known FROM cells GROUP BY 1, 2)
  USING (ticker, item) JOIN (SELECT ticker, count(*) AS n FROM kept GROUP BY 1) USING (ticker) WHERE known = n)"""


@entry("p22_price_history", sql("SELECT * FROM history", more=f"{PRICES}, {HISTORY}"))
def _(t: Tables) -> DataFrame:
    return report.price_history(prices(t))


@entry("p23_balance_sheet", sql(
    "SELECT ticker, item, strftime(period, '%Y-%m-%d') AS period, value FROM sheet", more=f"{ITEMS}, {SHEET}"))
def _(t: Tables) -> DataFrame:
    sheet = report.balance_sheet(items(t))
    return sheet.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


# ---- scalar functions -------------------------------------------------------------------

@entry("f1_hour_of_text", """SELECT event_id, strftime(ts, '%H') AS hour FROM events""")
def _(t: Tables) -> DataFrame:
    time_text = (F.hour("ts") * 100).cast("string")
    return t.events.select("event_id", calendar.hour_of(time_text).alias("hour"))


@entry("f2_hour_timestamp", f"""SELECT event_id, strftime(ts, '%Y-%m-%dT%H') AS label,
 {stamp_q("date_trunc('hour', ts)")} FROM events""")
def _(t: Tables) -> DataFrame:
    label = calendar.hour_text(F.date_format("ts", "yyyy-MM-dd"), (F.hour("ts") * 100).cast("string"))
    return t.events.select("event_id", label.alias("label"), stamp(calendar.hour_timestamp(label)))


@entry("f4_split_coordinates", sql("SELECT c_custkey, lat, lon, lat || ',' || lon AS pair FROM places", "places"))
def _(t: Tables) -> DataFrame:
    pair = t.places.select("c_custkey", geo.pair_text(F.col("lat"), F.col("lon")).alias("pair"))
    return pair.select(
        "c_custkey", geo.lat_of(F.col("pair")).alias("lat"), geo.lon_of(F.col("pair")).alias("lon"), "pair")


REGION_ROWS = ",\n ".join(
    f"({i}, '{name}', {at.split(',')[0]}::DOUBLE, {at.split(',')[1]}::DOUBLE, "
    + "[" + ", ".join("'" + c + "'" for c in companies) + "])"
    for i, (name, at, companies) in enumerate(MARKET_REGIONS)
)
KM = "(2 * 6371.0 * atan2(sqrt(chord), sqrt(1 - chord)))"
NEAR = f"""regions(ordinal, region, rlat, rlon, companies) AS (VALUES {REGION_ROWS}),
 pairs AS (SELECT *, pow(sin(radians(rlat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(rlat))
  * pow(sin(radians(rlon - lon) / 2), 2) AS chord FROM places, regions),
 near AS (SELECT * FROM (SELECT *, {KM} AS km, row_number() OVER
  (PARTITION BY c_custkey ORDER BY {KM}, ordinal) AS rk FROM pairs) WHERE rk = 1)"""


@entry("f5_companies", sql(
    """SELECT c_custkey, region, split_part(entry, ':', 1) AS company,
    split_part(split_part(entry, ':', 2), '.', 1) AS ticker
    FROM (SELECT c_custkey, region, unnest(companies) AS entry FROM near)""", "places", more=NEAR))
def _(t: Tables) -> DataFrame:
    near = regions.with_region(t.places).select("c_custkey", "region", "companies")
    return regions.companies_of(near)


@entry("f6_safe_name", "SELECT p_partkey, regexp_replace(p_name || ' ' || p_brand, '[^A-Za-z0-9]', '_', 'g') AS safe FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.safe_name(F.concat_ws(" ", "p_name", "p_brand")).alias("safe"))


@entry("f7_first_token", "SELECT event_id, event_type AS token FROM events")
def _(t: Tables) -> DataFrame:
    run_name = F.concat_ws("_", "event_type", "user_id", "event_id")
    return t.events.select("event_id", text.first_token(run_name).alias("token"))


@entry("f8_last_token", "SELECT page_id, trim(split_part(url, ':', -1)) AS rest FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.last_token(F.col("url")).alias("rest"))


@entry("f9_row_text", """SELECT event_id, '"event_type": ' || event_type || ', "user_id": ' || user_id
 || ', "props": ' || props AS line FROM events""")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", text.row_text(["event_type", "user_id", "props"]).alias("line"))


@entry("f10_to_text", "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS line, l_returnflag FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string").alias("line"), "l_returnflag")


DAY_TEXT = """dated AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d')
 ELSE strftime(o_orderdate, '%d-%m-%Y') END AS day FROM orders)"""


@entry("f11_parse_day", sql(
    """SELECT o_orderkey, strftime(try_strptime(day, '%d-%m-%Y'), '%Y-%m-%d') AS iso,
    try_strptime(day, '%d-%m-%Y') IS NOT NULL AS valid FROM dated""", more=DAY_TEXT))
def _(t: Tables) -> DataFrame:
    day = F.when(
        F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    return t.orders.select(
        "o_orderkey", calendar.iso_day(day).alias("iso"), calendar.parse_day(day).isNotNull().alias("valid"))


SPANS = """spans AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z
 FROM orders GROUP BY 1)"""


def spans(t: Tables) -> DataFrame:
    """First and last order day per customer."""
    return t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z"))


def ranges(t: Tables, split) -> DataFrame:
    found = spans(t).select("o_custkey", F.inline(split(F.col("a"), F.col("z"))))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("start", "end")})


def chained(months: int) -> str:
    step = f"INTERVAL {months} MONTH"
    return sql(
        f"""SELECT o_custkey, strftime(s, '%Y-%m-%d') AS start,
        strftime(least(CAST(s + {step} - INTERVAL 1 DAY AS DATE), z), '%Y-%m-%d') AS "end" FROM chain""",
        more=f"""{SPANS}, chain AS (SELECT o_custkey, a AS s, z FROM spans UNION ALL
        SELECT o_custkey, CAST(s + {step} AS DATE), z FROM chain WHERE CAST(s + {step} AS DATE) <= z)""",
        recursive=True)


@entry("f12_split_months", chained(1))
def _(t: Tables) -> DataFrame:
    return ranges(t, calendar.split_months)


@entry("f13_split_years", sql(
    """SELECT o_custkey, strftime(greatest(a, make_date(y, 1, 1)), '%Y-%m-%d') AS start,
    strftime(least(z, make_date(y, 12, 31)), '%Y-%m-%d') AS "end"
    FROM (SELECT *, unnest(range(year(a), year(z) + 1)) AS y FROM spans)""", more=SPANS))
def _(t: Tables) -> DataFrame:
    return ranges(t, calendar.split_years)


@entry("f14_split_half_years", chained(6))
def _(t: Tables) -> DataFrame:
    return ranges(t, calendar.split_half_years)


@entry("f15_last_days", """SELECT DISTINCT strftime(o_orderdate - INTERVAL 1 DAY, '%d-%m-%Y') AS yesterday,
 strftime(o_orderdate, '%d-%m-%Y') AS today, strftime(o_orderdate - INTERVAL 6 DAY, '%d-%m-%Y') AS week_start FROM orders""")
def _(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    two, seven = calendar.last_days(day, 2), calendar.last_days(day, 7)
    return t.orders.select(
        two["start"].alias("yesterday"), two["end"].alias("today"), seven["start"].alias("week_start")).distinct()


@entry("f16_month", "SELECT l_orderkey, l_linenumber, CAST(month(l_shipdate) AS BIGINT) AS m FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.month("l_shipdate").cast("bigint").alias("m"))


CYCLE = "cycle AS (SELECT l_orderkey, l_linenumber, l_shipdate AS datetime FROM lineitem)"


@entry("f17_cyclic_month", sql(
    f"SELECT month_sin + 0.0 AS month_sin, month_cos + 0.0 AS month_cos, count(*) AS n FROM (SELECT {MONTH_SQL} FROM cycle) GROUP BY 1, 2",
    more=CYCLE))
def _(t: Tables) -> DataFrame:
    shipped = windows.cyclic_month(t.lineitem.select(F.col("l_shipdate").alias("datetime")))
    return shipped.groupBy(r("month_sin").alias("month_sin"), r("month_cos").alias("month_cos")).agg(
        F.count(F.lit(1)).alias("n"))


@entry("f18_shift_cyclic", sql(
    f"""SELECT l_orderkey, l_linenumber, {rq('(month_sin + 1) / 2')} AS month_sin, {rq('(month_cos + 1) / 2')} AS month_cos
    FROM (SELECT *, {MONTH_SQL} FROM cycle)""", more=CYCLE))
def _(t: Tables) -> DataFrame:
    shipped = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("datetime"))
    shifted = scaling.shift_cyclic(windows.cyclic_month(shipped)).drop("datetime")
    return rounded(shifted, ["month_sin", "month_cos"])


@entry("f19_descale", sql(
    f"""SELECT zone, {stamp_q("datetime")}, {rq('s * (hi - lo) + lo', 4)} AS restored, {rq('hi - s * (hi - lo)', 4)} AS swapped
    FROM (SELECT *, (value - lo) / (hi - lo) AS s FROM (SELECT zone, datetime, CAST(value AS DOUBLE) AS value,
    CAST(min(value) OVER () AS DOUBLE) AS lo, CAST(max(value) OVER () AS DOUBLE) AS hi FROM hourly))""", "hourly"))
def _(t: Tables) -> DataFrame:
    scaled = scaling.scale_min_max(t.hourly, columns=["value"])
    span = t.hourly.agg(F.struct(
        F.min("value").cast("double").alias("lo"), F.max("value").cast("double").alias("hi"))).scalar()
    return scaled.select(
        "zone", stamp("datetime"),
        r(scaling.descale(F.col("value"), span["lo"], span["hi"]), 4).alias("restored"),
        r(scaling.descale(F.col("value"), span["lo"], span["hi"], swapped=True), 4).alias("swapped"))


@entry("f20_haversine", sql(
    f"""SELECT c_custkey, {rq(KM, 3)} AS km FROM (SELECT c_custkey, pow(sin(radians(lat - 40.7128) / 2), 2)
    + cos(radians(40.7128)) * cos(radians(lat)) * pow(sin(radians(lon + 74.0060) / 2), 2) AS chord FROM places)""", "places"))
def _(t: Tables) -> DataFrame:
    away = geo.haversine_km(F.lit(40.7128), F.lit(-74.0060), F.col("lat"), F.col("lon"))
    return t.places.select("c_custkey", r(away, 3).alias("km"))


@entry("f21_epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", calendar.epoch_seconds(F.col("ts")).alias("seconds"))


@entry("f22_label_codes", "SELECT p_partkey, p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_code FROM part")
def _(t: Tables) -> DataFrame:
    dictionary = scaling.label_dictionary(t.part, "p_type")
    coded = scaling.encode_labels(t.part.select("p_partkey", "p_type"), "p_type", dictionary)
    return scaling.decode_labels(coded.drop("p_type"), "p_type", dictionary)


@entry("f23_category_codes", sql(
    """SELECT event_id, coalesce(code, -1) AS kind_code FROM (SELECT event_id, kind FROM marked) LEFT JOIN
    (SELECT kind, dense_rank() OVER (ORDER BY kind) - 1 AS code FROM (SELECT DISTINCT kind FROM marked WHERE kind IS NOT NULL)) USING (kind)""",
    "readings", more="marked AS (SELECT event_id, CASE WHEN k >= 10 THEN event_type END AS kind FROM readings)"))
def _(t: Tables) -> DataFrame:
    marked = t.readings.select("event_id", F.when(F.col("k") >= 10, F.col("event_type")).alias("kind"))
    dictionary = scaling.label_dictionary(marked, "kind")
    return scaling.encode_labels(marked, "kind", dictionary, unseen="mark").select("event_id", "kind_code")


@entry("f24_known_flag", sql(
    f"""SELECT zone, {stamp_q("datetime")}, CAST(value IS NOT NULL AS BIGINT) AS known FROM patchy""", "patchy"))
def _(t: Tables) -> DataFrame:
    return t.patchy.select("zone", stamp("datetime"), F.col("value").isNotNull().cast("bigint").alias("known"))


@entry("f25_round_four", sql("SELECT event_id, round(value / 7, 4) AS rounded FROM events"))
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.round(F.col("value") / 7, 4).alias("rounded"))


@entry("f26_first_place", sql(
    """SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN lat || ',' || lon END AS place FROM places""", "places"))
def _(t: Tables) -> DataFrame:
    result = F.struct(F.struct(F.col("lat"), F.col("lon").alias("lng")).alias("geometry"))
    found = F.when(F.col("c_mktsegment") != "BUILDING", F.array(result)).otherwise(F.array().cast(
        "array<struct<geometry:struct<lat:double,lng:double>>>"))
    answer = t.places.select("c_custkey", F.to_json(F.struct(found.alias("results"))).alias("answer"))
    return answer.select("c_custkey", landed.first_place(F.col("answer")).alias("place"))


@entry("f27_stamped_name", "SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS name FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", text.stamped_name(F.col("event_type"), F.col("ts")).alias("name"))


# ---- sorts and limits -------------------------------------------------------------------

@entry("t1_sort_time", f"SELECT event_id, {stamp_q('ts', 'ts')}, value FROM events ORDER BY events.ts, event_id")
def _(t: Tables) -> DataFrame:
    return t.events.orderBy("ts", "event_id").select("event_id", stamp("ts", "ts"), "value")


@entry("t2_sort_name_time", sql(
    f'SELECT "subba-name", {stamp_q("datetime")}, value FROM raw ORDER BY "subba-name", raw.datetime', "raw"))
def _(t: Tables) -> DataFrame:
    ordered = t.raw.orderBy(cname("subba-name"), "datetime")
    return ordered.select(cname("subba-name"), stamp("datetime"), "value")


@entry("t3_newest_rows", f"SELECT event_id, {stamp_q('ts', 'ts')}, value FROM events ORDER BY events.ts DESC, event_id LIMIT 10")
def _(t: Tables) -> DataFrame:
    newest = t.events.orderBy(F.desc("ts"), "event_id").limit(10)
    return newest.select("event_id", stamp("ts", "ts"), "value")


@entry("t7_nearest_region", sql("SELECT c_custkey, region FROM near", "places", more=NEAR))
def _(t: Tables) -> DataFrame:
    return regions.with_region(t.places).select("c_custkey", "region")


# ---- unions and dedupe ------------------------------------------------------------------

OLD_NEW = """old AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
 new AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01')"""


@entry("u1_append_new", sql(
    """SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_orderstatus FROM old UNION ALL
    SELECT o_orderkey, o_custkey, NULL::DOUBLE, o_orderstatus FROM new""", more=OLD_NEW))
def _(t: Tables) -> DataFrame:
    old = t.orders.filter("o_orderdate < timestamp_ntz'2000-01-01'").select("o_orderkey", "o_custkey", "o_totalprice")
    new = t.orders.filter("o_orderdate >= timestamp_ntz'1999-07-01'").select("o_orderkey", "o_custkey", "o_orderstatus")
    return combine.append_new(old, new)


@entry("u2_concat_zones", f"SELECT event_id, event_type AS zone, {stamp_q('ts', 'ts')}, value FROM events")
def _(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "zones")
    zoned = t.events.select("event_id", F.col("event_type").alias("zone"), "ts", "value")
    zoned.write.partitionBy("zone").parquet(folder)
    return timed(t.spark.read.parquet(folder), "ts")


@entry("u3_distinct_rows", "SELECT DISTINCT user_id, event_type, CAST(floor(value) AS BIGINT) AS level FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type", F.floor("value").alias("level")).dropDuplicates()


BOTH = "both_ AS (SELECT 0 AS src, *, value AS reading FROM hourly UNION ALL SELECT 1, *, -value FROM recent)"


@entry("u4_keep_first", sql(
    f"""SELECT zone, {stamp_q("datetime")}, reading FROM (SELECT *, row_number() OVER
    (PARTITION BY zone, datetime ORDER BY src) AS rk FROM both_) WHERE rk = 1""", "hourly", "recent", more=BOTH))
def _(t: Tables) -> DataFrame:
    old = t.hourly.select("zone", "datetime", F.col("value").alias("reading"))
    new = t.recent.select("zone", "datetime", (-F.col("value")).alias("reading"))
    return timed(combine.merge_history(old, new))


@entry("u4_keep_first_per_hour", sql(
    f"""SELECT {stamp_q("datetime")}, zone, value FROM (SELECT *, row_number() OVER
    (PARTITION BY datetime ORDER BY zone) AS rk FROM hourly) WHERE rk = 1""", "hourly"))
def _(t: Tables) -> DataFrame:
    first = combine.keep_first(t.hourly.select("datetime", "zone", "value"), ["datetime"], "zone")
    return timed(first)


@entry("u5_repeated_rows", sql(
    f"""SELECT {PATCHY_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY zone, datetime ORDER BY value) AS rk
    FROM twice) WHERE rk > 1""", "patchy", more=TWICE))
def _(t: Tables) -> DataFrame:
    return timed(combine.repeated_rows(twice(t)))


@entry("u6_mended_and_untouched", sql(
    """SELECT zone, value FROM hourly WHERE zone IN (SELECT zone FROM low_zones) UNION ALL
    SELECT zone, value FROM hourly WHERE zone NOT IN (SELECT zone FROM low_zones)""", "hourly", more=LOW_ZONES))
def _(t: Tables) -> DataFrame:
    low = low_zones(t)
    slim = t.hourly.select("zone", "value")
    return combine.append_new(cleaning.in_groups(slim, low, "zone"), cleaning.not_in_groups(slim, low, "zone"))


@entry("w18_row_numbers", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position FROM events")
def _(t: Tables) -> DataFrame:
    placed = global_position(t.events.select("event_id", "ts"), ["ts", "event_id"])
    return placed.select("event_id", "position")
