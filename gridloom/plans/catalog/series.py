"""Joins, windows, splits and resampling (J, W, R)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators import bias, cleaning, combine, drift, sampling, scaling, splits, vectors, windows
from gridloom.plans import jobs
from gridloom.plans.catalog.base import (
    Tables, entry, r, rounded, rq, seeded_q, sql, stamp_q, timed,
)
from gridloom.plans.catalog.rows import FEATURED, NEAR

HOURLY_LIST = f'zone, {stamp_q("datetime")}, "tempF", "windspeedMiles", humidity, value'

# ---- joins ------------------------------------------------------------------------------

@entry("j1_weather_demand", sql(
    f"""SELECT w.zone, {stamp_q("w.datetime")}, w."tempF", w.humidity, d.value
    FROM (SELECT * FROM hourly WHERE "windspeedMiles" > 1) w JOIN (SELECT * FROM hourly WHERE humidity >= 20) d
    ON w.zone = d.zone AND w.datetime = d.datetime""", "hourly"))
def _(t: Tables) -> DataFrame:
    weather = t.hourly.filter("windspeedMiles > 1").select("zone", "datetime", "tempF", "humidity")
    demand = t.hourly.filter("humidity >= 20").select("zone", "datetime", "value")
    return timed(combine.join_hourly(weather, demand))


GRID = """grid AS (SELECT zone, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime
 FROM (SELECT DISTINCT zone FROM {0}), (SELECT min(datetime) AS lo, max(datetime) AS hi FROM {0})),
 gridded AS (SELECT g.zone, g.datetime, h."tempF", h."windspeedMiles", h.humidity, h.value
 FROM grid g LEFT JOIN {0} h ON g.zone = h.zone AND g.datetime = h.datetime)"""


@entry("j2_hourly_grid", sql(f"SELECT {HOURLY_LIST} FROM gridded", "hourly", more=GRID.format("hourly")))
def _(t: Tables) -> DataFrame:
    return timed(combine.reindex(t.hourly, ["zone"]))


DAILY = """daily AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, CAST(sum(cents) AS BIGINT) AS cents,
 CAST(max(k) AS BIGINT) AS k FROM readings GROUP BY 1, 2),
 days AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS day
 FROM (SELECT DISTINCT user_id FROM daily), (SELECT min(day) AS lo, max(day) AS hi FROM daily)),
 full_days AS (SELECT user_id, day, cents, k FROM days LEFT JOIN daily USING (user_id, day))"""


def daily(t: Tables) -> DataFrame:
    """Events per user and day: most users miss some days."""
    return t.readings.groupBy(
        "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    ).agg(F.sum("cents").alias("cents"), F.max("k").alias("k"))


@entry("j3_daily_grid", sql(f"SELECT user_id, {stamp_q('day', 'day')}, cents, k FROM full_days", "readings", more=DAILY))
def _(t: Tables) -> DataFrame:
    return timed(combine.reindex(daily(t), ["user_id"], "day", 86400), "day")


@entry("j4_without_rows", sql(
    """SELECT event_id, value FROM events WHERE event_id NOT IN
    (SELECT event_id FROM readings WHERE event_type = 'purchase' AND k < 50)""", "readings"))
def _(t: Tables) -> DataFrame:
    removed = t.readings.filter("event_type = 'purchase' AND k < 50")
    return combine.without_rows(t.events, removed, ["event_id"]).select("event_id", "value")


@entry("j5_in_groups", sql(
    """SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM readings GROUP BY 1 HAVING avg(k) > 50)""", "readings"))
def _(t: Tables) -> DataFrame:
    busy = t.readings.groupBy("user_id").agg(F.avg("k").alias("k")).filter("k > 50")
    return cleaning.in_groups(t.events, busy, "user_id").select("event_id")


@entry("j6_lookup_by_key", sql(
    "SELECT r.event_id, r.k, e.event_type, e.user_id FROM readings r LEFT JOIN events e USING (event_id) WHERE r.k >= 80", "readings"))
def _(t: Tables) -> DataFrame:
    rows = t.readings.filter("k >= 80").select("event_id", "k")
    return cleaning.lookup_by_key(rows, t.events, ["event_id"], ["event_type", "user_id"])


SCALED = ["tempF", "windspeedMiles", "humidity", "value"]


def scaled_list(over: str) -> str:
    cells = [
        rq(f'(CAST("{c}" AS DOUBLE) - min("{c}") OVER ({over})) / nullif(max("{c}") OVER ({over}) - min("{c}") OVER ({over}), 0)', 9)
        + f' AS "{c}"' for c in SCALED]
    return f'zone, {stamp_q("datetime")}, ' + ", ".join(cells)


@entry("j7_min_max_lookup", sql(f"SELECT {scaled_list('')} FROM hourly", "hourly"))
def _(t: Tables) -> DataFrame:
    bounds = scaling.min_max_map(t.hourly, SCALED)
    return timed(rounded(scaling.scale_with_table(t.hourly, bounds, SCALED), SCALED, 9))


@entry("j8_nearest_region", sql(f"SELECT c_custkey, region, {rq('km', 3)} AS km FROM near", "places", more=NEAR))
def _(t: Tables) -> DataFrame:
    from gridloom.operators.regions import with_region

    return with_region(t.places).select("c_custkey", "region", r("km", 3).alias("km"))


MEANS = """means AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
 FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2) GROUP BY 1)"""


@entry("j9_top_k_vectors", sql(
    f"""SELECT query, match, {rq('similarity')} AS similarity, rank FROM (SELECT *, row_number() OVER
    (PARTITION BY query ORDER BY similarity DESC, match) AS rank FROM (SELECT CAST(m.label AS BIGINT) AS query,
    e.vec_id AS match, list_cosine_similarity(m.v, CAST(e.embedding AS DOUBLE[])) AS similarity FROM means m, embeddings e))
    WHERE rank <= 3""", more=MEANS))
def _(t: Tables) -> DataFrame:
    questions = vectors.mean_vectors(t.embeddings, "label")
    top = vectors.top_k_similar(t.embeddings, questions, 3)
    return top.select("query", "match", r("similarity").alias("similarity"), F.col("rank").cast("bigint"))


@entry("t8_most_similar", sql(
    f"""SELECT match, {rq('similarity')} AS similarity FROM (SELECT vec_id AS match,
    list_cosine_similarity(v, CAST(embedding AS DOUBLE[])) AS similarity FROM embeddings,
    (SELECT list(x ORDER BY i) AS v FROM (SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS x
     FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1)))
    ORDER BY similarity DESC, match LIMIT 3"""))
def _(t: Tables) -> DataFrame:
    everything = t.embeddings.withColumn("all", F.lit(0))
    top = vectors.top_k_similar(t.embeddings, vectors.mean_vectors(everything, "all"), 3)
    return top.select("match", r("similarity").alias("similarity"))


@entry("j10_tagged_samples", sql(
    f"""SELECT feature, side, count(*) AS n, {rq('sum(v)', 2)} AS total FROM (
    SELECT 'value' AS feature, value AS v, CAST(ts >= TIMESTAMP '2024-01-16' AS INTEGER) AS side FROM readings UNION ALL
    SELECT 'k', k, CAST(ts >= TIMESTAMP '2024-01-16' AS INTEGER) FROM readings) GROUP BY 1, 2""", "readings"))
def _(t: Tables) -> DataFrame:
    side = drift.side_of("ts", F.expr("timestamp_ntz'2024-01-16 00:00:00'"))
    long = drift.long_rows(t.readings, side, ["value", "k"])
    return long.groupBy("feature", "side").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value"), 2).alias("total"))


# ---- windows ----------------------------------------------------------------------------

W6 = "WINDOW w6 AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"


def rolling_sql(what: str, call: str) -> str:
    cells = [
        rq(f'CASE WHEN count("{c}") OVER w6 = 6 THEN {call}("{c}") OVER w6 END') + f' AS "{c}_rolling_{what}"'
        for c in schemas.ROLLED]
    return sql(f"SELECT zone, {stamp_q('datetime')}, " + ", ".join(cells) + f" FROM hourly {W6}", "hourly")


@entry("w1_rolling_mean", rolling_sql("mean", "avg"))
def _(t: Tables) -> DataFrame:
    names = [f"{c}_rolling_mean" for c in schemas.ROLLED]
    return timed(rounded(windows.rolling(t.hourly, "mean").select("zone", "datetime", *names), names))


@entry("w2_rolling_std", rolling_sql("std", "stddev_samp"))
def _(t: Tables) -> DataFrame:
    names = [f"{c}_rolling_std" for c in schemas.ROLLED]
    return timed(rounded(windows.rolling(t.hourly, "std", unit="day").select("zone", "datetime", *names), names))


LAG_NAMES = [f"{c}_lag_{n}" for n in schemas.LAGS for c in schemas.ROLLED]


@entry("w3_lags", sql(
    f"SELECT zone, {stamp_q('datetime')}, " + ", ".join(
        f'lag("{c}", {n}) OVER w AS "{c}_lag_{n}"' for n in schemas.LAGS for c in schemas.ROLLED)
    + " FROM hourly WINDOW w AS (PARTITION BY zone ORDER BY datetime)", "hourly"))
def _(t: Tables) -> DataFrame:
    return timed(windows.lagged(t.hourly, unit="day").select("zone", "datetime", *LAG_NAMES))


FEATURE_NAMES = [f"{c}_rolling_{w}" for w in ("mean", "std") for c in schemas.ROLLED] + LAG_NAMES


@entry("w4_feature_block", sql(
    f"SELECT zone, {stamp_q('datetime')}, " + ", ".join(f"""{rq(f'"{c}"')} AS "{c}\"""" for c in FEATURE_NAMES)
    + " FROM featured", "raw", more=FEATURED))
def _(t: Tables) -> DataFrame:
    featured = windows.engineer_features(cleaning.clean(t.raw))
    return timed(rounded(featured.select("zone", "datetime", *FEATURE_NAMES), FEATURE_NAMES))


UP = "(PARTITION BY zone ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
DOWN = "(PARTITION BY zone ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
FILLED = ["tempF", "windspeedMiles", "humidity", "value"]


def filled_list(forward: bool, backward: bool) -> str:
    cells = []
    for c in FILLED:
        steps = []
        if forward:
            steps.append(f'last_value("{c}" IGNORE NULLS) OVER {UP}')
        if backward:
            steps.append(f'first_value("{c}" IGNORE NULLS) OVER {DOWN}')
        cells.append(f'coalesce({", ".join(steps)}) AS "{c}"')
    return f"zone, datetime, {', '.join(cells)}"


def filled_sql(forward: bool, backward: bool) -> str:
    inner = f"(SELECT {filled_list(forward, backward)} FROM gridded)"
    return sql(f"SELECT {HOURLY_LIST} FROM {inner}", "patchy", more=GRID.format("patchy"))


def filled(t: Tables, forward: bool, backward: bool, unit: str) -> DataFrame:
    grid = combine.reindex(t.patchy, ["zone"])
    return timed(windows.fill_gaps(grid, FILLED, forward=forward, backward=backward, unit=unit))


@entry("w5_forward_fill", filled_sql(True, False))
def _(t: Tables) -> DataFrame:
    return filled(t, True, False, "day")


@entry("w6_backward_fill", filled_sql(False, True))
def _(t: Tables) -> DataFrame:
    return filled(t, False, True, "day")


@entry("w7_fill_both_ways", filled_sql(True, True))
def _(t: Tables) -> DataFrame:
    return filled(t, True, True, "month")


CHUNKS = """chunks AS (SELECT *, (row_number() OVER (ORDER BY datetime, zone) - 1)
 // greatest(1, (SELECT count(*) FROM {0}) // 100) AS chunk FROM {0})"""


@entry("w8_row_chunks", sql(f"SELECT zone, {stamp_q('datetime')}, chunk FROM chunks", "hourly", more=CHUNKS.format("hourly")))
def _(t: Tables) -> DataFrame:
    return timed(jobs.chunk_rows(t.hourly).select("zone", "datetime", "chunk"))


NEAR3 = "(PARTITION BY user_id ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
IMPUTED = f"""imputed AS (SELECT user_id, day, coalesce(CAST(cents AS DOUBLE), avg(cents) OVER {NEAR3}) AS cents,
 coalesce(CAST(k AS DOUBLE), avg(k) OVER {NEAR3}) AS k FROM full_days)"""


@entry("w9_rolling_imputation", sql(
    f"SELECT user_id, {stamp_q('day', 'day')}, {rq('cents')} AS cents, {rq('k')} AS k FROM imputed",
    "readings", more=f"{DAILY}, {IMPUTED}"))
def _(t: Tables) -> DataFrame:
    grid = combine.reindex(daily(t), ["user_id"], "day", 86400)
    imputed = windows.impute_rolling_mean(grid, ["cents", "k"], ["user_id"], "day", unit="month")
    return timed(rounded(imputed, ["cents", "k"]), "day")


@entry("w10_min_max_by_zone", sql(f"SELECT {scaled_list('PARTITION BY zone')} FROM hourly", "hourly"))
def _(t: Tables) -> DataFrame:
    return timed(rounded(scaling.scale_min_max(t.hourly, ["zone"]), SCALED, 9))


@entry("w10_min_max_global", sql(f"SELECT {scaled_list('')} FROM hourly", "hourly"))
def _(t: Tables) -> DataFrame:
    return timed(rounded(scaling.scale_min_max(t.hourly), SCALED, 9))


@entry("w10_min_max_by_chunk", sql(f"SELECT chunk, {scaled_list('PARTITION BY chunk')} FROM chunks", "hourly", more=CHUNKS.format("hourly")))
def _(t: Tables) -> DataFrame:
    chunked = jobs.chunk_rows(t.hourly)
    return timed(rounded(scaling.scale_min_max(chunked, ["chunk"], SCALED), SCALED, 9))


STORED = {"tempF": (0.0, 20000.0), "windspeedMiles": (0.0, 60.0), "humidity": (0.0, 100.0), "value": (0.0, 400000.0)}


@entry("w11_min_max_stored", sql(
    f"SELECT zone, {stamp_q('datetime')}, " + ", ".join(
        rq(f'("{c}" - {lo}::DOUBLE) / ({hi}::DOUBLE - {lo}::DOUBLE)', 9) + f' AS "{c}"' for c, (lo, hi) in STORED.items())
    + " FROM hourly", "hourly"))
def _(t: Tables) -> DataFrame:
    return timed(rounded(scaling.scale_with_map(t.hourly, STORED), SCALED, 9))


@entry("w12_last_rows", sql(
    f"""SELECT {HOURLY_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY datetime DESC) AS rk
    FROM hourly) WHERE rk <= 7""", "hourly"))
def _(t: Tables) -> DataFrame:
    return timed(windows.last_rows(t.hourly))


@entry("w13_chronological_split", sql(
    f"""SELECT zone, {stamp_q("datetime")}, CASE WHEN rn <= (n * 800) // 1000 THEN 'train' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY datetime) AS rn, count(*) OVER (PARTITION BY zone) AS n
    FROM hourly)""", "hourly"))
def _(t: Tables) -> DataFrame:
    return timed(splits.chronological_split(t.hourly.select("zone", "datetime"), unit="day"))


ORDERED = f"ORDER BY {seeded_q('event_id')}, event_id"


def split_sql(partition: str, validation: int) -> str:
    return f"""SELECT event_id, event_type, CASE WHEN rn <= (n * 200) // 1000 THEN 'test'
 WHEN rn <= (n * 200) // 1000 + (n * {validation}) // 1000 THEN 'validation' ELSE 'train' END AS split
FROM (SELECT event_id, event_type, row_number() OVER ({partition} {ORDERED}) AS rn, count(*) OVER ({partition}) AS n FROM events)"""


@entry("w14_stratified_split", split_sql("PARTITION BY event_type", 100))
def _(t: Tables) -> DataFrame:
    return splits.stratified_split(t.events.select("event_id", "event_type"), ["event_type"], "event_id")


@entry("w15_random_split", split_sql("", 0))
def _(t: Tables) -> DataFrame:
    return splits.random_split(t.events.select("event_id", "event_type"), "event_id")


@entry("w16_contiguous_folds", """SELECT event_id, CAST(CASE WHEN rn <= extra * (base + 1) THEN (rn - 1) // (base + 1)
 ELSE extra + (rn - 1 - extra * (base + 1)) // base END AS BIGINT) AS fold FROM (SELECT event_id,
 row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () // 5 AS base, count(*) OVER () % 5 AS extra FROM events)""")
def _(t: Tables) -> DataFrame:
    folded = splits.contiguous_folds(t.events.select("event_id", "ts"), 5, ["ts", "event_id"])
    return folded.select("event_id", F.col("fold").cast("bigint"))


@entry("w16_hash_folds", f"SELECT event_id, CAST({seeded_q('event_id')} // {2 ** 60 // 5 + 1} AS BIGINT) AS fold FROM events")
def _(t: Tables) -> DataFrame:
    return splits.hash_folds(t.events.select("event_id"), 5, "event_id").withColumn("fold", F.col("fold").cast("bigint"))


# ---- rebalancing ------------------------------------------------------------------------

RATES = """rates AS (SELECT zone, avg(CASE WHEN value IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) AS rate FROM patchy GROUP BY 1),
 flagged AS (SELECT zone FROM rates WHERE abs(rate - (SELECT avg(CASE WHEN value IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END)
  FROM patchy)) > 0.05)"""


@entry("r1_fill_biased_groups", sql(
    f"""SELECT {HOURLY_LIST} FROM (SELECT {filled_list(True, True)} FROM gridded WHERE zone IN (SELECT zone FROM flagged)
    UNION ALL SELECT zone, datetime, "tempF", "windspeedMiles", humidity, value FROM patchy
    WHERE zone NOT IN (SELECT zone FROM flagged))""", "patchy", more=f"{RATES}, {GRID.format('patchy')}"))
def _(t: Tables) -> DataFrame:
    return timed(bias.fill_biased_groups(combine.require_unique(t.patchy, ["zone", "datetime"]), "value", "zone"))


@entry("r2_impute_and_resample", sql(
    f"""SELECT user_id, draw, {stamp_q('day', 'day')}, {rq('cents')} AS cents, {rq('k')} AS k FROM
    (SELECT user_id, draw, {seeded_q('user_id', 'draw')} % n + 1 AS pos FROM (SELECT user_id, n, unnest(range(wanted)) AS draw FROM
      (SELECT user_id, count(*) AS n FROM full_days GROUP BY 1),
      (SELECT max(n) AS wanted FROM (SELECT count(*) AS n FROM daily GROUP BY user_id))))
    JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS pos FROM imputed) USING (user_id, pos)""",
    "readings", more=f"{DAILY}, {IMPUTED}"))
def _(t: Tables) -> DataFrame:
    sampled = sampling.impute_and_resample(daily(t), "user_id", "day", ["cents", "k"])
    return timed(rounded(sampled, ["cents", "k"]), "day")


PLACED = f"""placed AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type {ORDERED}) AS pos,
 count(*) OVER (PARTITION BY event_type) AS n FROM events),
 sizes AS (SELECT DISTINCT event_type, n, max(n) OVER () AS most FROM placed)"""


@entry("r3_resample_to_largest", sql(
    f"""SELECT draw, event_id, event_type, value FROM (SELECT event_type, draw, {seeded_q('event_type', 'draw')} % n + 1 AS pos
    FROM (SELECT event_type, n, unnest(range(most)) AS draw FROM sizes)) JOIN placed USING (event_type, pos)""", more=PLACED))
def _(t: Tables) -> DataFrame:
    return sampling.resample_to_largest(t.events.select("event_id", "event_type", "value"), "event_type", "event_id")


@entry("r4_over_sample", sql(
    f"""SELECT event_id, event_type, value, FALSE AS copied FROM events UNION ALL
    SELECT event_id, event_type, value, TRUE FROM (SELECT event_type, {seeded_q('event_type', 'draw')} % n + 1 AS pos
    FROM (SELECT event_type, n, unnest(range(most - n)) AS draw FROM sizes)) JOIN placed USING (event_type, pos)""", more=PLACED))
def _(t: Tables) -> DataFrame:
    return sampling.over_sample(t.events.select("event_id", "event_type", "value"), "event_type", "event_id")


@entry("r5_thin_category", sql(
    """SELECT event_id, event_type, value FROM placed WHERE NOT (event_type = 'purchase' AND pos <= round(n * 0.8::DOUBLE))""", more=PLACED))
def _(t: Tables) -> DataFrame:
    slim = t.events.select("event_id", "event_type", "value")
    return sampling.thin_category(slim, "event_type", "purchase", 0.8, "event_id")


@entry("r6_balanced_weights", f"""SELECT event_id, {rq('n / (g * ng)', 9)} AS weight FROM (SELECT event_id,
 CAST(count(*) OVER () AS DOUBLE) AS n, count(*) OVER (PARTITION BY user_id) AS ng,
 (SELECT count(DISTINCT user_id) FROM events) AS g FROM events)""")
def _(t: Tables) -> DataFrame:
    weighted = bias.balanced_weights(t.events, "user_id")
    return weighted.select("event_id", r("weight", 9).alias("weight"))
