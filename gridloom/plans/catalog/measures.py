"""Aggregates, bias, data quality and drift (A, Q)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators import bias, drift, quality, rulestate, stats
from gridloom.plans import jobs
from gridloom.plans.catalog.base import (
    Tables, entry, r, rounded, rq, sql, stamp, stamp_q, timed,
)
from gridloom.plans.catalog.rows import TWICE, twice
from gridloom.session import scratch_path

# ---- statistics -------------------------------------------------------------------------

@entry("a1_group_mean", f"SELECT user_id, {rq('avg(value)')} AS mean FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return rounded(stats.group_mean(t.events, "user_id", "value"), ["mean"])


@entry("a2_mean_by_month", f"SELECT CAST(month(l_shipdate) AS BIGINT) AS m, {rq('avg(l_extendedprice)', 4)} AS mean FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    means = stats.group_mean(t.lineitem, F.month("l_shipdate").cast("bigint").alias("m"), "l_extendedprice")
    return rounded(means, ["mean"], 4)


SLICES_L = """slices AS (SELECT 'l_returnflag_' || l_returnflag AS slice, avg(l_extendedprice) AS mean, count(*) AS rows
 FROM lineitem GROUP BY l_returnflag UNION ALL SELECT 'l_linestatus_' || l_linestatus, avg(l_extendedprice), count(*)
 FROM lineitem GROUP BY l_linestatus)"""


@entry("a3_slice_means", sql(f"SELECT slice, {rq('mean', 4)} AS mean, rows FROM slices", more=SLICES_L))
def _(t: Tables) -> DataFrame:
    return rounded(stats_slices(t), ["mean"], 4)


def stats_slices(t: Tables) -> DataFrame:
    return bias.slice_means(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")


SLICES_E = """slices AS (SELECT 'user_id_' || user_id AS slice, avg(value) AS mean, count(*) AS rows FROM events GROUP BY user_id
 UNION ALL SELECT 'event_type_' || event_type, avg(value), count(*) FROM events GROUP BY event_type)"""


@entry("a4_biased_slices", sql(
    f"""SELECT slice, {rq('mean')} AS mean, rows, {rq('overall')} AS overall FROM
    (SELECT *, (SELECT avg(mean) FROM slices) AS overall FROM slices) WHERE abs(mean - overall) > 0.2::DOUBLE * overall""",
    more=SLICES_E))
def _(t: Tables) -> DataFrame:
    found = bias.biased_slices(bias.slice_means(t.events, ["user_id", "event_type"], "value"))
    return rounded(found, ["mean", "overall"])


SLICES_F = "slices AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, '{c}_' || {c} AS slice, avg({f}) AS mean FROM readings GROUP BY {c}"
    for f in ("cents", "k") for c in ("user_id", "event_type")) + ")"


@entry("a5_biased_slices_by_feature", sql(
    f"""SELECT feature, slice, {rq('mean')} AS mean, {rq('overall')} AS overall FROM
    (SELECT *, avg(mean) OVER (PARTITION BY feature) AS overall FROM slices) WHERE abs(mean - overall) > 0.1::DOUBLE * overall""",
    "readings", more=SLICES_F))
def _(t: Tables) -> DataFrame:
    found = bias.slice_bias_by_feature(t.readings, ["user_id", "event_type"], ["cents", "k"], 0.1)
    return rounded(found.select("feature", "slice", "mean", "overall"), ["mean", "overall"])


KNOWN = "avg(CASE WHEN value IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END)"


@entry("a6_coverage", sql(
    f"""SELECT zone, CASE WHEN grouping(zone) = 1 THEN 'overall' ELSE 'group' END AS scope, {rq(KNOWN)} AS selection_rate,
    1.0::DOUBLE AS accuracy, count(*) AS rows FROM patchy GROUP BY GROUPING SETS ((zone), ())""", "patchy"))
def _(t: Tables) -> DataFrame:
    return rounded(bias.coverage(t.patchy, "value", "zone"), ["selection_rate", "accuracy"])


@entry("a7_coverage_difference", sql(
    f"""SELECT {rq('max(rate) - min(rate)')} AS selection_rate_difference, 0.0::DOUBLE AS accuracy_difference
    FROM (SELECT {KNOWN} AS rate FROM patchy GROUP BY zone)""", "patchy"))
def _(t: Tables) -> DataFrame:
    rates = bias.coverage(t.patchy, "value", "zone")
    found = bias.group_difference(rates, ["selection_rate", "accuracy"])
    return rounded(found, found.columns)


ERRORS = "CAST(avg(CAST((value - guess) AS DOUBLE) * (value - guess)) AS DOUBLE) AS mse, avg(abs(value - guess)) AS mae"
FRAME = f"""frame AS (SELECT zone, CASE WHEN grouping(zone) = 1 THEN 'overall' ELSE 'group' END AS scope, {ERRORS},
 count(*) AS rows FROM predicted GROUP BY GROUPING SETS ((zone), ()))"""


def frame(t: Tables) -> DataFrame:
    return bias.metric_frame(t.predicted, "value", "guess", ["zone"])


@entry("a8_metric_frame", sql(f"SELECT zone, scope, {rq('mse', 2)} AS mse, {rq('mae', 4)} AS mae, rows FROM frame", "predicted", more=FRAME))
def _(t: Tables) -> DataFrame:
    return frame(t).select("zone", "scope", r("mse", 2).alias("mse"), r("mae", 4).alias("mae"), "rows")


CROSSED = """marked AS (SELECT *, CASE WHEN humidity > (SELECT median(humidity) FROM predicted) THEN 'high' ELSE 'low' END AS damp
 FROM predicted WHERE NOT (zone = 'click' AND humidity > (SELECT median(humidity) FROM predicted)))"""


@entry("a9_crossed_metric_frame", sql(
    f"""SELECT z.zone, d.damp, 'group' AS scope, {rq('mse', 2)} AS mse, {rq('mae', 4)} AS mae, coalesce(rows, 0) AS rows
    FROM (SELECT DISTINCT zone FROM marked) z CROSS JOIN (SELECT DISTINCT damp FROM marked) d
    LEFT JOIN (SELECT zone, damp, {ERRORS}, count(*) AS rows FROM marked GROUP BY 1, 2) m
    ON z.zone = m.zone AND d.damp = m.damp""", "predicted", more=CROSSED))
def _(t: Tables) -> DataFrame:
    cut = stats.median_cut(t.predicted, "humidity")
    marked = t.predicted.withColumn("damp", bias.high_low(F.col("humidity"), cut)).filter(
        "NOT (zone = 'click' AND damp = 'high')")
    crossed = bias.metric_frame(marked, "value", "guess", ["zone", "damp"], complete=True)
    return crossed.filter("scope = 'group'").select(
        "zone", "damp", "scope", r("mse", 2).alias("mse"), r("mae", 4).alias("mae"), "rows")


NUMERIC = [*schemas.WEATHER_INTEGERS, *schemas.WEATHER_DOUBLES, "value"]
EXTREMES = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min("{c}") AS DOUBLE) AS min, CAST(max("{c}") AS DOUBLE) AS max FROM raw""" for c in NUMERIC)


@entry("a10_min_max_map", sql(EXTREMES, "raw"))
def _(t: Tables) -> DataFrame:
    from gridloom.operators.scaling import min_max_map

    return min_max_map(t.raw)


@entry("a11_metric_ratios", sql(
    f"""SELECT {rq('min(mae) / max(mae)')} AS ratio_min_max, {rq('max(mae) / min(mae)')} AS ratio_max_min,
    {rq("min(least(mae / o, o / mae))")} AS ratio_to_overall
    FROM (SELECT *, (SELECT mae FROM frame WHERE scope = 'overall') AS o FROM frame WHERE scope = 'group')""",
    "predicted", more=FRAME))
def _(t: Tables) -> DataFrame:
    found = bias.metric_ratios(frame(t), "mae")
    return rounded(found, found.columns)


BIASED = f"""SELECT zone, {rq('mae', 4)} AS mae, {rq('abs(mae - o)', 4)} AS mae_difference, {rq('o', 4)} AS overall
 FROM (SELECT *, (SELECT mae FROM frame WHERE scope = 'overall') AS o FROM frame WHERE scope = 'group')
 WHERE abs(mae - o) > {{0}}::DOUBLE * o"""


def biased(t: Tables, multiplier: float) -> DataFrame:
    found = bias.biased_groups(frame(t), "mae", multiplier)
    return rounded(found.select("zone", "mae", "mae_difference", "overall"), ["mae", "mae_difference", "overall"], 4)


@entry("a12_biased_groups", sql(BIASED.format("0.01"), "predicted", more=FRAME))
def _(t: Tables) -> DataFrame:
    return biased(t, 0.01)


R2 = "1 - sum(CAST((value - guess) AS DOUBLE) * (value - guess)) / (var_pop(CAST(value AS DOUBLE)) * count(*))"


@entry("a13_regression_metrics", sql(
    f"""SELECT {rq('mse', 2)} AS mse, {rq('mae', 4)} AS mae, {rq('r2')} AS r2, rows
    FROM (SELECT {ERRORS}, {R2} AS r2, count(*) AS rows FROM predicted)""", "predicted"))
def _(t: Tables) -> DataFrame:
    return stats.regression_metrics(t.predicted, "value", "guess").select(
        r("mse", 2).alias("mse"), r("mae", 4).alias("mae"), r("r2").alias("r2"), "rows")


@entry("a14_value_counts", "SELECT user_id, event_type, count(*) AS count FROM events GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", "event_type").count()


MEASURED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@entry("a15_describe_numbers", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS count, {rq(f'avg({c})', 4)} AS mean, {rq(f'stddev_samp({c})', 4)} AS std,
    min({c}) AS min, max({c}) AS max, {rq(f'quantile_cont({c}, 0.25)')} AS p25, {rq(f'quantile_cont({c}, 0.5)')} AS p50,
    {rq(f'quantile_cont({c}, 0.75)')} AS p75 FROM lineitem""" for c in MEASURED))
def _(t: Tables) -> DataFrame:
    described = stats.describe_numeric(t.lineitem, MEASURED)
    return rounded(rounded(described, ["mean", "std"], 4), ["p25", "p50", "p75"])


TEXTS = ["l_returnflag", "l_linestatus", "l_suppkey"]


@entry("a15_describe_text", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, (SELECT count({c}) FROM lineitem) AS count, (SELECT count(DISTINCT {c}) FROM lineitem) AS "unique",
    top, freq FROM (SELECT CAST({c} AS VARCHAR) AS top, count(*) AS freq FROM lineitem GROUP BY 1 ORDER BY freq DESC, top LIMIT 1)"""
    for c in TEXTS))
def _(t: Tables) -> DataFrame:
    return stats.describe_text(t.lineitem, TEXTS)


PATCHY_COLUMNS = ["zone", "datetime", "tempF", "windspeedMiles", "humidity", "value"]


@entry("a16_null_counts", sql(
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NULL) AS nulls FROM patchy""" for c in PATCHY_COLUMNS), "patchy"))
def _(t: Tables) -> DataFrame:
    return stats.null_counts(t.patchy)


@entry("a17_distinct_count", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@entry("a17_distinct_values", "SELECT DISTINCT user_id FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("user_id").distinct()


@entry("a18_time_span", f"SELECT {stamp_q('min(ts)', 'first_ts')}, {stamp_q('max(ts)', 'last_ts')} FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.agg(stamp(F.min("ts"), "first_ts"), stamp(F.max("ts"), "last_ts"))


@entry("a19_median_split", sql(
    f"""SELECT zone, {stamp_q("datetime")}, CASE WHEN humidity > (SELECT median(humidity) FROM hourly) THEN 'high' ELSE 'low' END AS level
    FROM hourly""", "hourly"))
def _(t: Tables) -> DataFrame:
    level = bias.high_low(F.col("humidity"), stats.median_cut(t.hourly, "humidity"))
    return t.hourly.select("zone", stamp("datetime"), level.alias("level"))


RELATED = ["tempF", "windspeedMiles", "humidity", "visibility", "pressure", "HeatIndexF", "FeelsLikeF", "precipInches", "value"]
PAIRS = "pairs AS (" + " UNION ALL ".join(
    f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr("{a}", "{b}") AS correlation FROM raw"""
    for a in RELATED for b in RELATED if a != b) + ")"


@entry("a20_correlations", sql(f"SELECT feature_1, feature_2, {rq('correlation')} AS correlation FROM pairs", "raw", more=PAIRS))
def _(t: Tables) -> DataFrame:
    return rounded(stats.correlations(t.raw, RELATED), ["correlation"])


RANKS = "ranks(feature, pos) AS (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(RELATED)) + ")"


@entry("a21_strong_pairs", sql(
    f"""SELECT p.feature_1, p.feature_2, {rq('p.correlation')} AS correlation, {rq('t1.r')} AS target_1, {rq('t2.r')} AS target_2,
    CASE WHEN round(abs(t1.r), 9) > round(abs(t2.r), 9) THEN p.feature_1 ELSE p.feature_2 END AS keep FROM pairs p
    JOIN ranks a ON a.feature = feature_1 JOIN ranks b ON b.feature = feature_2
    JOIN to_target t1 ON t1.feature = feature_1 JOIN to_target t2 ON t2.feature = feature_2
    WHERE a.pos > b.pos AND abs(p.correlation) > 0.7""", "raw",
    more=f"""{PAIRS}, {RANKS}, to_target AS (SELECT feature_1 AS feature, correlation AS r FROM pairs WHERE feature_2 = 'value'
    UNION ALL SELECT 'value', 1.0)"""))
def _(t: Tables) -> DataFrame:
    found = stats.strong_pairs(t.raw, RELATED, "value")
    return rounded(found, ["correlation", "target_1", "target_2"]).select(
        "feature_1", "feature_2", "correlation", "target_1", "target_2", "keep")


# ---- drift ------------------------------------------------------------------------------

CUT = "TIMESTAMP '2024-01-16 00:00:00'"
LONG = f"""long AS (SELECT feature, v + CASE WHEN feature = 'cents' AND side = 1 THEN 500 ELSE 0 END AS v, side FROM (
  SELECT unnest(['cents', 'k', 'user_id']) AS feature, unnest([cents, k, user_id])::DOUBLE AS v,
  CAST(ts >= {CUT} AS INTEGER) AS side FROM readings))"""


WATCHED = ["cents", "k", "user_id"]


def samples(t: Tables) -> DataFrame:
    """Readings with ``side`` 0 before and 1 after the middle of the month; the later cents are shifted."""
    sided = t.readings.withColumn("side", drift.side_of("ts", F.expr("timestamp_ntz'2024-01-16 00:00:00'")))
    return sided.withColumn("cents", F.col("cents") + F.when(F.col("side") == 1, 500).otherwise(0))


def counts_of(t: Tables) -> DataFrame:
    return drift.counts_by_side(samples(t), F.col("side"), WATCHED)


def histogram_sql(edges: str) -> str:
    where = "" if edges == "own" else " WHERE side = 0"
    by = "feature, side" if edges == "own" else "feature"
    return f"""limits AS (SELECT {by}, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
  CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM long{where} GROUP BY {by}),
 binned AS (SELECT feature, side, CAST(least(9, greatest(0, floor((v - lo) * 10 / (hi - lo)))) AS INTEGER) AS bin, count(*) AS n
  FROM long JOIN limits USING ({by}) GROUP BY 1, 2, 3)"""


@entry("a22_histogram", sql("SELECT feature, side, bin, n FROM binned", "readings", more=f"{LONG}, {histogram_sql('own')}"))
def _(t: Tables) -> DataFrame:
    return drift.binned(samples(t), F.col("side"), WATCHED)


@entry("a23_largest_slice", "SELECT max(n) AS rows FROM (SELECT count(*) AS n FROM events GROUP BY user_id)")
def _(t: Tables) -> DataFrame:
    return bias.largest_slice(t.events, "user_id")


@entry("a24_sample_weights", f"""SELECT event_id, {rq('n / (g * ng)', 9)} AS weight FROM (SELECT event_id,
 CAST(count(*) OVER () AS DOUBLE) AS n, count(*) OVER (PARTITION BY event_type) AS ng,
 (SELECT count(DISTINCT event_type) FROM events) AS g FROM events)""")
def _(t: Tables) -> DataFrame:
    return bias.balanced_weights(t.events, "event_type").select("event_id", r("weight", 9).alias("weight"))


def statistics_sql() -> str:
    kinds = {**{c: "bigint" for c in [*schemas.WEATHER_INTEGERS, "value"]}, **{c: "double" for c in schemas.WEATHER_DOUBLES},
             "datetime": "timestamp_ntz", "zone": "string", "subba-name": "string", "value-units": "string"}
    cells = []
    for c, kind in kinds.items():
        low, high = (f'CAST(min("{c}") AS DOUBLE)', f'CAST(max("{c}") AS DOUBLE)') if kind in ("bigint", "double") else ("NULL::DOUBLE",) * 2
        cells.append(f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) FILTER ("{c}" IS NULL) > 0 AS nullable, {low} AS min, {high} AS max FROM raw""")
    return sql(" UNION ALL ".join(cells), "raw")


@entry("a25_schema_statistics", statistics_sql())
def _(t: Tables) -> DataFrame:
    return quality.schema_statistics(t.raw)


# ---- quality ----------------------------------------------------------------------------

RULED = {"zone": "string", "datetime": "timestamp_ntz", "tempF": "bigint", "windspeedMiles": "bigint", "humidity": "bigint", "value": "bigint"}


@entry("q1_infer_schema", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) FILTER ("{c}" IS NULL) > 0 AS nullable, """
    + (f'CAST(min("{c}") AS DOUBLE) AS min, CAST(max("{c}") AS DOUBLE) AS max' if kind == "bigint" else "NULL::DOUBLE AS min, NULL::DOUBLE AS max")
    + " FROM patchy" for c, kind in RULED.items()), "patchy"))
def _(t: Tables) -> DataFrame:
    return quality.schema_statistics(t.patchy)


@entry("q1_merged_rules", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) AS rows, count(*) FILTER ("{c}" IS NULL) AS nulls, """
    + (f'CAST(min("{c}") AS DOUBLE) AS min, CAST(max("{c}") AS DOUBLE) AS max' if kind == "bigint" else "NULL::DOUBLE AS min, NULL::DOUBLE AS max")
    + (", array_to_string(list_sort(list(DISTINCT zone)), ',') AS known_values" if c == "zone" else ", NULL::VARCHAR AS known_values")
    + " FROM patchy" for c, kind in RULED.items()), "patchy"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "state")
    for i in range(3):  # three batches; none reads the others
        rulestate.save_merged(t.patchy.filter(F.dayofmonth("datetime") % 3 == i), path, value_sets=["zone"])
    return rulestate.load_state(t.spark, path).select(
        "column", F.col("types")[0].alias("type"), "rows", "nulls", "min", "max", F.array_join("values", ",").alias("known_values"))


@entry("q4_gate", sql(
    """SELECT part, bool_and(fits) AS accepted, CASE WHEN bool_and(fits) THEN 0 ELSE count(*) END AS set_aside
    FROM (SELECT CASE WHEN zone = 'view' THEN 'seen' ELSE 'new' END AS part, """
    + " AND ".join(f'"{c}" BETWEEN (SELECT min("{c}") FROM hourly WHERE zone = \'view\') AND (SELECT max("{c}") FROM hourly WHERE zone = \'view\')'
                   for c, kind in RULED.items() if kind == "bigint")
    + " AND zone = 'view' AS fits FROM hourly) GROUP BY 1", "hourly"))
def _(t: Tables) -> DataFrame:
    state = rulestate.column_state(t.hourly.filter("zone = 'view'"), ["zone"])
    rules, found = rulestate.rules_of(state), None
    for part, batch in (("seen", t.hourly.filter("zone = 'view'")), ("new", t.hourly.filter("zone <> 'view'"))):
        aside = scratch_path(t.spark, "aside")
        accepted = quality.gate(batch, rules, aside)
        kept = t.spark.read.schema(batch.schema).parquet(aside) if not accepted else batch.limit(0)
        row = kept.agg(F.count(F.lit(1)).alias("set_aside")).select(F.lit(part).alias("part"), F.lit(accepted).alias("accepted"), "set_aside")
        found = row if found is None else found.unionByName(row)
    return found


OLD = f"old AS (SELECT * FROM patchy WHERE datetime < {CUT}), new AS (SELECT * FROM patchy WHERE datetime >= {CUT})"


def counts_sql() -> str:
    cells = []
    for c, kind in RULED.items():
        cells.append(f"""SELECT '{c}' AS "column", 'not_null' AS "check", (SELECT count(*) FROM new WHERE "{c}" IS NULL) AS failures
 WHERE NOT EXISTS (SELECT 1 FROM old WHERE "{c}" IS NULL)""")
        if kind == "bigint":
            for check, sign in (("min", "<"), ("max", ">")):
                cells.append(f"""SELECT '{c}', '{check}', (SELECT count(*) FROM new WHERE "{c}" {sign} (SELECT {check}("{c}") FROM old))""")
    return "\nUNION ALL ".join(cells)


def halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    return drift.split_at_time(t.patchy, "datetime", F.expr("timestamp_ntz'2024-01-16 00:00:00'"))


@entry("q2_validation_counts", sql(counts_sql(), "patchy", more=OLD))
def _(t: Tables) -> DataFrame:
    old, new = halves(t)
    return quality.violation_counts(new, quality.infer_rules(old))


@entry("q2_violations", sql(" UNION ALL ".join(
    f"""SELECT zone, {stamp_q("datetime")}, '{c}' AS "column", '{check}' AS "check", CAST("{c}" AS VARCHAR) AS found FROM new
    WHERE "{c}" {sign} (SELECT {check}("{c}") FROM old)"""
    for c, kind in RULED.items() if kind == "bigint" for check, sign in (("min", "<"), ("max", ">"))) + "".join(
    f""" UNION ALL SELECT zone, {stamp_q("datetime")}, '{c}', 'not_null', NULL FROM new WHERE "{c}" IS NULL
    AND NOT EXISTS (SELECT 1 FROM old WHERE "{c}" IS NULL)""" for c in RULED), "patchy", more=OLD))
def _(t: Tables) -> DataFrame:
    old, new = halves(t)
    return timed(quality.violations(new, quality.infer_rules(old), ["zone", "datetime"]))


@entry("q2_verdict", sql(
    """SELECT sum(failures) = 0 AS valid, count(*) FILTER (failures > 0) AS failed_checks, CAST(sum(failures) AS BIGINT) AS failed_cells
    FROM counts""", "patchy", more=f"{OLD}, counts AS ({counts_sql()})"))
def _(t: Tables) -> DataFrame:
    old, new = halves(t)
    return quality.verdict(quality.violation_counts(new, quality.infer_rules(old)))


@entry("q3_fix_anomalies", sql(
    f"""SELECT zone, {stamp_q("datetime")}, t AS "tempF", greatest(w, 0) AS "windspeedMiles", h AS humidity, greatest(v, 0) AS value
    FROM (SELECT DISTINCT zone, datetime, coalesce("tempF", 0) AS t, "windspeedMiles" - 3 AS w, coalesce(humidity, 0) AS h,
    coalesce(value, 0) AS v FROM twice)""", "patchy", more=TWICE))
def _(t: Tables) -> DataFrame:
    return timed(quality.fix_anomalies(twice(t).withColumn("windspeedMiles", F.col("windspeedMiles") - 3)))


SHARES = """counts AS (SELECT feature, v, count(*) FILTER (side = 0) AS n0, count(*) FILTER (side = 1) AS n1 FROM long GROUP BY 1, 2),
 shares AS (SELECT feature, v, lead(v) OVER w AS next_v,
  CAST(sum(n0) OVER w AS DOUBLE) / sum(n0) OVER (PARTITION BY feature) AS f0,
  CAST(sum(n1) OVER w AS DOUBLE) / sum(n1) OVER (PARTITION BY feature) AS f1,
  CAST(sum(n0) OVER (PARTITION BY feature) AS DOUBLE) AS s0, CAST(sum(n1) OVER (PARTITION BY feature) AS DOUBLE) AS s1
  FROM counts WINDOW w AS (PARTITION BY feature ORDER BY v))"""
KS = """ks AS (SELECT feature, max(abs(f0 - f1)) AS d, max(s0) AS s0, max(s1) AS s1 FROM shares GROUP BY 1),
 lam AS (SELECT *, d * sqrt(s0 * s1 / (s0 + s1)) AS l FROM ks),
 tested AS (SELECT *, CASE WHEN l < 0.2 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, (SELECT sum(
  (CASE WHEN j % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END) * exp(-2.0::DOUBLE * j * j * l * l))
  FROM range(1, 101) AS series(j)))) END AS p FROM lam)"""


@entry("q5_ks_test", sql(
    f"""SELECT feature, {rq('d')} AS statistic, {rq('p')} AS p_value, p < 0.05 AS drift FROM tested""",
    "readings", more=f"{LONG}, {SHARES}, {KS}"))
def _(t: Tables) -> DataFrame:
    tested = drift.ks_test(counts_of(t)).select("feature", "statistic", "p_value", "drift")
    return rounded(tested, ["statistic", "p_value"])


def psi_sql(edges: str) -> str:
    return sql(
        f"""SELECT feature, {rq('psi')} AS psi, psi > 0.2 AS drift FROM (
        SELECT feature, sum((p - q) * ln(p / q)) AS psi FROM (
         SELECT feature, bin, coalesce(sum(n) FILTER (side = 0), 0) / max(s0) + 1e-10 AS p, coalesce(sum(n) FILTER (side = 1), 0) / max(s1) + 1e-10 AS q
         FROM (SELECT feature, unnest(range(10)) AS bin, s0, s1 FROM (SELECT feature, CAST(sum(n) FILTER (side = 0) AS DOUBLE) AS s0,
          CAST(sum(n) FILTER (side = 1) AS DOUBLE) AS s1 FROM binned GROUP BY 1)) LEFT JOIN binned USING (feature, bin) GROUP BY 1, 2) GROUP BY 1)""",
        "readings", more=f"{LONG}, {histogram_sql(edges)}")


@entry("q6_psi_own_edges", psi_sql("own"))
def _(t: Tables) -> DataFrame:
    return rounded(drift.psi_by_side(samples(t), F.col("side"), WATCHED), ["psi"])


@entry("q6_psi_baseline_edges", psi_sql("baseline"))
def _(t: Tables) -> DataFrame:
    return rounded(drift.psi_by_side(samples(t), F.col("side"), WATCHED, edges="baseline"), ["psi"])


AREA = """area AS (SELECT feature, sum(abs(f0 - f1) * (next_v - v)) AS distance FROM shares GROUP BY 1),
 moved AS (SELECT feature, distance, distance / greatest((SELECT stddev_pop(v) FROM long l WHERE l.feature = area.feature AND side = 0), 0.001::DOUBLE)
  AS normalised FROM area)"""
KINDS = f"""kinds AS (SELECT feature, category, count(*) FILTER (side = 0) AS n0, count(*) FILTER (side = 1) AS n1 FROM (
  SELECT 'event_type' AS feature, event_type AS category, CAST(ts >= {CUT} AS INTEGER) AS side FROM readings UNION ALL
  SELECT 'level', CASE WHEN k < 20 THEN 'low' WHEN k < 70 THEN 'middle' ELSE 'high' END, CAST(ts >= {CUT} AS INTEGER) FROM readings)
  GROUP BY 1, 2),
 parts AS (SELECT *, n0 / sum(n0) OVER (PARTITION BY feature) AS p, n1 / sum(n1) OVER (PARTITION BY feature) AS q,
  sum(n1) OVER (PARTITION BY feature) AS s1 FROM kinds),
 fitted AS (SELECT feature, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js_distance,
  sum(CASE WHEN p > 0 THEN pow(n1 - p * s1, 2) / (p * s1) ELSE 'inf'::DOUBLE END) AS chi2, count(*) - 1 AS freedom FROM parts GROUP BY 1)"""


def categories(t: Tables) -> DataFrame:
    level = F.when(F.col("k") < 20, "low").when(F.col("k") < 70, "middle").otherwise("high")
    return samples(t).withColumn("level", level)


KIND_COLUMNS = ["event_type", "level"]


@entry("q7_drift_report", sql(
    f"""SELECT feature, 'wasserstein_normalised' AS test, {rq('normalised')} AS drift_score, normalised > 0.1 AS drift_detected FROM moved
    UNION ALL SELECT feature, 'jensen_shannon', {rq('js_distance')}, js_distance > 0.1 FROM fitted""",
    "readings", more=f"{LONG}, {SHARES}, {AREA}, {KINDS}"))
def _(t: Tables) -> DataFrame:
    found = drift.drift_report_by_side(categories(t), F.col("side"), WATCHED, KIND_COLUMNS)
    return rounded(found, ["drift_score"])


@entry("q7_drift_report_p_values", sql(
    f"SELECT feature, 'ks_p_value' AS test, {rq('p')} AS drift_score, p < 0.05 AS drift_detected FROM tested",
    "readings", more=f"{LONG}, {SHARES}, {KS}"))
def _(t: Tables) -> DataFrame:
    return rounded(drift.drift_report_by_side(samples(t), F.col("side"), WATCHED, judge="p_value"), ["drift_score"])


@entry("q7_dataset_drift", sql(
    """SELECT count(*) AS columns, count(*) FILTER (hit) AS drifted_columns, count(*) FILTER (hit) / count(*) AS share_drifted,
    count(*) FILTER (hit) / count(*) >= 0.5 AS dataset_drift FROM (SELECT normalised > 0.1 AS hit FROM moved UNION ALL
    SELECT js_distance > 0.1 FROM fitted)""", "readings", more=f"{LONG}, {SHARES}, {AREA}, {KINDS}"))
def _(t: Tables) -> DataFrame:
    return drift.dataset_drift(drift.drift_report_by_side(categories(t), F.col("side"), WATCHED, KIND_COLUMNS))


@entry("q8_wasserstein", sql(
    f"SELECT feature, {rq('distance', 4)} AS distance, {rq('normalised')} AS normalised FROM moved",
    "readings", more=f"{LONG}, {SHARES}, {AREA}"))
def _(t: Tables) -> DataFrame:
    found = drift.wasserstein(counts_of(t))
    return found.select("feature", r("distance", 4).alias("distance"), r("normalised").alias("normalised"))


@entry("q9_category_drift", sql(
    f"SELECT feature, {rq('js_distance')} AS js_distance, {rq('chi2', 4)} AS chi2, CAST(freedom AS BIGINT) AS freedom FROM fitted",
    "readings", more=KINDS))
def _(t: Tables) -> DataFrame:
    found = drift.category_drift(drift.category_counts_by_side(categories(t), F.col("side"), KIND_COLUMNS))
    return found.select("feature", r("js_distance").alias("js_distance"), r("chi2", 4).alias("chi2"), F.col("freedom").cast("bigint"))


@entry("q10_split_at_last_time", sql(
    f"""SELECT CASE WHEN datetime < (SELECT max(datetime) FROM hourly) THEN 'baseline' ELSE 'new' END AS part, zone, value FROM hourly""", "hourly"))
def _(t: Tables) -> DataFrame:
    old, new = drift.split_at_time(t.hourly)
    return old.withColumn("part", F.lit("baseline")).unionByName(new.withColumn("part", F.lit("new"))).select("part", "zone", "value")


@entry("u7_baseline_and_new", sql(
    f"""SELECT event_id, CASE WHEN ts < (SELECT max(ts) FROM events) THEN 'baseline' ELSE 'new' END AS part FROM events"""))
def _(t: Tables) -> DataFrame:
    old, new = drift.split_at_time(t.events, "ts")
    return old.withColumn("part", F.lit("baseline")).unionByName(new.withColumn("part", F.lit("new"))).select("event_id", "part")


@entry("e5_drift_job", sql(
    f"""SELECT feature, {rq('d')} AS statistic, {rq('p')} AS p_value, {rq('normalised')} AS drift_score FROM tested JOIN moved USING (feature)""",
    "readings", more=f"{LONG}, {SHARES}, {KS}, {AREA}"))
def _(t: Tables) -> DataFrame:
    found = jobs.drift_job(
        samples(t).select("ts", *WATCHED), F.expr("timestamp_ntz'2024-01-16 00:00:00'"), WATCHED, "ts")
    both = found["ks"].join(found["report"], "feature")
    return both.select("feature", *[r(c).alias(c) for c in ("statistic", "p_value", "drift_score")])
