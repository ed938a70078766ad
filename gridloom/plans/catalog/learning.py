"""Model jobs, registry rules and end-to-end jobs (M, T4–T6, W17, J11, E)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators import bias, gram, models, quality, registry, regions, report, scaling, splits
from gridloom.operators.ordered import cname, over_blocks
from gridloom.operators.stats import regression_metrics
from gridloom.plans import jobs
from gridloom.plans.catalog.base import (
    ORACLE, Tables, entry, r, rounded, rq, seeded_q, sql, stamp_q, timed,
)
from gridloom.plans.catalog.measures import ERRORS, FRAME, biased, BIASED, frame
from gridloom.plans.catalog.rows import (
    FEATURE_SQL, FEATURED, HISTORY, ITEMS, MONTH_SQL, NEAR, SHEET,
)
from gridloom.plans.catalog.series import GRID, RATES, filled_list
from gridloom.plans.catalog.storage import (
    RUNS, VERSIONS, demand_payload, parsed, runs, versions, weather_payload, RAW_LIST,
)
from gridloom.session import checkpointed, scratch_path
from gridloom.sources import snapshots
from gridloom.sources.dimensions import MARKET_REGIONS

FEATURES = list(schemas.MODEL_FEATURES)


def learning_table(t: Tables) -> DataFrame:
    """The preprocessed table with a row key: all model features, globally scaled."""
    featured = checkpointed(jobs.feature_table(t.keyed))
    slim = featured.select("row_id", "zone", cname("subba-name"), "datetime", *FEATURES, "value")
    return scaling.scale_min_max(slim, (), [c for c in [*FEATURES, "value"] if not c.startswith("month")])


DIGITS = 9


def scaled(over: str):
    """SQL of a scaled final column."""

    def cell(column: str) -> str:
        if column.startswith("month"):
            return f"({column} + 1) / 2"
        value = f'CAST("{column}" AS DOUBLE)'
        low, high = (f"{f}({value}) OVER ({over})" for f in ("min", "max"))
        return f"CASE WHEN {high} - {low} > 1e-12 * greatest(abs({low}), abs({high})) THEN ({value} - {low}) / ({high} - {low}) END"

    return cell


#: Twin of ``learning_table``, with the code of the area and the splits by zone (``part``) and of the whole table (``whole``).
LEARNING = FEATURED.replace("FROM raw)", "FROM keyed)") + ", learning AS (SELECT row_id, zone, datetime, " + ", ".join(
    f'{scaled("")(c)} AS "{c}"' for c in [*FEATURES, "value"]) + f""", CAST(dense_rank() OVER (ORDER BY "subba-name") - 1 AS DOUBLE) AS "subba-name",
 CASE WHEN row_number() OVER z <= (count(*) OVER g * 200) // 1000 THEN 'test'
  WHEN row_number() OVER z <= (count(*) OVER g * 200) // 1000 + (count(*) OVER g * 100) // 1000 THEN 'validation' ELSE 'train' END AS part,
 CASE WHEN row_number() OVER (ORDER BY {seeded_q('row_id')}, row_id) <= (count(*) OVER () * 200) // 1000 THEN 'test' ELSE 'train' END AS whole,
 CAST({seeded_q('row_id')} // ({1 << 60} // 5 + 1) AS INTEGER) AS fold
 FROM featured WINDOW z AS (PARTITION BY zone ORDER BY {seeded_q('row_id')}, row_id), g AS (PARTITION BY zone))"""


def line_sql(source: str, features: list[str], name: str = "line") -> str:
    """CTEs of least squares by elimination over ``source`` (columns fit, w, features, value): ``name`` has fit and b."""
    p = len(features) + 2
    cells = ", ".join(f'CAST("{c}" AS DOUBLE)' for c in [*features, "value"])
    return f"""{name}_z AS (SELECT fit, w, [CAST(1 AS DOUBLE), {cells}] AS z FROM {source}),
 {name}_s AS (SELECT fit, i, j, sum(w * z[i] * z[j]) AS s FROM {name}_z, (SELECT unnest(range(1, {p + 1})) AS i), (SELECT unnest(range(1, {p + 1})) AS j) GROUP BY ALL),
 {name}_r AS (SELECT fit, 0 AS k, list(s ORDER BY i, j) AS m, list(s ORDER BY i, j) AS base FROM {name}_s GROUP BY fit
  UNION ALL SELECT fit, k + 1, CASE WHEN m[k * {p} + k + 1] > 1e-9 * base[k * {p} + k + 1] THEN list_transform(range(0, {p * p}),
   lambda q: CASE WHEN q // {p} = k THEN m[q + 1] / m[k * {p} + k + 1]
    ELSE m[q + 1] - m[(q // {p}) * {p} + k + 1] * (m[k * {p} + q % {p} + 1] / m[k * {p} + k + 1]) END) ELSE m END, base
  FROM {name}_r WHERE k < {p - 1}),
 {name} AS (SELECT fit, list_transform(range(0, {p - 1}), lambda i: CASE WHEN m[i * {p} + i + 1] > 0.5 THEN m[i * {p} + {p}] ELSE 0 END) AS b
  FROM {name}_r WHERE k = {p - 1})"""


def guess_sql(features: list[str]) -> str:
    """A row's prediction by the coefficients ``b``."""
    return "list_inner_product(b, [CAST(1 AS DOUBLE), " + ", ".join(f'CAST("{c}" AS DOUBLE)' for c in features) + "])"


METRICS_Q = f"""{rq('avg((value - guess) * (value - guess))')} AS mse, {rq('avg(abs(value - guess))')} AS mae,
 {rq('1 - avg((value - guess) * (value - guess)) / var_pop(value)')} AS r2, count(*) AS rows"""
METRICS = ["mse", "mae", "r2"]


# ---- fits: rows only --------------------------------------------------------------------

@entry("m1_one_feature_line", sql(
    f"""SELECT {rq("regr_slope(value, \"windspeedMiles\")", 3)} AS slope, {rq("regr_intercept(value, \"windspeedMiles\")", 2)} AS intercept
    FROM hourly""", "hourly"))
def _(t: Tables) -> DataFrame:
    model = models.train(t.hourly.withColumn("value", F.col("value").cast("double")), "lr", ["windspeedMiles"])
    fit = model.stages[-1]
    line = t.spark.createDataFrame([(float(fit.coefficients[0]), float(fit.intercept))], "slope double, intercept double")
    return line.select(r("slope", 3).alias("slope"), r("intercept", 2).alias("intercept"))


@entry("m1_linear_regression", sql(
    f"SELECT {METRICS_Q} FROM (SELECT value, {guess_sql(FEATURES)} AS guess FROM learning, line)", "keyed", recursive=True,
    more=f"{LEARNING}, fitting AS (SELECT 0 AS fit, 1 AS w, * FROM learning), {line_sql('fitting', FEATURES)}"))
def _(t: Tables) -> DataFrame:
    table = checkpointed(learning_table(t))
    return rounded(models.evaluate(models.train(table, "linear", FEATURES), table), METRICS)


@entry("m1_cross_validated_line", sql(
    f"SELECT fold, {METRICS_Q} FROM (SELECT fold, value, {guess_sql(FEATURES)} AS guess FROM learning JOIN line ON fit = fold) GROUP BY 1",
    "keyed", recursive=True,
    more=f"""{LEARNING}, fitting AS (SELECT f AS fit, 1 AS w, l.* FROM learning l JOIN (SELECT unnest(range(5)) AS f) ON f <> fold),
    {line_sql('fitting', FEATURES)}"""))
def _(t: Tables) -> DataFrame:
    folded = checkpointed(splits.hash_folds(learning_table(t), 5, "row_id"))
    return rounded(gram.cross_validate(folded, FEATURES, "fold"), METRICS).drop("alpha")


@entry("m2_lasso")
def _(t: Tables) -> DataFrame:
    table = checkpointed(learning_table(t))
    return models.evaluate(models.train(table, "lasso", FEATURES, alpha=0.01), table)


@entry("m2_lasso_path")
def _(t: Tables) -> DataFrame:
    folded = checkpointed(splits.hash_folds(learning_table(t), 5, "row_id"))
    return rounded(gram.cross_validate(folded, FEATURES, "fold", alphas=(0.001, 0.003, 0.01, 0.03, 0.1)), METRICS)


@entry("m3_tree_search")
def _(t: Tables) -> DataFrame:
    _, tried = models.search_boosted_trees(checkpointed(learning_table(t)), FEATURES)
    rows = [(str(sorted(s.items())), float(mse)) for s, mse in tried]
    return t.spark.createDataFrame(rows, "setting string, mse double")


@entry("m4_cross_validated_trees")
def _(t: Tables) -> DataFrame:
    folded = checkpointed(splits.hash_folds(learning_table(t), 5, "row_id"))
    return models.cross_validate(folded, models.boosted_trees(gram.known_features(folded, FEATURES), maxIter=3, maxDepth=3), "fold", 5)


@entry("m5_feature_elimination")
def _(t: Tables) -> DataFrame:
    kept = models.eliminate_features(checkpointed(learning_table(t)), FEATURES, keep=20)
    return t.spark.createDataFrame([(f,) for f in kept], "feature string")


@entry("m6_permutation_importance")
def _(t: Tables) -> DataFrame:
    return jobs.feature_importance(checkpointed(learning_table(t)), "row_id", FEATURES, maxIter=3, maxDepth=3)


@entry("m7_importance_input", sql(
    """SELECT CAST(epoch(datetime) AS BIGINT) AS datetime, "tempF", dense_rank() OVER (ORDER BY "subba-name") - 1 AS "subba-name",
    dense_rank() OVER (ORDER BY zone) - 1 AS zone, value FROM raw""", "raw"))
def _(t: Tables) -> DataFrame:
    slim = t.raw.select("datetime", "tempF", cname("subba-name"), "zone", "value")
    return models.importance_input(slim)


CODED = list(schemas.TRAINING_FEATURES)
SINCE = "2024-01-10 00:00:00"


@entry("m8_train_since_date")
def _(t: Tables) -> DataFrame:
    table = checkpointed(learning_table(t))
    found = None
    for kind in ("lr", "xgboost"):
        model = models.train(table, kind, CODED, since=SINCE)
        scored = models.evaluate(model, table).withColumn("kind", F.lit(kind))
        found = scored if found is None else found.unionByName(scored)
    return found


@entry("m8_linear_since_date", sql(
    f"SELECT {METRICS_Q} FROM (SELECT value, {guess_sql(CODED)} AS guess FROM learning, line)", "keyed", recursive=True,
    more=f"{LEARNING}, fitting AS (SELECT 0 AS fit, 1 AS w, * FROM learning WHERE datetime >= TIMESTAMP '{SINCE}'), {line_sql('fitting', CODED)}"))
def _(t: Tables) -> DataFrame:
    table = checkpointed(learning_table(t))
    return rounded(models.evaluate(models.train(table, "linear", CODED, since=SINCE), table), METRICS)


RANKED = f"""ranked AS (SELECT k.row_id, k.zone, k.value, p.guess, row_number() OVER (PARTITION BY k.zone ORDER BY {seeded_q('k.row_id')}, k.row_id) AS rn,
 count(*) OVER (PARTITION BY k.zone) AS n FROM keyed k JOIN predicted p ON p.zone = k.zone AND p.datetime = k.datetime),
 tested AS (SELECT * FROM ranked WHERE rn <= (n * 200) // 1000)"""


def with_guess(t: Tables) -> DataFrame:
    """The keyed table with the value of the hour before as a fixed predictor."""
    return over_blocks(
        t.keyed.select("row_id", "zone", "datetime", "value"), ["zone"], "datetime", 1,
        lambda w: {"guess": F.lag("value").over(w)}).filter("guess IS NOT NULL")


@entry("m9_evaluate_test_split", sql(
    f"""SELECT {rq('mse', 2)} AS mse, {rq('mae', 4)} AS mae, {rq('r2')} AS r2, rows FROM (SELECT {ERRORS},
    1 - sum(CAST((value - guess) AS DOUBLE) * (value - guess)) / (var_pop(CAST(value AS DOUBLE)) * count(*)) AS r2, count(*) AS rows FROM tested)""",
    "predicted", more=RANKED))
def _(t: Tables) -> DataFrame:
    split = splits.stratified_split(with_guess(t), ["zone"], "row_id")
    return regression_metrics(split.filter("split = 'test'"), "value", "guess").select(
        r("mse", 2).alias("mse"), r("mae", 4).alias("mae"), r("r2").alias("r2"), "rows")


def column_bounds(df: DataFrame) -> dict[str, tuple[float, float]]:
    """Stored bounds from the min-max table: one row per column comes to the driver."""
    return {x["column"]: (x["min"], x["max"]) for x in scaling.min_max_map(df).collect()}


def served_model(t: Tables):
    """A line on all model features, globally scaled, and the bounds they were scaled with."""
    featured = checkpointed(jobs.feature_table(t.raw))
    bounds = column_bounds(featured)
    return models.train(scaling.scale_with_map(featured, bounds), "linear", FEATURES), bounds


@entry("m10_score_newest_hours", sql(
    f"""SELECT zone, {stamp_q("datetime")}, {rq('guess * (hi - lo) + lo', 3)} AS predicted FROM (
    SELECT *, {guess_sql(FEATURES)} AS guess, row_number() OVER (PARTITION BY zone ORDER BY datetime DESC) AS back FROM learning, line,
     (SELECT CAST(min(value) AS DOUBLE) AS lo, CAST(max(value) AS DOUBLE) AS hi FROM featured)) WHERE back = 1""", "keyed", recursive=True,
    more=f"{LEARNING}, fitting AS (SELECT 0 AS fit, 1 AS w, * FROM learning), {line_sql('fitting', FEATURES)}"))
def _(t: Tables) -> DataFrame:
    return timed(rounded(models.score_newest(t.raw, *served_model(t)), ["predicted"], 3))


@entry("m11_biased_groups", sql(BIASED.format("1.5"), "predicted", more=FRAME))
def _(t: Tables) -> DataFrame:
    return biased(t, 1.5)


BALANCED_FIT = """fitting AS (SELECT 'balanced' AS fit, count(*) OVER () / CAST((SELECT count(DISTINCT zone) FROM learning) * count(*) OVER (PARTITION BY zone) AS DOUBLE) AS w, *
 FROM learning WHERE part = 'train')"""


def frame_sql(scored: str, extra: str = "") -> str:
    """The metric frame of ``scored`` (zone, value, guess) by zone."""
    return f"""SELECT {extra} CASE WHEN grouping(zone) = 1 THEN 'overall' ELSE 'group' END AS scope, zone,
 {rq('avg((value - guess) * (value - guess))')} AS mse, {rq('avg(abs(value - guess))')} AS mae, count(*) AS rows FROM {scored} GROUP BY GROUPING SETS ((zone), ())"""


@entry("m12_reweighted_fit", sql(
    frame_sql("scored"), "keyed", recursive=True,
    more=f"""{LEARNING}, {BALANCED_FIT}, {line_sql('fitting', FEATURES)},
    scored AS (SELECT zone, value, {guess_sql(FEATURES)} AS guess FROM learning, line WHERE part = 'test')"""))
def _(t: Tables) -> DataFrame:
    split = checkpointed(splits.stratified_split(learning_table(t), ["zone"], "row_id"))
    _, after = models.mitigate(split.filter("split = 'train'"), split.filter("split = 'test'"), "zone", "linear", FEATURES)
    return rounded(after, ["mse", "mae"])


BEFORE_AFTER = """pairs AS (SELECT zone, avg(abs(value - guess)) AS before, avg(abs(value - (value + guess) / 2.0::DOUBLE)) AS after
 FROM predicted GROUP BY 1)"""


@entry("m13_may_serve", sql("SELECT zone, round(after, 4) <= round(before, 4) AS serve FROM pairs", "predicted", more=BEFORE_AFTER))
def _(t: Tables) -> DataFrame:
    blend = (F.col("value") + F.col("guess")) / F.lit(2.0)
    pairs = t.predicted.groupBy("zone").agg(
        F.avg(F.abs(F.col("value") - F.col("guess"))).alias("before"), F.avg(F.abs(F.col("value") - blend)).alias("after"))
    return pairs.select("zone", registry.may_serve(F.col("before"), F.col("after")).alias("serve"))


@entry("m14_metric_gate", sql(
    """SELECT run_id, coalesce("MSE" <= 0.05 AND "MAE" <= 0.08 AND "R2" >= 0.4, FALSE) AS passes FROM runs""", "predicted", more=RUNS))
def _(t: Tables) -> DataFrame:
    metric = F.col("metrics")
    gate = registry.passes_gate(metric["MSE"], metric["MAE"], metric["R2"], 0.05, 0.08, 0.4)
    return runs(t).select("run_id", gate.alias("passes"))


@entry("m15_registrable_runs", sql("""SELECT run_id FROM runs WHERE "R2" > 0.3 AND "MSE" < 0.01""", "predicted", more=RUNS))
def _(t: Tables) -> DataFrame:
    return registry.registrable(runs(t)).select("run_id")


@entry("m16_promote", sql(
    """SELECT name, version, CASE WHEN best AND version = newest THEN 'Production' WHEN best AND stage = 'Production' THEN 'Archived'
    ELSE stage END AS stage FROM (SELECT *, max(version) OVER w AS newest,
     max(CASE WHEN stage = 'Production' THEN 1 END) OVER w IS NULL OR
     max(CASE WHEN version = latest THEN coalesce("R2", '-inf'::DOUBLE) END) OVER w
      > max(CASE WHEN stage = 'Production' THEN coalesce("R2", '-inf'::DOUBLE) END) OVER w AS best
     FROM (SELECT *, max(version) OVER (PARTITION BY name) AS latest FROM versions) WINDOW w AS (PARTITION BY name))""",
    "predicted", more=f"{RUNS}, {VERSIONS}"))
def _(t: Tables) -> DataFrame:
    listed = versions(t)
    newest = listed.groupBy("name").agg(F.max("version").alias("candidate"))
    return registry.promote(listed, runs(t), newest).select("name", "version", "stage")


@entry("m17_roll_back", sql(
    """SELECT name, version, CASE WHEN target IS NULL THEN stage WHEN version = target THEN 'Production'
    WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage
    FROM (SELECT *, max(CASE WHEN stage = 'Production' THEN previous END) OVER (PARTITION BY name) AS target
     FROM (SELECT *, lag(version) OVER (PARTITION BY name ORDER BY version) AS previous FROM versions))""",
    "predicted", more=f"{RUNS}, {VERSIONS}"))
def _(t: Tables) -> DataFrame:
    return registry.roll_back(versions(t)).select("name", "version", "stage")


@entry("m18_run_table", sql(f"""SELECT run_id, {rq('"R2"')} AS r2, {rq('"MSE"', 9)} AS mse FROM runs""", "predicted", more=RUNS))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "runs")
    registry.log_runs(runs(t).filter("run_id LIKE 'view%'"), path)
    registry.log_runs(runs(t).filter("run_id NOT LIKE 'view%'"), path)
    metric = F.col("metrics")
    return t.spark.read.parquet(path).select("run_id", r(metric["R2"]).alias("r2"), r(metric["MSE"], 9).alias("mse"))


@entry("m19_bias_plot_data", sql(f"SELECT zone, {rq('mae', 4)} AS mae FROM frame WHERE scope = 'group'", "predicted", more=FRAME))
def _(t: Tables) -> DataFrame:
    return frame(t).filter("scope = 'group'").orderBy("zone").select("zone", r("mae", 4).alias("mae"))


@entry("m20_saved_model_metrics", sql(
    f"""SELECT CASE WHEN grouping(zone) = 1 THEN 'overall' ELSE 'group' END AS scope, zone, damp,
    {rq('avg((value - guess) * (value - guess))')} AS mse, {rq('avg(abs(value - guess))')} AS mae, count(*) AS rows
    FROM scored GROUP BY GROUPING SETS ((zone, damp), ())""", "keyed", recursive=True,
    more=f"""{LEARNING}, fitting AS (SELECT 0 AS fit, 1 AS w, * FROM learning WHERE whole = 'train'), {line_sql('fitting', CODED)},
    scored AS (SELECT zone, CASE WHEN humidity_rolling_mean > 0.5 THEN 'high' ELSE 'low' END AS damp, value, {guess_sql(CODED)} AS guess
     FROM learning, line WHERE whole = 'test')"""))
def _(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "models")
    split = checkpointed(splits.random_split(learning_table(t), "row_id"))
    fitted = models.train(split.filter("split = 'train'"), "linear", CODED)
    models.save_model(fitted, folder, "load model", "20240201_000000")
    loaded = models.load_latest(t.spark, folder, "load model")
    scored = loaded.transform(split.filter("split = 'test'"))
    damp = scored.withColumn("damp", bias.high_low(F.col("humidity_rolling_mean"), F.lit(0.5)))
    return rounded(bias.metric_frame(damp, "value", models.PREDICTION, ["zone", "damp"]), ["mse", "mae"])


# ---- registry lookups -------------------------------------------------------------------

@entry("t4_best_run", sql(
    f"""SELECT run_id, {rq('"R2"')} AS score, name AS model_type FROM runs ORDER BY "R2" DESC NULLS LAST, run_id LIMIT 1""",
    "predicted", more=RUNS))
def _(t: Tables) -> DataFrame:
    return registry.best_run(runs(t)).select("run_id", r("score").alias("score"), "model_type")


@entry("t5_latest_archived", sql(
    "SELECT name, max(version) AS version FROM versions WHERE stage = 'Archived' GROUP BY 1", "predicted", more=f"{RUNS}, {VERSIONS}"))
def _(t: Tables) -> DataFrame:
    return registry.latest_archived(versions(t)).select("name", "version")


@entry("t6_current_production", sql(
    "SELECT name, version, run_id FROM versions WHERE stage = 'Production'", "predicted", more=f"{RUNS}, {VERSIONS}"))
def _(t: Tables) -> DataFrame:
    return registry.current_production(versions(t))


@entry("w17_previous_version", sql(
    "SELECT name, version, lag(version) OVER (PARTITION BY name ORDER BY version) AS previous FROM versions",
    "predicted", more=f"{RUNS}, {VERSIONS}"))
def _(t: Tables) -> DataFrame:
    return registry.with_previous(versions(t)).select("name", "version", "previous")


# ---- end to end -------------------------------------------------------------------------

def final_sql(over: str) -> str:
    cells = []
    for c in schemas.FINAL_COLUMNS:
        if c in ("datetime", "zone", "subba-name"):
            cells.append(f'"{c}"')
        else:
            cells.append(f"""{rq(scaled(over)(c), DIGITS)} AS "{c}\"""")
    return ", ".join(cells)


TEXT_TIME = ", ".join(stamp_q("datetime") if c == "datetime" else f'"{c}"' for c in schemas.FINAL_COLUMNS)


def finished(df: DataFrame) -> DataFrame:
    measures = [c for c in df.columns if c not in ("datetime", "zone", "subba-name", "subba-name_code")]
    return timed(rounded(df, measures, DIGITS))


@entry("e1_preprocess", sql(
    f"SELECT {TEXT_TIME} FROM (SELECT {final_sql('PARTITION BY zone')} FROM featured)", "raw", more=FEATURED))
def _(t: Tables) -> DataFrame:
    return finished(jobs.preprocess(t.raw))


@entry("e1_preprocess_global_encoded", sql(
    f"""SELECT {TEXT_TIME}, code AS "subba-name_code" FROM (SELECT {final_sql('')},
    dense_rank() OVER (ORDER BY "subba-name") - 1 AS code FROM featured)""", "raw", more=FEATURED))
def _(t: Tables) -> DataFrame:
    return finished(jobs.preprocess(t.raw, scope="global", encode=True))


CHUNKED = f"""placed AS (SELECT *, row_number() OVER (ORDER BY datetime, zone) AS _at FROM raw),
 chunked AS (SELECT *, (_at - 1) // greatest(1, (SELECT count(*) FROM raw) // 100) AS chunk FROM placed),
 featured AS (SELECT *, {MONTH_SQL} FROM (SELECT *, {FEATURE_SQL}, row_number() OVER w AS _place FROM chunked
  WINDOW w AS (PARTITION BY chunk ORDER BY _at), w6 AS (PARTITION BY chunk ORDER BY _at ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
 WHERE _place > 6)"""


@entry("s2_chunked_preprocess", sql(
    f"SELECT {TEXT_TIME} FROM (SELECT {final_sql('PARTITION BY chunk')} FROM featured)", "raw", more=CHUNKED))
def _(t: Tables) -> DataFrame:
    return finished(jobs.preprocess_chunks(t.raw, rows_per_block=10))


def part_sql(name: str, where: str) -> str:
    """Features and scaling over a part of the raw table."""
    featured = FEATURED.replace("featured AS", f"{name}_featured AS").replace("FROM raw)", f"FROM raw WHERE {where})")
    return f"{featured}, {name} AS (SELECT {final_sql('PARTITION BY zone')} FROM {name}_featured)"


NEWEST = "(SELECT max(datetime) FROM raw)"


@entry("e2_daily_increment", sql(
    f"""SELECT {TEXT_TIME} FROM (SELECT *, row_number() OVER (PARTITION BY zone, datetime ORDER BY src) AS rk
    FROM (SELECT 0 AS src, * FROM history UNION ALL SELECT 1, * FROM batch)) WHERE rk = 1""", "raw",
    more=part_sql("history", f"datetime < {NEWEST} - INTERVAL 3 DAY") + ", "
    + part_sql("batch", f"datetime >= {NEWEST} - INTERVAL 7 DAY")))
def _(t: Tables) -> DataFrame:
    newest = t.raw.agg(F.max("datetime")).scalar()
    history = jobs.preprocess(t.raw.filter(F.col("datetime") < newest - F.expr("INTERVAL 3 DAYS")))
    batch = t.raw.filter(F.col("datetime") >= newest - F.expr("INTERVAL 7 DAYS"))
    rules = [
        quality.ColumnRule("zone", "string", False), quality.ColumnRule("datetime", "timestamp_ntz", False),
        quality.ColumnRule("value", "double", True, 0.0, 1.0)]
    outcome = jobs.daily_increment(history, batch, rules)
    return finished(outcome.merged)


@entry("e2_month_table", ORACLE["e2_daily_increment"])
def _(t: Tables) -> DataFrame:
    newest = t.raw.agg(F.max("datetime")).scalar()
    table, state = scratch_path(t.spark, "table"), scratch_path(t.spark, "state")
    parts = [
        t.raw.filter(F.col("datetime") < newest - F.expr("INTERVAL 3 DAYS")),
        t.raw.filter(F.col("datetime") >= newest - F.expr("INTERVAL 7 DAYS"))]
    rules = [quality.ColumnRule("zone", "string", False), quality.ColumnRule("value", "double", True, 0.0, 1.0)]
    for part in parts:
        outcome = jobs.daily_increment(None, part, rules, table=table, state=state)
    return finished(outcome.merged)


@entry("e2_raw_branch", sql(
    f"SELECT {RAW_LIST} FROM (SELECT * FROM raw WHERE datetime < {NEWEST} - INTERVAL 3 DAY UNION ALL SELECT * FROM raw WHERE datetime >= {NEWEST} - INTERVAL 7 DAY)", "raw"))
def _(t: Tables) -> DataFrame:
    newest = t.raw.agg(F.max("datetime")).scalar()
    store = scratch_path(t.spark, "raw-store")
    jobs.raw_increment(None, t.raw.filter(F.col("datetime") < newest - F.expr("INTERVAL 3 DAYS")), store, keep=1)
    history = snapshots.read_version(t.spark, store)
    jobs.raw_increment(history, t.raw.filter(F.col("datetime") >= newest - F.expr("INTERVAL 7 DAYS")), store, keep=1)
    return timed(snapshots.read_version(t.spark, store))


@entry("e3_collect_dataset", sql(f"SELECT {RAW_LIST} FROM raw", "raw"))
def _(t: Tables) -> DataFrame:
    demand = parsed(demand_payload(t), schemas.DEMAND_PAYLOAD)
    weather = parsed(weather_payload(t), schemas.WEATHER_PAYLOAD)
    table = jobs.collect_dataset(demand, weather)
    return timed(table.select(*[cname(f.name) for f in schemas.RAW_SCHEMA.fields]))


@entry("e4_data_bias", sql(
    f"""SELECT zone, count(*) AS rows, count(value) AS known, min(value) AS low, max(value) AS high FROM (
    SELECT {filled_list(True, True)} FROM gridded WHERE zone IN (SELECT zone FROM flagged)
    UNION ALL SELECT zone, datetime, "tempF", "windspeedMiles", humidity, value FROM patchy WHERE zone NOT IN (SELECT zone FROM flagged))
    GROUP BY 1""", "patchy", more=f"{RATES}, {GRID.format('patchy')}"))
def _(t: Tables) -> DataFrame:
    _, _, mended = jobs.data_bias(t.patchy)
    return mended.groupBy("zone").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("known"), F.min("value").alias("low"), F.max("value").alias("high"))


@entry("e6_train_and_evaluate", sql(
    f"""SELECT *, mse <= 1000 AND mae <= 1000 AND r2 >= 0.7 AS passes, r2 > 0.3 AND mse < 0.01 AS registrable, 'linear_run' AS run_id FROM (
    SELECT part, {METRICS_Q} FROM (SELECT part, value, {guess_sql(CODED)} AS guess FROM learning, line WHERE part <> 'train') GROUP BY 1)""",
    "keyed", recursive=True,
    more=f"{LEARNING}, fitting AS (SELECT 0 AS fit, 1 AS w, * FROM learning WHERE part = 'train'), {line_sql('fitting', CODED)}"))
def _(t: Tables) -> DataFrame:
    runs_path = scratch_path(t.spark, "runs")
    _, metrics = jobs.train_and_evaluate(learning_table(t), "linear", "row_id", CODED, runs=runs_path)
    logged = t.spark.read.parquet(runs_path).select("run_id")
    return rounded(metrics, METRICS).withColumn("run_id", logged.scalar())


@entry("e7_model_bias", sql(
    f"""{frame_sql("(SELECT * FROM scored WHERE fit = 'plain')", "'before' AS run,")} UNION ALL {frame_sql("(SELECT * FROM scored WHERE fit = 'balanced')", "'after' AS run,")}""",
    "keyed", recursive=True,
    more=f"""{LEARNING}, {BALANCED_FIT}, both_fits AS (SELECT * FROM fitting UNION ALL SELECT 'plain', 1, * FROM learning WHERE part = 'train'),
    {line_sql('both_fits', FEATURES)}, scored AS (SELECT fit, zone, value, {guess_sql(FEATURES)} AS guess FROM learning, line WHERE part = 'test')"""))
def _(t: Tables) -> DataFrame:
    run = jobs.model_bias(learning_table(t), "linear", "row_id", FEATURES)
    both = run.before.withColumn("run", F.lit("before")).unionByName(run.after.withColumn("run", F.lit("after")))
    return rounded(both, ["mse", "mae"])


DEPLOYED = {1: "2024-01-01 00:00:00", 2: "2024-01-08 00:00:00"}  # version: its model is fitted on a week from here
GATE_R2 = 0.999


def monitored(t: Tables) -> jobs.Monitoring:
    """Two saved versions of a model, the second in production, monitored on the whole table."""
    table, folder = checkpointed(learning_table(t)), scratch_path(t.spark, "models")
    at = F.col("datetime")
    for number, start in DEPLOYED.items():
        week = table.filter((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(start).cast("timestamp_ntz") + F.expr("INTERVAL 7 DAYS")))
        models.train(week, "linear", FEATURES).save(t.spark, f"{folder}/load_{number}")
    listed = t.spark.createDataFrame(
        [("load", 1, registry.ARCHIVED, "load_1"), ("load", 2, registry.PRODUCTION, "load_2")], registry.VERSION_SCHEMA)
    return jobs.monitor_deployed(
        table, listed, folder, "load", "row_id", FEATURES, min_r2=GATE_R2, drift_columns=["windspeedMiles", "value"])


@entry("e8_monitor", sql(
    f"""SELECT 'metrics' AS finding, 'production' AS item, mse, mae, r2, rows FROM m WHERE fit = 'deployed'
    UNION ALL SELECT 'retrained', 'load_3', mse, mae, r2, rows FROM m WHERE fit = 'fresh' AND (SELECT NOT coalesce(r2 >= {GATE_R2}, FALSE) FROM m WHERE fit = 'deployed')
    UNION ALL SELECT 'model_bias', coalesce(zone, 'overall'), mse, mae, NULL, rows FROM ({frame_sql("(SELECT * FROM scored WHERE fit = 'deployed')")})
    UNION ALL SELECT 'version', stage, NULL, NULL, NULL, CAST(version AS BIGINT) FROM (
      SELECT unnest([1, 2, 3]) AS version, unnest(['Production', 'Archived', 'None']) AS stage, TRUE AS failed
      UNION ALL SELECT unnest([1, 2]), unnest(['Archived', 'Production']), FALSE)
      WHERE failed = (SELECT NOT coalesce(r2 >= {GATE_R2}, FALSE) FROM m WHERE fit = 'deployed')
    """,
    "keyed", recursive=True,
    more=f"""{LEARNING}, fitting AS (SELECT 'deployed' AS fit, 1 AS w, * FROM learning WHERE datetime >= TIMESTAMP '{DEPLOYED[2]}' AND datetime < TIMESTAMP '{DEPLOYED[2]}' + INTERVAL 7 DAY
     UNION ALL SELECT 'fresh', 1, * FROM learning WHERE whole <> 'test'), {line_sql('fitting', FEATURES)},
    scored AS (SELECT fit, zone, value, {guess_sql(FEATURES)} AS guess FROM learning, line WHERE whole = 'test'),
    m AS (SELECT fit, {METRICS_Q} FROM scored GROUP BY 1)"""))
def _(t: Tables) -> DataFrame:
    done = monitored(t)
    number = F.lit(None).cast("double")

    def cells(name: str, item, mse=number, mae=number, r2=number, rows=F.col("rows")) -> DataFrame:
        return done.findings[name].select(
            F.lit(name).alias("finding"), item.alias("item"), mse.alias("mse"), mae.alias("mae"), r2.alias("r2"), rows.alias("rows"))

    found = cells("metrics", F.lit("production"), F.col("mse"), F.col("mae"), F.col("r2"))
    found = found.unionByName(cells("model_bias", F.coalesce("zone", F.lit("overall")), F.col("mse"), F.col("mae")))
    if "retrained" in done.findings:
        found = found.unionByName(cells("retrained", F.lit("load_3"), F.col("mse"), F.col("mae"), F.col("r2")))
    listed = done.versions.select(
        F.lit("version").alias("finding"), F.col("stage").alias("item"), number.alias("mse"), number.alias("mae"), number.alias("r2"),
        F.col("version").alias("rows"))
    return rounded(found.unionByName(listed), METRICS)


@entry("e8_monitor_findings")
def _(t: Tables) -> DataFrame:
    found = monitored(t).findings
    drift = found["report"].select(F.lit("drift").alias("finding"), F.to_json(F.struct("*")).alias("row"))
    for name in ("ks", "psi", "coverage"):
        drift = drift.unionByName(found[name].select(F.lit(name).alias("finding"), F.to_json(F.struct("*")).alias("row")))
    return drift


@entry("e9_feature_importance")
def _(t: Tables) -> DataFrame:
    prepared = checkpointed(models.importance_input(learning_table(t)))
    return jobs.feature_importance(prepared, "row_id", [*FEATURES, "subba-name"], maxIter=3, maxDepth=3)


TICKERS = sorted({c.split(":")[1] for _, _, companies in MARKET_REGIONS for c in companies})
TICKER_SQL = "[" + ", ".join(f"'{x}'" for x in TICKERS) + f"][CAST(o_custkey % {len(TICKERS)} + 1 AS BIGINT)]"
LISTED = f"""prices AS (SELECT {TICKER_SQL} AS ticker, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS "Close", count(*) AS "Volume"
 FROM orders GROUP BY 1, 2), {HISTORY},
 {ITEMS.replace('CAST(o_custkey AS VARCHAR)', TICKER_SQL)}, {SHEET}"""
SEGMENT_ZONES = {"AUTOMOBILE": "click", "BUILDING": "view", "FURNITURE": "purchase", "HOUSEHOLD": "signup", "MACHINERY": "error"}


def listed_orders(t: Tables) -> DataFrame:
    """Orders with one of the listed companies as their ticker."""
    names = F.array(*[F.lit(x) for x in TICKERS])
    return t.orders.withColumn("ticker", F.element_at(names, (F.col("o_custkey") % len(TICKERS) + 1).cast("int")))


def listed_prices(t: Tables) -> DataFrame:
    return listed_orders(t).groupBy("ticker", F.to_date("o_orderdate").alias("date")).agg(
        F.max("o_totalprice").alias("Close"), F.count(F.lit(1)).alias("Volume"))


def listed_items(t: Tables) -> DataFrame:
    return listed_orders(t).groupBy(
        "ticker", F.col("o_orderpriority").alias("item"),
        F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("period")).agg(F.max("o_totalprice").alias("value"))


def located(t: Tables) -> DataFrame:
    """Customers as locations: market region by distance, weather zone by segment."""
    zone = F.create_map(*[F.lit(x) for pair in SEGMENT_ZONES.items() for x in pair])[F.col("c_mktsegment")]
    near = regions.with_region(t.places)
    return near.select(F.col("c_custkey").alias("location"), zone.alias("zone"), "region", "companies")


ZONE_CASE = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_ZONES.items()) + " END"
SHOWN_WEATHER = ["humidity", "windspeedMiles"]


@entry("j11_location_context", sql(
    """SELECT c_custkey AS location, n.zone, n.region, array_to_string(companies, ', ') AS company_list, price_days, highest_close, sheet_items,
    '"humidity": ' || w.humidity || ', "windspeedMiles": ' || w."windspeedMiles" AS weather, w.value AS predicted
    FROM (SELECT *, """ + ZONE_CASE + """ AS zone FROM near) n LEFT JOIN newest w ON w.zone = n.zone
    LEFT JOIN facts f ON f.region = n.region""", "hourly", "places",
    more=f"""{NEAR}, {LISTED}, newest AS (SELECT zone, max_by(humidity, datetime) AS humidity,
     max_by("windspeedMiles", datetime) AS "windspeedMiles", max_by(value, datetime) AS value FROM hourly GROUP BY 1),
    member AS (SELECT region, split_part(unnest(companies), ':', 2) AS ticker FROM regions),
    facts AS (SELECT region, CAST(coalesce(sum(price_days), 0) AS BIGINT) AS price_days, max(last_close) AS highest_close,
     CAST(coalesce(sum(sheet_items), 0) AS BIGINT) AS sheet_items FROM member
     LEFT JOIN (SELECT ticker, count(*) AS price_days, max_by("Close", "Date") AS last_close FROM history GROUP BY 1) USING (ticker)
     LEFT JOIN (SELECT ticker, count(DISTINCT item) AS sheet_items FROM sheet GROUP BY 1) USING (ticker) GROUP BY 1)"""))
def _(t: Tables) -> DataFrame:
    weather = report.newest_weather_text(t.hourly.select("zone", "datetime", *SHOWN_WEATHER), ["zone"], shown=SHOWN_WEATHER)
    latest = t.hourly.groupBy("zone").agg(F.max_by("value", "datetime").alias("predicted"))
    return report.location_report(
        located(t), weather, latest, report.price_history(listed_prices(t)), report.balance_sheet(listed_items(t)))


@entry("e10_location_report")
def _(t: Tables) -> DataFrame:
    model, bounds = served_model(t)
    return jobs.location_reports(located(t), t.raw, model, bounds, listed_prices(t), listed_items(t))


@entry("e11_weekly_chain")
def _(t: Tables) -> DataFrame:
    done = jobs.weekly_chain(learning_table(t), "linear", "row_id", FEATURES)
    _, metrics = done["training"]
    run = done["model_bias"]
    parts = {
        "drift": done["drift"]["report"], "importance": done["importance"], "training": metrics,
        "before": run.before, "affected": run.affected, "after": run.after.withColumn("serve", F.lit(run.serve)),
    }
    found = None
    for name, rows in parts.items():
        told = rows.select(F.lit(name).alias("finding"), F.to_json(F.struct("*")).alias("row"))
        found = told if found is None else found.unionByName(told)
    return found
