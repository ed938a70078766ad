"""Model jobs and registry rules."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import bias, models, registry, report, scaling, stats, windows
from gridloom.plans import jobs
from tests.helpers import as_set, hour, series

FEATURES = ["x1", "x2", "noise"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        a, b, c = (rng.random() for _ in range(3))
        zone = "big" if i % 3 else "small"
        rows.append((i, zone, hour(i), a, b, c, 3 * a - 2 * b + 1 + (0.5 if zone == "small" else 0)))
    layout = "row_id bigint, zone string, datetime timestamp_ntz, x1 double, x2 double, noise double, value double"
    return spark.createDataFrame(rows, layout).cache()


def test_line_is_recovered(table):
    model = models.train(table.filter("zone = 'big'"), "lr", FEATURES)
    fit = model.stages[-1]
    assert list(fit.coefficients) == pytest.approx([3, -2, 0], abs=1e-6)
    assert fit.intercept == pytest.approx(1, abs=1e-6)
    metrics = models.evaluate(model, table.filter("zone = 'big'")).first()
    assert metrics.r2 == pytest.approx(1) and metrics.mse == pytest.approx(0, abs=1e-9)


def test_lasso_drops_the_noise(table):
    fit = models.train(table, "lasso", FEATURES, alpha=0.05).stages[-1]
    assert fit.coefficients[2] == 0 and fit.coefficients[0] > 0 > fit.coefficients[1]


def test_fit_since_a_date_uses_later_rows_only(table):
    marked = table.withColumn("value", F.when(F.col("row_id") < 300, F.lit(100.0)).otherwise(F.col("x1")))
    fit = models.train(marked, "lr", FEATURES, since=str(hour(300))).stages[-1]
    assert list(fit.coefficients) == pytest.approx([1, 0, 0], abs=1e-6)


def test_unknown_model_type(table):
    with pytest.raises(ValueError, match="unknown model type"):
        models.estimator_for("lstm", FEATURES)


def test_search_tries_different_settings_and_refits(table):
    grid = {"maxIter": [2, 4], "maxDepth": [2, 3]}
    model, tried = models.search_boosted_trees(table, FEATURES, grid=grid, picks=2, folds=2)
    assert len(tried) == 2 and tried[0][0] != tried[1][0]
    assert models.evaluate(model, table).first().r2 > 0.3


def test_importance_ranks_noise_last(table):
    found = jobs.feature_importance(table, "row_id", FEATURES, maxIter=5, maxDepth=3).collect()
    order = [r.feature for r in sorted(found, key=lambda r: -r.increase)]
    assert order == ["x1", "x2", "noise"]
    assert models.eliminate_features(table, FEATURES, 2, maxIter=3, maxDepth=3) == ["x1", "x2"]


def test_permutation_is_a_permutation(table):
    """With one block, shifted values are the same multiset: the mse of a label copy shows it."""
    copy = table.withColumn("copy", F.col("value"))
    model = models.train(copy, "lr", ["copy"])
    found = models.permutation_importance(copy, model, ["copy"], "row_id").first()
    spread = table.agg(F.var_pop("value")).first()[0]
    assert 0.5 * 2 * spread < found.mse < 1.5 * 2 * spread


def test_balanced_weights_sum_to_equal_shares(table):
    found = bias.balanced_weights(table, "zone").groupBy("zone").agg(F.sum("weight").alias("w")).collect()
    assert {r.zone: round(r.w, 6) for r in found} == {"big": 300.0, "small": 300.0}


def test_model_bias_run(table):
    run = jobs.model_bias(table, "lr", "row_id", FEATURES)
    before = {r.zone: r.mae for r in run.before.filter("scope = 'group'").collect()}
    after = {r.zone: r.mae for r in run.after.filter("scope = 'group'").collect()}
    # Re-weighting moves the fit towards the smaller group.
    assert after["small"] < before["small"] and after["big"] > before["big"]
    overall = [f.filter("scope = 'overall'").first().mae for f in (run.before, run.after)]
    assert run.serve == (round(overall[1], 4) <= round(overall[0], 4))


def test_biased_group_rule(spark):
    df = spark.createDataFrame([("a", 1.0, 1.1), ("a", 1.0, 1.1), ("b", 1.0, 5.0), ("b", 1.0, 1.1)], "g string, y double, p double")
    frame = bias.metric_frame(df, "y", "p", ["g"])
    found = {r.g: round(r.mae_difference, 6) for r in bias.biased_groups(frame, "mae", 0.5).collect()}
    assert found == {"a": 0.975, "b": 0.975}
    assert bias.biased_groups(frame, "mae", 1.5).count() == 0
    ratios = bias.metric_ratios(frame, "mae").first()
    assert ratios.ratio_min_max == pytest.approx(0.1 / 2.05) and ratios.ratio_max_min == pytest.approx(20.5)


def test_saved_model_is_found_by_newest_stamp(spark, table, tmp_path):
    folder = str(tmp_path)
    old = models.train(table.withColumn("value", F.lit(0.0)), "lr", FEATURES)
    new = models.train(table, "lr", FEATURES)
    models.save_model(new, folder, "lr model", "20240202_000000")
    models.save_model(old, folder, "lr model", "20240101_000000")
    loaded = models.load_latest(spark, folder, "lr model")
    assert loaded.stages[-1].coefficients == new.stages[-1].coefficients
    with pytest.raises(FileNotFoundError):
        models.load_latest(spark, folder, "other")


def test_newest_hour_is_scored_once_per_location(spark):
    weather = series(spark, {"a": 30, "b": 9, "c": 6})
    bounds = {c: (-200.0, 300.0) for c in ("tempF", "windspeedMiles", "humidity", "value")}
    for c in ("tempF", "windspeedMiles", "humidity"):
        bounds.update({f"{c}_rolling_mean": (-200.0, 300.0), f"{c}_rolling_std": (0.0, 300.0)})
        bounds.update({f"{c}_lag_{n}": (-200.0, 300.0) for n in (2, 4, 6)})
    ready = scaling.scale_with_map(windows.cyclic_month(windows.engineer_features(weather)), bounds)
    model = models.train(ready, "lr", ["tempF_rolling_mean", "humidity_lag_6"])
    found = {r.zone: r.datetime for r in models.score_newest(weather, model, bounds).collect()}
    newest = {r.zone: r.t for r in weather.groupBy("zone").agg(F.max("datetime").alias("t")).collect()}
    # A location needs seven hours; "c" has six.
    assert found == {z: newest[z] for z in ("a", "b")}


def test_regression_metrics_on_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "y double, p double")
    found = stats.regression_metrics(df, "y", "p").first()
    assert (found.mse, found.mae, found.r2) == (0.25, 0.5, None)


# ---- registry ---------------------------------------------------------------------------

def listed(spark, rows):
    return spark.createDataFrame([(n, v, s, f"{n}{v}") for n, v, s in rows], registry.VERSION_SCHEMA)


def scored(spark, scores):
    rows = [(k, f"lr_{k}", {"R2": v, "MSE": 0.001} if v is not None else {"MSE": 0.001}, None) for k, v in scores.items()]
    return spark.createDataFrame(rows, registry.RUN_SCHEMA)


VERSIONS = [("m", 1, "Archived"), ("m", 2, "Archived"), ("m", 3, "Production"), ("m", 4, "None"), ("fresh", 1, "None")]
SCORES = {"m1": 0.61, "m2": 0.70, "m3": 0.74, "m4": 0.79, "fresh1": 0.1}


def stages(df):
    return {(r.name, r.version): r.stage for r in df.collect()}


def test_better_candidate_is_promoted(spark):
    candidates = spark.createDataFrame([("m", 4), ("fresh", 1)], "name string, candidate bigint")
    found = stages(registry.promote(listed(spark, VERSIONS), scored(spark, SCORES), candidates))
    assert found[("m", 4)] == "Production" and found[("m", 3)] == "Archived" and found[("fresh", 1)] == "Production"


def test_worse_candidate_is_not_promoted(spark):
    versions, runs = listed(spark, VERSIONS), scored(spark, {**SCORES, "m4": 0.74})
    candidates = spark.createDataFrame([("m", 4)], "name string, candidate bigint")
    assert stages(registry.promote(versions, runs, candidates)) == stages(versions)


def test_roll_back_swaps_with_the_version_before(spark):
    found = stages(registry.roll_back(listed(spark, VERSIONS)))
    assert found[("m", 2)] == "Production" and found[("m", 3)] == "Archived"
    only = listed(spark, [("m", 1, "Production")])
    assert stages(registry.roll_back(only)) == stages(only)


def test_registry_lookups(spark):
    versions = listed(spark, VERSIONS)
    assert [(r.name, r.version) for r in registry.latest_archived(versions).collect()] == [("m", 2)]
    assert [(r.name, r.version) for r in registry.current_production(versions).collect()] == [("m", 3)]
    best = registry.best_run(scored(spark, {**SCORES, "none": None})).first()
    assert (best.run_id, best.model_type) == ("m4", "lr")
    moved = registry.move_stage(versions, "m", 4, "Staging")
    assert stages(moved)[("m", 4)] == "Staging"


def test_gates(spark):
    runs = scored(spark, {"a": 0.31, "b": 0.30, "c": None})
    assert [r.run_id for r in registry.registrable(runs).collect()] == ["a"]
    row = spark.range(1).select(
        registry.passes_gate(F.lit(1000.0), F.lit(1000.0), F.lit(0.7)).alias("edge"),
        registry.passes_gate(F.lit(1.0), F.lit(1.0), F.lit(None).cast("double")).alias("missing"),
        registry.may_serve(F.lit(0.12344), F.lit(0.12341)).alias("same"),
        registry.may_serve(F.lit(0.1234), F.lit(0.1236)).alias("worse")).first()
    assert tuple(row) == (True, False, True, False)


def test_monitoring_rolls_back_on_a_failed_gate(spark, table):
    versions = listed(spark, VERSIONS)
    noise = table.withColumn("value", F.rand(1))
    passed, after, findings = jobs.monitor(noise, versions, "lr", "row_id", FEATURES)
    assert not passed and stages(after)[("m", 2)] == "Production"
    good, same, _ = jobs.monitor(table, versions, "lr", "row_id", FEATURES)
    assert good and stages(same) == stages(versions)
    assert {"report", "ks", "psi", "coverage", "metrics"} <= set(findings)


# ---- report -----------------------------------------------------------------------------

def test_balance_sheet_keeps_full_items_of_the_newest_periods(spark):
    cells = [("T", "cash", y, 1.0) for y in (2020, 2021, 2022, 2023)] + [("T", "debt", 2023, 2.0), ("T", "debt", 2022, 2.0)]
    cells += [("T", "tax", y, None if y == 2022 else 3.0) for y in (2021, 2022, 2023)] + [("U", "cash", 2023, 9.0)]
    df = spark.createDataFrame(cells, "ticker string, item string, period int, value double")
    assert as_set(report.balance_sheet(df)) == sorted(
        repr(("T", "cash", y, 1.0)) for y in (2021, 2022, 2023)) + [repr(("U", "cash", 2023, 9.0))]


def test_price_history_is_the_last_year(spark):
    days = ["2023-01-31", "2023-02-01", "2023-08-01", "2024-02-01"]
    df = spark.createDataFrame([("T", d, 1.0, 5) for d in days], "ticker string, date string, Close double, Volume bigint")
    found = report.price_history(df.withColumn("date", F.to_date("date")))
    assert sorted(r.Date for r in found.collect()) == days[1:]
    assert found.columns == ["ticker", "Date", "Close", "Volume"]


# ---- closed-form models -----------------------------------------------------------------

def test_text_features_are_coded_by_a_stage_of_the_model(spark, table, tmp_path):
    features = [*FEATURES, "zone"]
    for kind, params in (("linear", {}), ("lr", {}), ("xgboost", {"maxIter": 2, "maxDepth": 2})):
        model = models.train(table, kind, features, **params)
        new = table.limit(2).withColumn("zone", F.lit("never seen")).unionByName(table.limit(1).withColumn("zone", F.lit(None).cast("string")))
        scored = model.transform(new)
        assert scored.select("zone", "prediction").where("prediction IS NOT NULL").count() == 3
        if kind == "linear":
            assert model.labels == {"zone": ("big", "small")} and scored.columns == [*new.columns, "prediction"]
            assert [r.zone for r in model.encoded(new).select("zone").collect()] == [2.0, 2.0, 2.0]
            assert models.evaluate(model, table).first().r2 == pytest.approx(1)
    models.save_model(model, str(tmp_path), "trees", "2")
    again = models.load_latest(spark, str(tmp_path), "trees").transform(new).select("prediction").collect()
    assert again == scored.select("prediction").collect()


def test_linear_model_is_saved_and_found_by_its_whole_name(spark, table, tmp_path):
    folder = str(tmp_path)
    names = [("lr", "1"), ("lr", "20"), ("lr_2", "30"), ("lr 2", "40")]
    for i, (name, stamp) in enumerate(names):
        models.save_model(models.LinearModel({"z": ("é",)}, models.gram.LinearFit(("a.b",), (float(i),), 0.5)), folder, name, stamp)
    found = models.load_latest(spark, folder, "lr")
    assert found.fit.coefficients == (1.0,) and found.labels == {"z": ("é",)}
    assert models.load_latest(spark, folder, "lr_2").fit.coefficients == (2.0,)
    with pytest.raises(FileNotFoundError):
        models.load_latest(spark, folder, "l")
    with pytest.raises(FileNotFoundError):
        models.load_latest(spark, f"{folder}/none", "lr")


def test_balanced_closed_form_equals_weights_per_row(table):
    plain = models.train(table, "linear", FEATURES)
    balanced, _ = models.mitigate(table, table, "zone", "linear", FEATURES)
    weighted = bias.balanced_weights(table, "zone", "w")
    assert balanced.fit.coefficients == pytest.approx(models.train_linear(weighted, FEATURES, weight="w").fit.coefficients)
    assert plain.fit.intercept != pytest.approx(balanced.fit.intercept, abs=1e-3)


def test_closed_forms_equal_the_iterative_fits(table):
    for kinds, params in ((("linear", "lr"), {}), (("linear_lasso", "lasso"), {"alpha": 0.02})):
        a, b = (models.train(table, k, FEATURES, **params) for k in kinds)
        fit = b.stages[-1]
        assert a.fit.coefficients == pytest.approx(list(fit.coefficients), abs=1e-4)
        assert a.fit.intercept == pytest.approx(fit.intercept, abs=1e-4)


def test_monitoring_scores_the_deployed_model(spark, table, tmp_path):
    folder, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    good = models.train(table, "linear", FEATURES)
    bad = models.LinearModel({}, models.gram.LinearFit(tuple(FEATURES), (0.0, 0.0, 0.0), 99.0))
    good.save(spark, f"{folder}/m_1")
    bad.save(spark, f"{folder}/m_2")
    listed = spark.createDataFrame(
        [("m", 1, "Archived", "m_1"), ("m", 2, "Production", "m_2"), ("other", 7, "Production", "x")], registry.VERSION_SCHEMA)
    failed = jobs.monitor_deployed(table, listed, folder, "m", "row_id", FEATURES, runs=runs)
    assert not failed.passed and failed.findings["metrics"].first().mae > 90
    got = {(r.name, r.version): (r.stage, r.run_id) for r in failed.versions.collect()}
    assert got == {("m", 1): ("Production", "m_1"), ("m", 2): ("Archived", "m_2"), ("m", 3): ("None", "m_3"), ("other", 7): ("Production", "x")}
    assert models.evaluate(models.LinearModel.load(spark, f"{folder}/m_3"), table).first().r2 > 0.9
    assert [r.run_id for r in spark.read.parquet(runs).collect()] == ["m_3"]
    passed = jobs.monitor_deployed(table, failed.versions, folder, "m", "row_id", FEATURES)
    assert passed.passed and passed.versions is failed.versions
    assert {"report", "ks", "psi", "coverage", "model_bias", "metrics"} <= set(passed.findings)
