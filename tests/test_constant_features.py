"""Fits on tables in which a constant column has scaled to null."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import gram, models, scaling
from gridloom.plans import jobs
from tests.helpers import hour

GOOD, FEATURES = ["x1", "x2"], ["same", "x1", "x2"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        a, b = rng.random(), rng.random()
        rows.append((i, "big" if i % 3 else "small", hour(i), i % 3, 30.0, a, b, 3 * a - 2 * b + 1))
    layout = "row_id bigint, zone string, datetime timestamp_ntz, fold int, same double, x1 double, x2 double, value double"
    return scaling.scale_min_max(spark.createDataFrame(rows, layout), (), ["same", "x1", "x2", "value"]).cache()


def close(found):
    assert found.rows == 300 and found.mse == pytest.approx(0, abs=1e-9) and found.r2 == pytest.approx(1)


@pytest.mark.parametrize("kind", ["linear", "lr"])
def test_line_without_the_constant_column(table, kind):
    assert gram.known_features(table, FEATURES) == GOOD
    close(models.evaluate(models.train(table, kind, FEATURES), table).first())


def test_weights_folds_and_saved_models_without_the_constant_column(spark, table, tmp_path):
    run = jobs.model_bias(table, "linear", "row_id", FEATURES)
    assert run.after.where("scope = 'overall'").first().mae == pytest.approx(0, abs=1e-9)
    _, after = models.mitigate(table, table, "zone", "lr", FEATURES)
    assert after.where("scope = 'overall'").first().mae == pytest.approx(0, abs=1e-6)
    folds = gram.cross_validate(table, FEATURES, "fold").collect()
    assert [r.rows for r in folds] == [100, 100, 100] and all(r.mse < 1e-9 for r in folds)
    models.save_model(models.train(table, "linear", FEATURES), str(tmp_path), "line", "20240101_000000")
    close(models.evaluate(models.load_latest(spark, str(tmp_path), "line"), table).first())


def test_trees_are_fitted_without_the_constant_column(table):
    assert models.train(table, "xgboost", FEATURES, maxIter=2).transform(table).count() == 300


def test_a_text_feature_without_values_and_a_table_without_rows(table):
    texts = table.withColumn("label", F.lit(None).cast("string"))
    assert gram.known_features(texts, [*FEATURES, "label"]) == [*GOOD, "label"]
    with pytest.raises(ValueError, match="no complete rows"):
        models.train(table.where("false"), "linear", FEATURES)


def test_search_without_the_constant_column(table):
    _, tried = models.search_boosted_trees(table, FEATURES, grid={"maxIter": [2], "maxDepth": [2]}, picks=1, folds=2)
    assert len(tried) == 1


def test_folds_of_trees_without_the_constant_column(table):
    trees = models.boosted_trees(gram.known_features(table, FEATURES), maxIter=2, maxDepth=2)
    assert [r.rows for r in models.cross_validate(table, trees, "fold", 3).orderBy("fold").collect()] == [100, 100, 100]


def test_the_constant_column_is_eliminated_first(table):
    assert models.eliminate_features(table, FEATURES, 2, maxIter=2, maxDepth=2) == GOOD


def test_the_constant_column_has_no_importance(table):
    found = {r.feature: r for r in jobs.feature_importance(table, "row_id", FEATURES, maxIter=3, maxDepth=3).collect()}
    assert sorted(found) == ["same", "x1", "x2"] and found["x1"].increase > 0 and found["x2"].split_gain > 0
    assert found["same"].increase == pytest.approx(0, abs=1e-12) and found["same"].split_gain == 0
