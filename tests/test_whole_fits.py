"""Registered tree queries do their whole job: the search space and the trees of the original."""

import inspect

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from gridloom.operators import models
from gridloom.plans.catalog import QUERIES


def test_m3_searches_the_whole_grid(spark, folder, monkeypatch):
    search, asked = models.search_boosted_trees, {}

    def spy(*args, **kwargs):
        given = inspect.signature(search).bind(*args, **kwargs)
        given.apply_defaults()
        asked.update(given.arguments)
        return None, [({"maxIter": 100}, 0.5)]

    monkeypatch.setattr(models, "search_boosted_trees", spy)
    QUERIES["m3_tree_search"](spark, folder).collect()
    assert asked["grid"] == {
        "stepSize": [0.01, 0.05, 0.1], "maxIter": [100, 500, 1000], "maxDepth": [3, 5, 7], "minInstancesPerNode": [1, 3, 5],
    }
    assert (asked["picks"], asked["folds"]) == (2, 5)


def test_search_is_that_of_the_cross_validator(spark):
    table = spark.range(400, numPartitions=3).select("id", F.rand(1).alias("x1"), F.rand(2).alias("x2"))
    table = table.withColumn("value", 3 * F.col("x1") - F.col("x2") + 0.1 * F.randn(3)).localCheckpoint()
    grid = {"maxIter": [2, 5], "maxDepth": [2, 3]}
    model, tried = models.search_boosted_trees(table, ["x1", "x2"], grid=grid, picks=3, folds=3)
    fit = GBTRegressor(labelCol="value", seed=42)
    found = CrossValidator(
        estimator=Pipeline(stages=[models._assembler(["x1", "x2"]), fit]), numFolds=3, seed=42,
        estimatorParamMaps=[{fit.getParam(k): v for k, v in s.items()} for s, _ in tried],
        evaluator=RegressionEvaluator(labelCol="value", metricName="mse"),
    ).fit(table)
    assert [e for _, e in tried] == pytest.approx(found.avgMetrics)
    assert model.stages[-1].toDebugString.split("\n")[1:] == found.bestModel.stages[-1].toDebugString.split("\n")[1:]


#: Trees, depth and step of the original regressor.
WHOLE = (100, 6, 0.3)


def asked_trees(monkeypatch):
    """Trees, depth and step of every fit of boosted trees that is asked for; the fits themselves are short."""
    trees, asked = models.boosted_trees, []

    def spy(*args, **kwargs):
        fit = trees(*args, **kwargs).getStages()[-1]
        asked.append((fit.getMaxIter(), fit.getMaxDepth(), fit.getStepSize()))
        return trees(*args, **kwargs | {"maxIter": 1, "maxDepth": 2})

    monkeypatch.setattr(models, "boosted_trees", spy)
    return asked


def test_m5_eliminates_by_whole_fits(spark, folder, monkeypatch):
    asked = asked_trees(monkeypatch)
    assert len(QUERIES["m5_feature_elimination"](spark, folder).collect()) == 20
    assert asked and set(asked) == {WHOLE}


def test_m8_trains_whole_trees(spark, folder, monkeypatch):
    asked = asked_trees(monkeypatch)
    assert sorted(r.kind for r in QUERIES["m8_train_since_date"](spark, folder).collect()) == ["lr", "xgboost"]
    assert asked == [WHOLE]
