"""Fits and correlations from sums against numpy on all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import gram


def rows(n=400, k=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * [1, 10, 0.1, 1, 1][:k] + [0, 1000, 0, 5, 0][:k]
    x[:, 3] = 2 * x[:, 0] - x[:, 2] + 3  # explained by the others
    y = 1 + x[:, 0] - 0.01 * x[:, 1] + rng.normal(size=n)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = rows()
    cells = [(*map(float, a), float(b), i % 3, "ab"[i % 4 == 0], 1.0 + i % 2) for i, (a, b) in enumerate(zip(x, y))]
    cells += [(None, 1.0, 1.0, 1.0, 1.0, 1.0, 0, "a", 1.0), (1.0, 1.0, 1.0, 1.0, float("nan"), 1.0, 0, "a", 1.0)]
    layout = "`x.0` double, x1 double, x2 double, x3 double, x4 double, value double, fold int, g string, w double"
    return spark.createDataFrame(cells, layout).repartition(5)


FEATURES = ["x.0", "x1", "x2", "x3", "x4"]


def least_squares(x, y, w=None):
    w = np.sqrt(np.ones(len(y)) if w is None else w)[:, None]
    full = np.column_stack([np.ones(len(y)), x])
    return full @ np.linalg.lstsq(full * w, y * w[:, 0], rcond=None)[0]


def predicted(fit, x):
    return fit.intercept + x @ np.array(fit.coefficients)


@pytest.mark.parametrize("weight", [None, "w"])
def test_least_squares_with_a_dependent_column(table, weight):
    x, y = rows()
    fit = gram.fitted(table, FEATURES, weight=weight)
    w = None if weight is None else 1.0 + np.arange(len(y)) % 2
    assert np.allclose(predicted(fit, x), least_squares(x, y, w), atol=1e-7)
    assert fit.coefficients[3] == 0.0
    assert gram.LinearFit.from_json(fit.to_json()) == fit
    scored = fit.transform(table).where("prediction IS NOT NULL").count()
    assert scored == 401  # a null feature has no prediction; NaN stays


@pytest.mark.parametrize("alpha", [0.001, 0.1, 1.0, 100.0])
def test_lasso_meets_the_optimum(table, alpha):
    x, y = rows()
    fit = gram.fitted(table, FEATURES, alpha=alpha)
    left = y - predicted(fit, x)
    slope = (x - x.mean(0)).T @ left / len(y)
    for b, s in zip(fit.coefficients, slope):
        assert abs(s - alpha * np.sign(b)) < 1e-6 if b else abs(s) <= alpha + 1e-6
    assert abs(left.mean()) < 1e-8


def test_folds_and_groups_from_one_scan(table):
    x, y = rows()
    fold = np.arange(len(y)) % 3
    got = {(r.alpha, r.fold): r for r in gram.cross_validate(table, FEATURES, "fold", alphas=(0.0, 0.1)).collect()}
    assert len(got) == 6
    for i in range(3):
        train, test = fold != i, fold == i
        full = np.column_stack([np.ones(train.sum()), x[train]])
        b = np.linalg.lstsq(full, y[train], rcond=None)[0]
        left = y[test] - np.column_stack([np.ones(test.sum()), x[test]]) @ b
        r = got[0.0, i]
        assert np.allclose([r.mse, r.mae, r.r2], [(left**2).mean(), abs(left).mean(), 1 - (left**2).mean() / y[test].var()], atol=1e-6)
        assert r.rows == test.sum()
    groups = gram.matrices(gram.gram_sums(table, FEATURES, by=["g"]), ["g"])
    share = {"a": (np.arange(len(y)) % 4 != 0), "b": (np.arange(len(y)) % 4 == 0)}
    w = sum(m * len(y) / (2 * m.sum()) for m in share.values())
    assert np.allclose(predicted(gram.solve(gram.balanced(groups), FEATURES), x), least_squares(x, y, w), atol=1e-7)


def test_many_groups_and_null_groups(spark):
    df = spark.range(3000).select((F.col("id") % 700).alias("g"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("value"))
    df = df.withColumn("g", F.when(F.col("g") != 3, F.col("g")))
    sums = {r.g: r.sums for r in gram.gram_sums(df, ["x"], by=["g"]).collect()}
    assert len(sums) == 700 and sums[None][0] == 5 and sums[5][1] == 5 + 705 + 1405 + 2105 + 2805


def test_correlations_over_known_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) + 1e6
    x[:, 1] += 3 * (x[:, 0] - 1e6)
    x[:, 4] = 7.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = np.nan
    df = spark.createDataFrame([[None if np.isnan(c) and i % 2 else float(c) for c in r] for i, r in enumerate(x)], ", ".join(f"c{i} double" for i in range(6)))
    got = gram.correlation_matrix(df, df.columns)
    for i in range(6):
        for j in range(6):
            known = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if i in (4, 5) or j in (4, 5):
                assert np.isnan(got[i, j])
            else:
                assert abs(got[i, j] - np.corrcoef(x[known, i], x[known, j])[0, 1]) < 1e-9


def test_three_hundred_columns(spark):
    df = spark.range(200).select(*[F.sin(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(300)])
    x = np.array(df.collect())
    assert np.allclose(gram.correlation_matrix(df, df.columns), np.corrcoef(x.T), atol=1e-9)
