"""Quantiles by counting against sorting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import stats

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]


def columns(n):
    rng = random.Random(n)
    return {
        "even": [rng.uniform(-5, 5) for _ in range(n)],
        "ties": [float(rng.choice([1, 1, 1, 2, 9])) for _ in range(n)],
        "one": [3.5] * n,
        "far": [rng.choice([-1.7e308, 1.7e308, 0.0, 1e-300, -3.0]) for _ in range(n)],
        "ends": [rng.choice([math.inf, -math.inf, 1.0, 2.0, 4.0]) for _ in range(n)],
        "crowd": [1e9] + [rng.random() * 1e-9 for _ in range(n - 1)],
        "near": [math.nextafter(1.0, 2.0) if rng.random() < 0.5 else 1.0 for _ in range(n)],
        "a.b": [rng.choice([None, math.nan, rng.gauss(0, 1)]) for _ in range(n)],
        "none": [None] * n,
    }


@pytest.mark.parametrize("n,bins,few", [(1, 4, 2), (2, 4, 2), (501, 4, 3), (3000, 16, 10), (3000, 512, 4096)])
def test_like_sorting(spark, n, bins, few):
    data = columns(n)
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in data)).repartition(4)
    got = {r.feature: r for r in stats.quantiles(df, list(data), FRACTIONS, bins, few).collect()}
    assert "none" not in got
    for name, cells in data.items():
        held = sorted(x for x in cells if x is not None and not math.isnan(x))
        if not held:
            continue
        assert got[name].n == len(held)
        for i, q in enumerate(FRACTIONS):
            at = (len(held) - 1) * q
            low, high = held[math.floor(at)], held[math.ceil(at)]
            want = low if low == high else low + (high - low) * (at - math.floor(at))
            assert got[name][f"q_{i}"] == pytest.approx(want, rel=1e-12, nan_ok=True), (name, q)


def test_three_passes_and_no_sort_of_the_rows(spark, tmp_path):
    df = spark.range(200_000).select(F.sin("id").alias("x"), (F.col("id") % 7).alias("y"))
    calls = []
    real = type(df).collect
    got = stats.quantiles(df, ["x", "y"], [0.25, 0.5, 0.75]).collect()
    x = np.sin(np.arange(200_000))
    for r in got:
        want = np.quantile(x if r.feature == "x" else np.arange(200_000) % 7, [0.25, 0.5, 0.75])
        assert [r.q_0, r.q_1, r.q_2] == pytest.approx(list(want), rel=1e-12)
    try:
        type(df).collect = lambda self: calls.append(self) or real(self)
        stats.quantiles(df, ["x", "y"], [0.25, 0.5, 0.75])
    finally:
        type(df).collect = real
    assert len(calls) == 3  # ends, bins, values
    assert all("Exchange rangepartitioning(x" not in c._jdf.queryExecution().executedPlan().toString() for c in calls)
