"""Drift measures against numpy and hand-computed numbers."""

import math
import random

import numpy as np
import pytest

from gridloom.operators import drift
from gridloom.plans import jobs
from pyspark.sql import functions as F


def frames(spark, old, new):
    return [spark.createDataFrame([(float(x),) for x in part], "x double") for part in (old, new)]


def counts(spark, old, new):
    return drift.sample_counts(*frames(spark, old, new), ["x"])


def samples(seed, n, m, shift=0.0):
    rng = random.Random(seed)
    return [round(rng.gauss(50, 10), 1) for _ in range(n)], [round(rng.gauss(50 + shift, 12), 1) for _ in range(m)]


def brute_gap_and_area(old, new):
    grid = sorted(set(old) | set(new))
    f = [np.searchsorted(np.sort(part), grid, side="right") / len(part) for part in (old, new)]
    gap = np.abs(f[0] - f[1])
    return gap.max(), float((gap[:-1] * np.diff(grid)).sum())


@pytest.mark.parametrize("seed, n, m, shift", [(1, 400, 300, 0), (2, 500, 40, 6), (3, 3, 900, 1)])
def test_ks_and_wasserstein(spark, seed, n, m, shift):
    old, new = samples(seed, n, m, shift)
    gap, area = brute_gap_and_area(old, new)
    found = drift.distances(counts(spark, old, new)).first()
    assert found.gap == pytest.approx(gap, abs=1e-12)
    assert found.area == pytest.approx(area, abs=1e-9)
    assert found.spread == pytest.approx(np.std(old), rel=1e-9)
    lam = gap * math.sqrt(n * m / (n + m))
    p = min(1.0, max(0.0, 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))))
    tested = drift.ks_test(counts(spark, old, new)).first()
    assert tested.p_value == pytest.approx(1.0 if lam < 0.2 else p, abs=1e-9)
    assert tested.drift == (tested.p_value < 0.05)


def brute_psi(old, new, edges):
    spans = [(min(old), max(old)), (min(new), max(new))] if edges == "own" else [(min(old), max(old))] * 2
    shares = []
    for part, span in zip((old, new), spans):
        inside = np.clip(part, *span) if edges != "own" else part
        shares.append(np.histogram(inside, bins=10, range=span)[0] / len(part) + 1e-10)
    return float(((shares[0] - shares[1]) * np.log(shares[0] / shares[1])).sum())


@pytest.mark.parametrize("edges", ["own", "baseline"])
def test_psi(spark, edges):
    old, new = samples(5, 600, 250, 8)
    found = drift.psi(counts(spark, old, new), edges=edges).first()
    assert found.psi == pytest.approx(brute_psi(old, new, edges), rel=1e-9)


def test_own_edges_do_not_see_a_shift(spark):
    old = list(range(100))
    assert drift.psi(counts(spark, old, [x + 1000 for x in old])).first().psi == pytest.approx(0, abs=1e-9)
    shifted = drift.psi(counts(spark, old, [x + 1000 for x in old]), edges="baseline").first()
    assert shifted.drift


def test_constant_column_falls_in_the_middle_bin(spark):
    found = drift.histogram(counts(spark, [7.0] * 4, [7.0])).collect()
    assert {(r.side, r.bin, r.n) for r in found} == {(0, 5, 4), (1, 5, 1)}


def test_feature_without_new_rows_is_left_out_of_psi(spark):
    old, new = frames(spark, [1, 2, 3], [])
    assert drift.psi(drift.sample_counts(old, new, ["x"])).count() == 0


def test_missing_values_are_ignored(spark):
    old = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    new = spark.createDataFrame([(None,), (1.0,), (2.0,)], "x double")
    found = drift.ks_test(drift.sample_counts(old, new, ["x"])).first()
    assert (found.statistic, found.p_value) == (0.0, 1.0)


def test_chi2_tail():
    assert drift.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert drift.chi2_tail(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert drift.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert drift.chi2_tail(11.070497693516351, 5) == pytest.approx(0.05, abs=1e-9)
    assert drift.chi2_tail(0.0, 3) == 1.0 and drift.chi2_tail(float("inf"), 3) == 0.0


def test_category_drift(spark):
    layout = "kind string"
    old = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40, layout)
    new = spark.createDataFrame([("a",)] * 30 + [("b",)] * 70, layout)
    found = drift.category_drift(drift.category_counts(old, new, ["kind"])).first()
    assert found.chi2 == pytest.approx(30 ** 2 / 60 + 30 ** 2 / 40)
    assert found.freedom == 1
    p, q = np.array([0.6, 0.4]), np.array([0.3, 0.7])
    m = (p + q) / 2
    js = math.sqrt(((p * np.log(p / m)).sum() + (q * np.log(q / m)).sum()) / 2)
    assert found.js_distance == pytest.approx(js)
    unseen = drift.category_drift(drift.category_counts(old, spark.createDataFrame([("z",)], layout), ["kind"])).first()
    assert math.isinf(unseen.chi2)


def test_report_in_both_forms(spark):
    old, new = samples(8, 300, 300, 15)
    frames_ = [f.withColumn("kind", F.lit("a")) for f in frames(spark, old, new)]
    small = {r.feature: r for r in drift.drift_report(*frames_, ["x"], ["kind"], judge="p_value").collect()}
    assert small["x"].test == "ks_p_value" and small["x"].drift_detected
    assert small["kind"].test == "chi_square_p_value" and not small["kind"].drift_detected
    large = {r.feature: r for r in drift.drift_report(*frames_, ["x"], ["kind"], judge="distance").collect()}
    assert large["x"].test == "wasserstein_normalised" and large["kind"].test == "jensen_shannon"
    whole = drift.dataset_drift(drift.drift_report(*frames_, ["x"], ["kind"], judge="p_value")).first()
    assert (whole.drifted_columns, whole.share_drifted, whole.dataset_drift) == (1, 0.5, True)


def test_drift_job_names_missing_columns(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "datetime int, value double")
    found = jobs.drift_job(df, F.lit(25), ["value", "tempF"])
    assert [r.column for r in found["missing"].collect()] == ["tempF"]
    assert {r.feature for r in found["ks"].collect()} == {"value"}


def test_default_split_is_the_last_time(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "datetime int")
    old, new = drift.split_at_time(df)
    assert (old.count(), new.count()) == (1, 2)
