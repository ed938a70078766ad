"""Registered fits on tables in which ``pressureInches`` is constant."""

import os

import pytest
from pyspark.sql import functions as F

from gridloom.plans.catalog import QUERIES

#: Query and its rows; metrics are never null.
FITS = {
    "e7_model_bias": 12,
    "e8_monitor": 11,
    "m12_reweighted_fit": 6,
    "m1_linear_regression": 1,
    "m20_saved_model_metrics": 11,
}


@pytest.fixture(scope="module")
def constant(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("constant"))
    for name in os.listdir(folder):
        if name != "events.parquet":
            os.symlink(os.path.join(folder, name), os.path.join(path, name))
    events = spark.read.parquet(f"{folder}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("long")
    # 29 + max(k) div 50 is 30 in every hour.
    events.withColumn("props", F.to_json(F.struct((50 + k % 50).alias("k")))).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("name", FITS)
def test_fit_with_a_constant_feature(spark, constant, name):
    rows = QUERIES[name](spark, constant).collect()
    measured = [r for r in rows if r.asDict().get("finding") != "version"]
    assert rows and measured and all(r.mse is not None and r.mae is not None and r.rows > 0 for r in measured)
    if name != "m20_saved_model_metrics":
        assert len(rows) == FITS[name]
