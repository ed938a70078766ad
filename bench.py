"""Time the headline queries: one JSON line on stdout.

$BENCH_SF_DIR is the table folder, $BENCH_CPUS the number of local cores, $BENCH_QUERIES a
comma-separated list of names (``all`` for every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "p2_clean", "j1_weather_demand", "j2_hourly_grid", "j8_nearest_region", "j9_top_k_vectors",
    "a3_slice_means", "a8_metric_frame", "a15_describe_numbers", "a20_correlations",
    "w4_feature_block", "w7_fill_both_ways", "w10_min_max_by_zone", "w14_stratified_split",
    "u4_keep_first", "q2_validation_counts", "q3_fix_anomalies", "q5_ks_test", "q6_psi_own_edges",
    "q7_drift_report", "r1_fill_biased_groups", "r3_resample_to_largest", "e1_preprocess",
    "e2_daily_increment", "e3_collect_dataset", "e4_data_bias", "e5_drift_job",
    "e6_train_and_evaluate", "m12_reweighted_fit",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    from gridloom.plans.catalog import QUERIES
    from gridloom.session import build_session

    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else (asked.split(",") if asked else HEADLINE)
    spark = build_session(cores, "bench")
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        # Every column of every row is computed and dropped.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main()
