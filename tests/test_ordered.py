"""Order helpers against brute force, with one group holding most rows."""

import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import sampling, splits
from gridloom.operators.ordered import (
    below_cuts, block_positions, cut_points, global_position, hash_block, running_totals, seeded_order,
)


def twin(key: int, seed: int = 42) -> int:
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:15], 16)


def grouped(spark, sizes):
    rows = [(g, i * 3 + len(g)) for g, n in sizes.items() for i in range(n)]
    return rows, spark.createDataFrame(rows, "g string, id bigint")


SIZES = {"hot": 900, "b": 50, "cc": 1}


def test_seeded_order_matches_plain_arithmetic(spark):
    keys = [0, 1, 7, 2147483647, 2147483648, 9_000_000_000_000, 123456789]
    found = spark.createDataFrame([(k,) for k in keys], "id bigint").select("id", seeded_order("id").alias("h")).collect()
    assert {r.id: r.h for r in found} == {k: twin(k) for k in keys}


def test_draws_are_with_replacement(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 1024), ("c", 1500), ("d", 1500)], "g string, n bigint")
    at = [(r.g, r["at"]) for r in sampling.draws(sizes, F.col("n"), 42).collect()]
    for g, n in (("a", 1000), ("b", 1024), ("c", 1500), ("d", 1500)):
        drawn = [p for h, p in at if h == g]
        assert len(drawn) == n and min(drawn) >= 1 and max(drawn) <= n
        assert 0.59 < len(set(drawn)) / n < 0.68  # 1 - 1/e of the rows are met
    assert sorted(p for g, p in at if g == "c") != sorted(p for g, p in at if g == "d")


def test_small_and_odd_shares(spark):
    df = spark.range(30000).withColumnRenamed("id", "key")
    few = splits.random_split(df, "key", test=0.0004).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in few} == {"test": 12, "train": 29988}
    third = splits.random_split(df, "key", test=1 / 3).filter("split = 'test'").count()
    assert third == 10000


def test_running_totals(spark):
    rng = random.Random(3)
    rows = [(f, v, rng.randint(0, 5), rng.randint(0, 5)) for f, n in (("x", 700), ("y", 3)) for v in rng.sample(range(5000), n)]
    df = spark.createDataFrame(rows, "feature string, value int, a int, b int")
    found = {(r.feature, r.value): (r.running_a, r.running_b, r.next_value)
             for r in running_totals(df, ["feature"], "value", ["a", "b"]).collect()}
    for feature in "xy":
        part = sorted(r for r in rows if r[0] == feature)
        a = b = 0
        for i, (_, value, da, db) in enumerate(part):
            a, b = a + da, b + db
            after = part[i + 1][1] if i + 1 < len(part) else None
            assert found[(feature, value)] == (a, b, after)


def test_global_position(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 3), i) for i in range(2000)]  # heavy ties on the first column
    df = spark.createDataFrame(rows, "x int, id int")
    found = {(r.x, r.id): r.position for r in global_position(df, ["x", "id"]).collect()}
    assert found == {row: i + 1 for i, row in enumerate(sorted(rows))}


def test_block_positions(spark):
    rows, df = grouped(spark, SIZES)
    order = seeded_order("id")
    found = block_positions(df, ["g"], hash_block(order, 16), [order, F.col("id")], "at").collect()
    for g in SIZES:
        ids = sorted((i for h, i in rows if h == g), key=lambda i: (twin(i), i))
        assert {r.id: r["at"] for r in found if r.g == g} == {i: p + 1 for p, i in enumerate(ids)}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 400), min_size=1, max_size=3), st.integers(1, 40))
def test_cut_points_hit_the_exact_positions(spark, wanted, width):
    rows, df = grouped(spark, SIZES)
    positions = lambda n: [F.least(F.lit(w), n) for w in wanted]
    cuts = cut_points(df, ["g"], F.floor(F.col("id") / width), F.col("id"), positions)
    found = {r.g: [r[f"cut_{i}"] for i in range(len(wanted))] for r in cuts.collect()}
    for g, size in SIZES.items():
        ids = sorted(i for h, i in rows if h == g)
        expected = [ids[min(w, size) - 1] if min(w, size) > 0 else None for w in wanted]
        assert found.get(g, [None] * len(wanted)) == expected


def test_null_group_is_split_too(spark):
    df = spark.createDataFrame([(None, i) for i in range(10)] + [("a", i) for i in range(10, 20)], "g string, id bigint")
    found = splits.stratified_split(df, ["g"], "id").groupBy("g", "split").count().collect()
    assert {(r.g, r.split): r["count"] for r in found} == {
        (g, s): n for g in (None, "a") for s, n in (("test", 2), ("validation", 1), ("train", 7))}


def test_hundred_rows_split_twenty(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(100)], "id bigint, g string")
    found = splits.stratified_split(df, ["g"], "id", 0.2, 0.25).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in found} == {"test": 20, "validation": 24, "train": 56}


def test_folds_are_contiguous_and_even(spark):
    df = spark.range(23).withColumnRenamed("id", "k")
    found = splits.contiguous_folds(df, 5, ["k"]).orderBy("k").collect()
    assert [r.fold for r in found] == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 4 + [4] * 4


def test_rows_split_without_being_sorted(spark):
    """The wide rows meet the cuts by a join on the group; no window runs over them."""
    _, df = grouped(spark, SIZES)
    wide = df.withColumn("payload", F.lit("x"))
    plan = splits.stratified_split(wide, ["g"], "id")._jdf.queryExecution().optimizedPlan().toString()
    assert all("payload" not in line for line in plan.splitlines() if "Window [" in line)


def test_over_sampling_reaches_the_majority(spark):
    rows, df = grouped(spark, SIZES)
    found = sampling.over_sample(df, "g", "id")
    assert {r.g: r["count"] for r in found.groupBy("g").count().collect()} == {g: 900 for g in SIZES}
    assert found.filter("NOT copied").count() == len(rows)
    originals = {tuple(r) for r in rows}
    assert {(r.g, r.id) for r in found.collect()} == originals


def test_thinning_removes_the_rounded_share(spark):
    _, df = grouped(spark, SIZES)
    found = sampling.thin_category(df, "g", "b", 0.35, "id")
    counts = {r.g: r["count"] for r in found.groupBy("g").count().collect()}
    assert counts == {"hot": 900, "b": 50 - 18, "cc": 1}


def test_thinning_keeps_rows_without_category(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2)], "g string, id bigint")
    assert sampling.thin_category(df, "g", "b", 1.0, "id").count() == 1


@pytest.mark.parametrize("column", ["g"])
def test_resampling_gives_every_group_the_largest_size(spark, column):
    _, df = grouped(spark, SIZES)
    found = sampling.resample_to_largest(df, column, "id")
    assert {r.g: r["count"] for r in found.groupBy(column).count().collect()} == {g: 900 for g in SIZES}


def test_below_cuts_without_cut_counts_as_beyond(spark):
    df = spark.createDataFrame([("a", 1)], "g string, id int")
    cuts = spark.createDataFrame([("a", None)], "g string, cut_0 int")
    assert below_cuts(df, ["g"], F.col("id"), cuts, 1, "n").first().n == 1
