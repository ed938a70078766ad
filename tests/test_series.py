"""Windows, fills and grids on hand-made series."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators import bias, cleaning, combine, scaling, windows
from gridloom.operators.ordered import expand_rows, over_blocks
from tests.helpers import as_set, hour, series, series_rows

# One zone holds most rows; one has fewer rows than the window reaches back.
SIZES = {"hot": 1500, "b": 120, "c": 40, "tiny": 3}


@pytest.mark.parametrize("unit", ["day", "week", "month", "hour"])
def test_blocks_equal_the_whole_group_window(spark, unit):
    df = series(spark, SIZES)
    plain = windows.engineer_features(df, unit=None)
    assert as_set(windows.engineer_features(df, unit=unit).select(plain.columns)) == as_set(plain)


def test_features_agree_with_pandas(spark):
    rows = series_rows({"hot": 300, "b": 50})
    frame = pd.DataFrame(rows, columns=["zone", "datetime", *schemas.ROLLED, "value"])
    for c in schemas.ROLLED:
        grouped = frame.groupby("zone")[c]
        frame[f"{c}_rolling_mean"] = grouped.transform(lambda x: x.rolling(6).mean())
        frame[f"{c}_rolling_std"] = grouped.transform(lambda x: x.rolling(6).std())
        for n in schemas.LAGS:
            frame[f"{c}_lag_{n}"] = grouped.shift(n)
    wanted = frame.dropna().sort_values(["zone", "datetime"]).reset_index(drop=True)
    found = windows.engineer_features(series(spark, {"hot": 300, "b": 50})).toPandas()
    found = found.sort_values(["zone", "datetime"]).reset_index(drop=True)[wanted.columns]
    pd.testing.assert_frame_equal(found, wanted, check_dtype=False, atol=1e-8)


def test_ten_rows_leave_four(spark):
    temp = [70, 71, 69, 68, 72, 74, 73, 75, 76, 78]
    wind = [10, 12, 11, 13, 9, 14, 10, 15, 13, 11]
    damp = [50, 55, 53, 57, 52, 56, 54, 58, 59, 60]
    rows = [("a", hour(i), temp[i], wind[i], damp[i]) for i in range(10)]
    df = spark.createDataFrame(rows, "zone string, datetime timestamp_ntz, tempF int, windspeedMiles int, humidity int")
    found = windows.engineer_features(df)
    assert found.count() == 4
    assert len(found.columns) == len(df.columns) + 15
    first = found.orderBy("datetime").first()
    assert first.tempF_rolling_mean == pytest.approx(sum(temp[1:7]) / 6)
    assert (first.tempF_lag_6, first.humidity_lag_2) == (70, 52)


def test_blocks_by_expression(spark):
    df = series(spark, {"hot": 500}).withColumn("_at", F.row_number().over(Window.orderBy("datetime")))
    lagged = over_blocks(df, ["zone"], "_at", 6, lambda w: {"was": F.lag("value", 6).over(w)}, F.floor(F.col("_at") / 7))
    plain = over_blocks(df, ["zone"], "_at", 6, lambda w: {"was": F.lag("value", 6).over(w)}, None)
    assert as_set(lagged) == as_set(plain)


@pytest.mark.parametrize("forward, backward", [(True, False), (False, True), (True, True)])
def test_fill_gaps_agrees_with_pandas(spark, forward, backward):
    rows = series_rows({"hot": 400, "b": 60}, missing=0.6)
    rows += [("empty", hour(i), None, None, None, 1.0) for i in range(5)]
    columns = ["zone", "datetime", "tempF", "windspeedMiles", "humidity", "value"]
    frame = pd.DataFrame(rows, columns=columns).sort_values(["zone", "datetime"]).reset_index(drop=True)
    for c in columns[2:]:
        filled = frame.groupby("zone")[c]
        frame[c] = filled.ffill() if forward else frame[c]
        if backward:
            frame[c] = frame.groupby("zone")[c].bfill()
    df = spark.createDataFrame(rows, "zone string, datetime timestamp_ntz, tempF double, windspeedMiles double, humidity double, value double")
    found = windows.fill_gaps(df, columns[2:], forward=forward, backward=backward, unit="day").toPandas()
    found = found.sort_values(["zone", "datetime"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(found, frame, check_dtype=False)


def test_rolling_imputation_agrees_with_pandas(spark):
    rows = series_rows({"hot": 200, "b": 30}, missing=0.5)
    columns = ["zone", "datetime", "tempF", "windspeedMiles", "humidity", "value"]
    frame = pd.DataFrame(rows, columns=columns).sort_values(["zone", "datetime"]).reset_index(drop=True)
    near = frame.groupby("zone")["tempF"].transform(lambda x: x.rolling(3, min_periods=1).mean())
    frame["tempF"] = frame["tempF"].fillna(near)
    df = spark.createDataFrame(rows, "zone string, datetime timestamp_ntz, tempF double, windspeedMiles double, humidity double, value double")
    found = windows.impute_rolling_mean(df, ["tempF"], ["zone"], "datetime", unit="day").toPandas()
    found = found.sort_values(["zone", "datetime"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(found, frame, check_dtype=False, atol=1e-8)


def test_grid_covers_the_table_span_for_every_group(spark):
    df = spark.createDataFrame(
        [("a", hour(0), 1.0), ("a", hour(5), 2.0), ("b", hour(3), 3.0)], "zone string, datetime timestamp_ntz, value double")
    grid = combine.reindex(df, ["zone"])
    assert grid.count() == 12
    assert grid.filter("value IS NOT NULL").count() == 3
    assert grid.schema["datetime"].dataType.simpleString() == "timestamp_ntz"


def test_cyclic_month(spark):
    days = [(datetime.datetime(2024, m, 1),) for m in range(1, 13)]
    found = windows.cyclic_month(spark.createDataFrame(days, "datetime timestamp_ntz")).orderBy("datetime").collect()
    assert (found[0].month_sin, found[0].month_cos) == pytest.approx((0.5, 0.866025), abs=1e-5)
    assert (found[6].month_sin, found[6].month_cos) == pytest.approx((-0.5, -0.866025), abs=1e-5)
    assert all(-1 <= x <= 1 for row in found for x in row[1:])


def test_last_rows_keeps_the_newest(spark):
    found = windows.last_rows(series(spark, SIZES), 7)
    counts = {r.zone: r["count"] for r in found.groupBy("zone").count().collect()}
    assert counts == {"hot": 7, "b": 7, "c": 7, "tiny": 3}


def test_last_rows_limits_groups_before_the_shuffle(spark):
    plan = windows.last_rows(series(spark, SIZES))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


def test_scaling_and_codes(spark):
    df = spark.createDataFrame(
        [(60, 30, 5, "A"), (70, 40, 10, "B"), (80, 50, 15, "A"), (90, 60, 20, "C")],
        "tempF int, humidity int, windspeedMiles int, category string")
    scaled = scaling.scale_min_max(df).orderBy("tempF").collect()
    assert [r.tempF for r in scaled] == pytest.approx([0, 1 / 3, 2 / 3, 1])
    codes = scaling.encode_labels(df, "category", scaling.label_dictionary(df, "category"))
    assert {(r.category, r.category_code) for r in codes.collect()} == {("A", 0), ("B", 1), ("C", 2)}


def test_constant_column_scales_to_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.x for r in scaling.scale_min_max(df).collect()] == [None, None]


def test_unseen_label_is_an_error_or_marked(spark):
    known = spark.createDataFrame([("a",), ("b",)], "kind string")
    other = spark.createDataFrame([("a",), ("z",), (None,)], "kind string")
    dictionary = scaling.label_dictionary(known, "kind")
    marked = scaling.encode_labels(other, "kind", dictionary, unseen="mark")
    assert sorted(r.kind_code for r in marked.collect()) == [-1, -1, 0]
    with pytest.raises(Exception, match="unseen label"):
        scaling.encode_labels(other, "kind", dictionary).collect()


def test_descale_and_its_swapped_form(spark):
    row = spark.range(1).select(
        scaling.descale(F.lit(0.25), 10.0, 50.0).alias("plain"),
        scaling.descale(F.lit(0.25), 10.0, 50.0, swapped=True).alias("swapped")).first()
    assert tuple(row) == (20.0, 40.0)


def test_stored_bounds_must_cover_numeric_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "tempF double, odd double")
    with pytest.raises(KeyError, match="odd"):
        scaling.scale_with_map(df, {"tempF": (0.0, 2.0)})


def test_clean_small_frame(spark):
    rows = [(1, None), (2, 5), (None, 6), (3, 5), (1, 4)]
    df = spark.createDataFrame(rows, "col1 int, col2 int")
    assert as_set(cleaning.clean(df)) == as_set(spark.createDataFrame([(2, 5), (3, 5), (1, 4)], "col1 int, col2 int"))


def test_repeated_rows_gives_every_later_copy(spark):
    df = spark.createDataFrame([("a",)] * 2500 + [("b",)] * 2 + [("c",)], "x string")
    found = {r.x: r["count"] for r in combine.repeated_rows(df).groupBy("x").count().collect()}
    assert found == {"a": 2499, "b": 1}


def test_expand_rows_numbers_every_repeat_and_spreads_a_hot_row(spark):
    df = spark.createDataFrame([("hot", 20_000), ("one", 1), ("none", 0)], "k string, n int")
    found = expand_rows(df, F.col("n"), "i")
    facts = {r.k: (r.c, r.lo, r.hi) for r in found.groupBy("k").agg(
        F.count_distinct("i").alias("c"), F.min("i").alias("lo"), F.max("i").alias("hi")).collect()}
    assert facts == {"hot": (20_000, 0, 19_999), "one": (1, 0, 0)}
    assert found.groupBy(F.spark_partition_id().alias("p")).count().count() > 1


def test_merge_keeps_history_first_and_all_keys(spark):
    layout = "zone string, datetime timestamp_ntz, value int"
    old = spark.createDataFrame([("a", hour(0), 1), ("a", hour(1), 2)], layout)
    new = spark.createDataFrame([("a", hour(1), 20), ("a", hour(2), 30)], layout)
    found = combine.merge_history(old, new)
    assert as_set(found) == as_set(spark.createDataFrame([("a", hour(0), 1), ("a", hour(1), 2), ("a", hour(2), 30)], layout))


def test_duplicate_keys_are_refused(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1)], "zone string, datetime int")
    with pytest.raises(ValueError, match="duplicate"):
        combine.require_unique(df, ["zone", "datetime"])


def test_coverage_of_the_small_frame(spark):
    values = [1, 0, 1, None, 1, 0, 1, None, 0, 1, 1, 0]
    groups = "A B A A B B A B A A B B".split()
    df = spark.createDataFrame(list(zip(values, groups)), "value int, g string")
    found = {(r.scope, r.g): r.selection_rate for r in bias.coverage(df, "value", "g").collect()}
    assert found == pytest.approx({("group", "A"): 5 / 6, ("group", "B"): 5 / 6, ("overall", None): 10 / 12})
    gap = bias.group_difference(bias.coverage(df, "value", "g"), ["selection_rate"]).first()
    assert gap.selection_rate_difference == 0


def test_biased_group_is_filled_and_others_are_kept(spark):
    rows = [("poor", hour(i), 5.0 if i % 3 == 0 else None) for i in range(2, 20)] + [("rich", hour(i), 1.0) for i in range(24)]
    df = spark.createDataFrame(rows, "zone string, datetime timestamp_ntz, value double")
    found = bias.fill_biased_groups(df, "value", "zone")
    poor = found.filter("zone = 'poor'")
    assert poor.count() == 24 and poor.filter("value IS NULL").count() == 0
    # 'rich' is off the overall rate as well, and gets the same calendar.
    assert found.filter("zone = 'rich'").count() == 24


def test_keep_first_with_null_and_equal_sequences(spark):
    from gridloom.operators.combine import keep_first

    rows = [("a", None, 1.0), ("b", 2, 5.0), ("b", None, 6.0), ("c", 1, 9.0), ("c", 1, 1.0)]
    one, two = (
        {r.k: (r.n, r.v) for r in keep_first(spark.createDataFrame(x, "k string, n int, v double").coalesce(1), ["k"], "n").collect()}
        for x in (rows, rows[::-1])
    )
    assert one == two and one["a"] == (None, 1.0) and one["b"] == (2, 5.0)
