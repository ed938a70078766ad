"""Readers, writers, snapshots, payloads, dimensions, date text."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.functions import calendar, geo, text
from gridloom.operators import regions, vectors
from gridloom.plans import jobs
from gridloom.sources import dimensions, files, landed, snapshots
from tests.helpers import as_set


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def write_file(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))
    return str(folder)


def test_csv_inference_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    files.write_csv(df, path)
    files.write_csv(df, path, mode="append")
    back = files.read_csv(spark, path)
    assert back.dtypes == [("a", "int"), ("b", "string")] and back.count() == 2


def test_snapshot_versions_manifest_and_retention(spark, tmp_path):
    path = str(tmp_path / "store")
    assert snapshots.latest_version(spark, path) is None
    with pytest.raises(ValueError, match="no published version"):
        snapshots.read_version(spark, path)
    for n in (1, 2, 3):
        assert snapshots.publish(spark.range(n), path, "numbers") == n
    assert snapshots.read_version(spark, path).count() == 3
    assert snapshots.read_version(spark, path, 1).count() == 1
    rows = {r.version: r.rows for r in snapshots.manifest(spark, path).collect()}
    assert rows == {1: 1, 2: 2, 3: 3}
    assert snapshots.retain(spark, path, 2) == [1]
    assert not (tmp_path / "store" / "version=1").exists()
    with pytest.raises(ValueError):
        snapshots.read_version(spark, path, 1)
    assert snapshots.publish(spark.range(4), path, "numbers") == 4


def test_content_hash_ignores_row_order(spark):
    df = spark.range(1000)
    same = df.orderBy(F.desc("id")).repartition(3)
    assert snapshots.content_hash(df).first() == snapshots.content_hash(same).first()
    assert snapshots.content_hash(df).first() != snapshots.content_hash(spark.range(1, 1001)).first()


def test_documents_are_whole_files(spark, tmp_path):
    folder = write_file(tmp_path / "docs", "a.txt", "first\nsecond")
    write_file(tmp_path / "docs", "b.txt", "third")
    assert as_set(files.read_documents(spark, folder)) == sorted([repr(("a.txt", "first\nsecond")), repr(("b.txt", "third"))])


def test_report_must_be_one_record(spark, tmp_path):
    path = str(tmp_path / "report")
    files.write_report(spark.createDataFrame([(True,)], "bias_detected boolean"), path)
    assert files.read_report(spark, path, "bias_detected boolean").first().bias_detected
    spark.createDataFrame([(True,), (False,)], "bias_detected boolean").write.mode("overwrite").json(path)
    with pytest.raises(ValueError, match="several"):
        files.read_report(spark, path, "bias_detected boolean")


def test_demand_payload_from_files(spark, tmp_path):
    row = {"period": "2024-01-01T05", "subba": "COAS", "subba-name": "Coast", "parent": "P", "parent-name": "PP",
           "value": "12", "value-units": "megawatthours"}
    folder = write_file(tmp_path / "demand", "a.json", {"response": {"total": "1", "data": [row]}})
    write_file(tmp_path / "demand", "b.json", {"response": {"total": "0", "data": []}})
    write_file(tmp_path / "demand", "c.json", {"response": {"total": "1", "data": [{"period": "2024-01-01T06"}]}})
    payload = landed.read_demand(spark, folder)
    rows = landed.demand_hours(payload)
    assert rows.columns == ["datetime", "subba-name", "value", "value-units"]
    assert rows.count() == 2
    export = landed.demand_export(payload)
    assert export.columns == [f.name for f in schemas.DEMAND_ROW.fields]
    assert export.filter("period = '2024-01-01T06'").first().subba == ""


def hour_record(time, temp):
    record = {c: "1" for c in [*schemas.WEATHER_INTEGERS, *schemas.WEATHER_DOUBLES]}
    record.update(time=time, tempF=str(temp), tempC="0", weatherIconUrl=[{"value": "u"}], weatherDesc=[{"value": "d"}],
                  windspeedKmph="1", winddirDegree="1", winddir16Point="N")
    return record


def test_weather_payload_joins_demand(spark, tmp_path):
    day = {"date": "2024-01-01", "hourly": [hour_record("0", 40), hour_record("500", 45), hour_record("2300", 50)]}
    folder = write_file(tmp_path / "weather", "a.json", {"data": {"weather": [day]}})
    weather = landed.read_weather(spark, folder).withColumn("zone", F.lit("COAS"))
    hours = landed.weather_hours(landed.weather_days(weather, "zone"), "zone")
    assert hours.columns[0] == "datetime" and not set(schemas.DROPPED_WEATHER) & set(hours.columns)
    assert [r.datetime for r in hours.orderBy("datetime").collect()] == ["2024-01-01T00", "2024-01-01T05", "2024-01-01T23"]
    row = {"period": "2024-01-01T05", "subba-name": "Coast", "value": "12", "value-units": "mwh"}
    folder = write_file(tmp_path / "demand", "a.json", {"response": {"total": "1", "data": [row]}})
    demand = landed.read_demand(spark, folder).withColumn("zone", F.lit("COAS"))
    table = jobs.collect_dataset(demand, weather).collect()
    assert [(str(r.datetime), r.tempF, r.value) for r in table] == [("2024-01-01 05:00:00", 45, 12)]


def test_hour_text(spark):
    assert [one(spark, calendar.hour_of(F.lit(x))) for x in ("0", "100", "2300", "12345")] == ["00", "01", "23", "12"]


def test_month_ranges_follow_the_clamped_chain(spark):
    ranges = one(spark, calendar.split_months(F.lit("2024-01-31").cast("date"), F.lit("2024-04-30").cast("date")))
    assert [(str(a), str(b)) for a, b in ranges] == [
        ("2024-01-31", "2024-02-28"), ("2024-02-29", "2024-03-28"), ("2024-03-29", "2024-04-28"), ("2024-04-29", "2024-04-30")]
    single = one(spark, calendar.split_months(F.lit("2024-05-05").cast("date"), F.lit("2024-05-05").cast("date")))
    assert [(str(a), str(b)) for a, b in single] == [("2024-05-05", "2024-05-05")]


def test_year_ranges_and_last_days(spark):
    ranges = one(spark, calendar.split_years(F.lit("2019-06-05").cast("date"), F.lit("2021-02-01").cast("date")))
    assert [(str(a), str(b)) for a, b in ranges] == [
        ("2019-06-05", "2019-12-31"), ("2020-01-01", "2020-12-31"), ("2021-01-01", "2021-02-01")]
    assert tuple(one(spark, calendar.last_days(F.lit("2024-03-01").cast("date"), 7))) == ("24-02-2024", "01-03-2024")
    assert one(spark, calendar.parse_day(F.lit("31-02-2024"))) is None
    assert one(spark, calendar.parse_day(F.lit("29-02-2024"))) == datetime.date(2024, 2, 29)


def test_zone_dimension(spark):
    table = dimensions.zones(spark)
    assert table.count() == 27
    houston = table.filter("zone = 'COAS'").first()
    assert (houston.region, houston.lat, houston.lon) == ("texas", 29.749907, -95.358421)
    with pytest.raises(ValueError):
        dimensions.zones(spark, "{not json")


def test_region_file_and_nearest_region(spark, tmp_path):
    content = {name: {"coordinates": at, "companies": companies} for name, at, companies in dimensions.MARKET_REGIONS}
    folder = write_file(tmp_path / "regions", "r.json", content)
    rows = dimensions.read_market_regions(spark, folder).orderBy("ordinal").collect()
    assert [(r.region, r.coordinates, r.companies) for r in rows] == dimensions.MARKET_REGIONS
    places = spark.createDataFrame([("houston", 29.76, -95.37), ("albany", 42.65, -73.75), ("none", None, None)], "p string, lat double, lon double")
    found = {r.p: r.region for r in regions.with_region(places).collect()}
    assert found == {"houston": "ERCOT", "albany": "NYIS", "none": None}


def test_equal_distance_goes_to_the_first_region(spark):
    twins = [("first", "10,10", ["A:A"]), ("second", "10,10", ["B:B"])]
    assert one(spark, regions.nearest_region(F.lit(0.0), F.lit(0.0), twins)).region == "first"


def test_distance_and_tickers(spark):
    assert one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))) == pytest.approx(10007.543, abs=1e-3)
    assert one(spark, text.company_ticker(F.lit("National Grid plc:NGG.L"))) == "NGG"
    assert one(spark, text.safe_name(F.lit("a b-c.1"))) == "a_b_c_1"
    assert one(spark, text.row_text(["id"])) == '"id": 0'


def test_first_place(spark):
    found = '{"results": [{"geometry": {"lat": 1.5, "lng": -2.25}}, {"geometry": {"lat": 9, "lng": 9}}]}'
    assert one(spark, landed.first_place(F.lit(found))) == "1.5,-2.25"
    assert one(spark, landed.first_place(F.lit('{"results": []}'))) is None


def test_top_k_across_query_blocks_equals_one_pass(spark):
    rows = [(i, [float((i * 7 + j * 3) % 11) - 5 for j in range(8)]) for i in range(200)]
    store = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    questions = store.select(F.col("vec_id").alias("query"), F.col("embedding").cast("array<double>").alias("vector"))
    whole = as_set(vectors.top_k_similar(store, questions, 4).drop("similarity"))
    split = vectors.top_k_similar(store, questions, 4, vectors_per_shard=30, queries_per_block=64)
    assert as_set(split.drop("similarity")) == whole
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1
    import numpy as np

    m = np.array([v for _, v in rows])
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 9)
    best = {q: [int(x) for x in np.lexsort((np.arange(200), -scores[q]))[:4]] for q in (0, 50, 199)}
    found = vectors.top_k_similar(store, questions, 4).filter("query IN (0, 50, 199)").collect()
    for q, ids in best.items():
        mine = sorted((r["rank"], round(float(unit[q] @ unit[r.match]), 9)) for r in found if r["query"] == q)
        assert [s for _, s in mine] == [scores[q][i] for i in ids]


def test_two_writers_never_share_a_number(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "store")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda n: snapshots.publish(spark.range(n + 1), path, "x"), range(6)))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    assert {r.version: r.rows for r in snapshots.manifest(spark, path).collect()} == {v: n + 1 for n, v in enumerate(numbers)}
    assert snapshots.retain(spark, path, 0) == [1, 2, 3, 4, 5, 6]
    assert snapshots.manifest(spark, path).count() == 0
    assert snapshots.publish(spark.range(1), path, "x") == 7


def test_vectors_without_direction_or_of_another_length(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (6, []), (7, [1.0, None]), (8, [1.0, 1.0, 1.0]),
            (9, [1e-200, 0.0]), (10, [1e200, 1e200]), (None, [1.0, 0.0])]
    store = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(0, [2.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0, 1.0, 0.0]), (3, [1.0])], "query bigint, vector array<double>")
    found = {(r["query"], r["rank"]): (r.match, round(r.similarity, 6)) for r in vectors.top_k_similar(store, asked, 3).collect()}
    assert found == {(0, 1): (1, 1.0), (0, 2): (9, 1.0), (0, 3): (10, 0.707107), (2, 1): (8, 0.816497)}
    assert vectors.top_k_similar(store.limit(0), asked, 3).count() == 0 == vectors.top_k_similar(store, asked.limit(0), 3).count()


def test_mean_vectors(spark):
    rows = [(1, [1.0, 2.0]), (1, [3.0, 6.0]), (2, [5.0, 5.0]), (1, None)]
    found = vectors.mean_vectors(spark.createDataFrame(rows, "label int, embedding array<float>"), "label").collect()
    assert {r["query"]: r.vector for r in found} == {1: [2.0, 4.0], 2: [5.0, 5.0]}
