"""Landed API payloads: nested JSON in, flat hourly rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.functions.calendar import hour_text
from gridloom.operators.ordered import cname


def read_demand(spark: SparkSession, path: str) -> DataFrame:
    """Demand answers, one JSON document per file."""
    return spark.read.schema(schemas.DEMAND_PAYLOAD).option("multiLine", True).json(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather answers, one JSON document per file."""
    return spark.read.schema(schemas.WEATHER_PAYLOAD).option("multiLine", True).json(path)


def demand_rows(payload: DataFrame, *keep: str) -> DataFrame:
    """``response.data[]`` as rows; an answer whose total is "0" gives none."""
    answered = payload.filter(F.col("response.total") != "0")
    flat = answered.select(*map(cname, keep), F.inline("response.data"))
    return flat.drop("subba", "parent", "parent-name")


def demand_hours(payload: DataFrame, *keep: str) -> DataFrame:
    """Demand rows with ``period`` named ``datetime``."""
    return demand_rows(payload, *keep).withColumnRenamed("period", "datetime")


def weather_days(payload: DataFrame, *keep: str) -> DataFrame:
    """``data.weather[]``: one row per day with its array of hours."""
    return payload.select(*map(cname, keep), F.inline("data.weather"))


def weather_hours(days: DataFrame, *keep: str) -> DataFrame:
    """One row per hour, ``datetime`` first, unused fields dropped."""
    hours = days.select(*map(cname, keep), "date", F.inline("hourly"))
    named = hours.withColumn("datetime", hour_text(F.col("date"), F.col("time")))
    kept = [
        c for c in named.columns
        if c not in ("date", "datetime", *keep, *schemas.DROPPED_WEATHER)
    ]
    return named.select(cname("datetime"), *map(cname, keep), *map(cname, kept))


def demand_export(payload: DataFrame) -> DataFrame:
    """The seven demand fields; missing keys become empty text."""
    rows = payload.select(F.inline("response.data"))
    return rows.select(
        *[F.coalesce(cname(f.name), F.lit("")).alias(f.name) for f in schemas.DEMAND_ROW.fields]
    )


def first_place(payload: Column) -> Column:
    """``lat,lng`` of the first geocoder result; null if there is none."""
    answer = F.from_json(payload, schemas.GEOCODE_PAYLOAD)
    place = F.get(answer["results"], F.lit(0))["geometry"]
    return F.when(
        place.isNotNull(),
        F.concat_ws(",", place["lat"].cast("string"), place["lng"].cast("string")),
    )
