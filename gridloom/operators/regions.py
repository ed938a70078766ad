"""Nearest market region and the companies of a location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.geo import haversine_km
from gridloom.functions.text import company_name, company_ticker
from gridloom.sources.dimensions import MARKET_REGIONS


def nearest_region(
    lat: Column, lon: Column, regions: Sequence[tuple[str, str, Sequence[str]]] = tuple(MARKET_REGIONS)
) -> Column:
    """Struct (km, ordinal, region, companies) of the closest region; ties go to the first listed.

    The fixed region list becomes one expression per row: no join, no shuffle.
    """
    candidates = []
    for ordinal, (name, coordinates, companies) in enumerate(regions):
        at_lat, at_lon = (float(x) for x in coordinates.split(","))
        candidates.append(
            F.struct(
                haversine_km(lat, lon, F.lit(at_lat), F.lit(at_lon)).alias("km"),
                F.lit(ordinal).alias("ordinal"),
                F.lit(name).alias("region"),
                F.array(*[F.lit(c) for c in companies]).alias("companies"),
            )
        )
    return F.when(lat.isNotNull() & lon.isNotNull(), F.array_min(F.array(*candidates)))


def with_region(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add region, km and companies of the closest market region."""
    near = df.withColumn("_near", nearest_region(F.col(lat), F.col(lon)))
    return near.select(
        *df.columns,
        F.col("_near.region").alias("region"),
        F.col("_near.km").alias("km"),
        F.col("_near.companies").alias("companies"),
    )


def companies_of(df: DataFrame) -> DataFrame:
    """One row per location and company: name and ticker."""
    exploded = df.withColumn("_entry", F.explode("companies"))
    return exploded.select(
        *[c for c in df.columns if c != "companies"],
        company_name(F.col("_entry")).alias("company"),
        company_ticker(F.col("_entry")).alias("ticker"),
    )
