"""Fixed dimensions: zones with coordinates, market regions with companies."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Region -> zone -> [lat, lon].
ZONES_JSON = """
{
 "texas": {
  "COAS": [29.749907, -95.358421], "EAST": [32.351485, -95.301140],
  "FWES": [31.997345, -102.077915], "NCEN": [32.78306, -96.80667],
  "NRTH": [33.913708, -98.493387], "SCEN": [30.267153, -97.743057],
  "SOUT": [26.203407, -98.230012], "WEST": [32.448736, -99.733144]},
 "new_york": {
  "ZONA": [42.8864, -78.8784], "ZONB": [43.1566, -77.6088], "ZONC": [43.0481, -76.1474],
  "ZOND": [44.6995, -73.4529], "ZONE": [43.1009, -75.2327], "ZONF": [42.6526, -73.7562],
  "ZONG": [41.7004, -73.9209], "ZONH": [41.2045, -73.8176], "ZONI": [40.9439, -73.8674],
  "ZONJ": [40.7128, -74.0060], "ZONK": [40.7062, -73.6187]},
 "new_england": {
  "4001": [43.661471, -70.255326], "4002": [42.995640, -71.454789],
  "4003": [44.475882, -73.212072], "4004": [41.763710, -72.685097],
  "4005": [41.823989, -71.412834], "4006": [41.635693, -70.933777],
  "4007": [42.101483, -72.589811], "4008": [42.358894, -71.056742]}
}
"""

# Market region, coordinates, companies as Name:TICKER, in file order.
MARKET_REGIONS = [
    ("MISO", "40.7336,-89.2005", [
        "NextEra Energy:NEE", "American Electric Power:AEP", "DTE Energy:DTE",
        "Entergy Corporation:ETR", "Exelon Corporation:EXC"]),
    ("ISNE", "42.4072,-71.3824", [
        "Eversource Energy:ES", "Avangrid:AGR", "Dominion Energy:D"]),
    ("PNM", "35.6870,-105.9378", ["PNM Resources:PNM", "Avangrid:AGR"]),
    ("PJM", "39.9526,-75.1652", [
        "American Electric Power:AEP", "Exelon Corporation:EXC", "Dominion Energy:D",
        "FirstEnergy:FE", "PPL Corporation:PPL"]),
    ("ERCOT", "31.9686,-99.9018", [
        "Vistra Corp:VST", "NRG Energy:NRG", "NextEra Energy:NEE"]),
    ("SWPP", "37.7749,-97.4187", [
        "Entergy Corporation:ETR", "OGE Energy:OGE", "Evergy:EVRG",
        "American Electric Power:AEP"]),
    ("CISO", "36.7783,-119.4179", [
        "Pacific Gas and Electric:PCG", "Southern California Edison:EIX",
        "San Diego Gas & Electric:SRE"]),
    ("NYIS", "42.6526,-73.7562", [
        "Consolidated Edison:ED", "National Grid plc:NGG", "Avangrid:AGR"]),
]

ZONE_MAP_TYPE = "map<string, map<string, array<double>>>"


def zones_from_json(df: DataFrame, column: str) -> DataFrame:
    """Regions argument as JSON text → (region, zone, lat, lon)."""
    by_region = df.select(F.explode(F.from_json(column, ZONE_MAP_TYPE)).alias("region", "zones"))
    return by_region.select("region", F.explode("zones").alias("zone", "at")).select(
        "region", "zone", F.col("at")[0].alias("lat"), F.col("at")[1].alias("lon")
    )


def zones(spark: SparkSession, text: str = ZONES_JSON) -> DataFrame:
    """The zone dimension from the built-in text or a user's regions argument."""
    json.loads(text)  # a malformed argument fails here, not as an empty dimension
    return zones_from_json(spark.createDataFrame([(text,)], "regions string"), "regions")


def market_regions(spark: SparkSession) -> DataFrame:
    """(ordinal, region, coordinates, companies)."""
    rows = [(i, *entry) for i, entry in enumerate(MARKET_REGIONS)]
    return spark.createDataFrame(
        rows, "ordinal int, region string, coordinates string, companies array<string>"
    )


def read_market_regions(spark: SparkSession, path: str) -> DataFrame:
    """A region file ``{region: {coordinates, companies}}`` → the same four columns."""
    layout = "map<string, struct<coordinates: string, companies: array<string>>>"
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.posexplode(F.map_entries(F.from_json("value", layout))))
    return entries.select(
        F.col("pos").alias("ordinal"),
        F.col("col.key").alias("region"),
        F.col("col.value.coordinates").alias("coordinates"),
        F.col("col.value.companies").alias("companies"),
    )


def read_min_max(spark: SparkSession, path: str) -> DataFrame:
    """A ``{column: {min, max}}`` file → (column, min, max)."""
    text = spark.read.text(path, wholetext=True)
    stored = F.from_json("value", "map<string, struct<min: double, max: double>>")
    entries = text.select(F.explode(stored).alias("column", "range"))
    return entries.select("column", "range.min", "range.max")


def min_max_json(bounds: DataFrame) -> DataFrame:
    """(column, min, max) → one row of JSON text; one entry per table column."""
    entry = F.struct("column", F.struct("min", "max").alias("range"))
    return bounds.select(entry.alias("e")).agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list("e")))).alias("value")
    )
