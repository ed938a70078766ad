"""Price history, balance sheets, and the per-location report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.text import row_text
from gridloom.operators.ordered import cname
from gridloom.operators.regions import companies_of


def price_history(prices: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Close and volume of the twelve months up to ``as_of`` (default: newest date)."""
    if as_of is None:
        as_of = prices.agg(F.max("date")).scalar()
    recent = prices.filter(
        (F.col("date") >= F.add_months(as_of, -12)) & (F.col("date") <= as_of)
    )
    return recent.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("Date"), "Close", "Volume")


def balance_sheet(items: DataFrame, periods: int = 3) -> DataFrame:
    """Per company the newest periods; line items missing in one of them fall away.

    Input (ticker, item, period, value), one row per cell.
    """
    newest = Window.partitionBy("ticker").orderBy(F.desc("period"))
    kept = (
        items.select("ticker", "period")
        .distinct()
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= periods)
        .drop("_rank")
    )
    sizes = kept.groupBy("ticker").agg(F.count(F.lit(1)).alias("_periods"))
    cells = items.join(kept, ["ticker", "period"], "left_semi")
    full = (
        cells.groupBy("ticker", "item")
        .agg(F.count("value").alias("_known"))
        .join(sizes, "ticker")
        .filter(F.col("_known") == F.col("_periods"))
        .select("ticker", "item")
    )
    return cells.join(full, ["ticker", "item"], "left_semi").select(*items.columns)


def company_list(df: DataFrame) -> DataFrame:
    """Add the companies of a location as one text."""
    return df.withColumn("company_list", F.concat_ws(", ", "companies"))


def newest_weather_text(
    weather: DataFrame, keys: list[str], order: str = "datetime", shown: list[str] | None = None
) -> DataFrame:
    """Per location the newest hour as ``"column": value`` text."""
    shown = shown or [c for c in weather.columns if c not in keys]
    picked = weather.groupBy(*map(cname, keys)).agg(
        F.max_by(F.struct(*map(cname, weather.columns)), cname(order)).alias("_row")
    )
    flat = picked.select("_row.*")
    return flat.select(*map(cname, keys), row_text(shown).alias("weather"))


def location_report(
    locations: DataFrame, weather_text: DataFrame, predicted: DataFrame,
    prices: DataFrame, sheet: DataFrame,
) -> DataFrame:
    """One row per location: weather, predicted demand, region, companies, and how much price
    and balance-sheet data its companies have.

    ``locations`` has (location, zone, region, companies); prices and sheet are keyed by ticker
    and reduced to one row per ticker before they meet the locations.
    """
    by_ticker = prices.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("price_days"), F.max_by("Close", "Date").alias("last_close")
    )
    by_sheet = sheet.groupBy("ticker").agg(F.countDistinct("item").alias("sheet_items"))
    # Work on distinct regions, not on every location: company facts depend on the region only.
    regions = locations.select("region", "companies").dropDuplicates(["region"])
    facts = (
        companies_of(regions)
        .join(by_ticker, "ticker", "left")
        .join(by_sheet, "ticker", "left")
        .groupBy("region")
        .agg(
            F.coalesce(F.sum("price_days"), F.lit(0)).alias("price_days"),
            F.max("last_close").alias("highest_close"),
            F.coalesce(F.sum("sheet_items"), F.lit(0)).alias("sheet_items"),
        )
    )
    return (
        company_list(locations)
        .drop("companies")
        .join(facts, "region", "left")
        .join(weather_text, "zone", "left")
        .join(predicted, "zone", "left")
    )
