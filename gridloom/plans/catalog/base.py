"""Catalog plumbing: test tables, the hourly fixture in both dialects, the entry registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators.ordered import cname

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given Parquet tables of one scale folder, and tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def readings(self) -> DataFrame:
        """Events with the value in whole hundredths and ``props.k`` as a number."""
        return self.events.select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.round(F.col("value") * 100).cast("bigint").alias("cents"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )

    @property
    def keyed(self) -> DataFrame:
        """The raw hourly table plus ``row_id``, an integer row key."""
        return self.readings.groupBy(
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"),
            F.col("event_type").alias("zone"),
        ).agg(
            F.min("event_id").alias("row_id"),
            F.concat(F.first("event_type"), F.lit(" - Area")).alias("subba-name"),
            F.lit("megawatthours").alias("value-units"),
            *[F.expr(_typed(name, text, "div", "`")) for name, text in MEASURES.items()],
        )

    @property
    def raw(self) -> DataFrame:
        """The raw hourly table: 27 columns, key (zone, datetime)."""
        return self.keyed.select(*[cname(f.name) for f in schemas.RAW_SCHEMA.fields])

    @property
    def hourly(self) -> DataFrame:
        """Key and four measures of the raw table."""
        return self.keyed.select(*HOURLY)

    @property
    def patchy(self) -> DataFrame:
        """The hourly table with missing measures."""
        return self.hourly.withColumns({n: F.expr(text) for n, text in PATCHES.items()})

    @property
    def recent(self) -> DataFrame:
        """The last seven days of the hourly table, as a daily pull would bring them again."""
        newest = self.hourly.agg(F.max("datetime")).scalar()
        return self.hourly.filter(F.col("datetime") >= newest - F.expr("INTERVAL 7 DAYS"))

    @property
    def predicted(self) -> DataFrame:
        """The hourly table with the value of the hour before as prediction."""
        from gridloom.operators.ordered import over_blocks

        return over_blocks(
            self.hourly, ["zone"], "datetime", 1, lambda w: {"guess": F.lag("value").over(w)}
        ).filter("guess IS NOT NULL")

    @property
    def places(self) -> DataFrame:
        """Customers with coordinates derived from their nation and account."""
        return self.customer.select(
            "c_custkey", "c_nationkey", "c_mktsegment",
            (F.lit(25.0) + F.col("c_nationkey") + F.round(F.col("c_acctbal")) / 16384).alias("lat"),
            (-(F.lit(70.0) + 2 * F.col("c_nationkey") + F.round(F.col("c_acctbal")) / 32768)).alias("lon"),
        )


# Whole-number measures of one zone and hour, so that both engines agree to the last digit.
MEASURES = {
    "tempF": "sum(cents) {div} count(*)",
    "windspeedMiles": "count(*)",
    "weatherCode": "min(k) + 113",
    "humidity": "sum(k) {div} count(*)",
    "visibility": "max(k)",
    "visibilityMiles": "min(k)",
    "pressure": "1000 + max(k) - min(k)",
    "pressureInches": "29 + max(k) {div} 50",
    "cloudcover": "(min(k) + max(k)) {div} 2",
    "HeatIndexC": "max(cents) {div} 100",
    "HeatIndexF": "max(cents)",
    "DewPointC": "min(cents) {div} 100",
    "DewPointF": "min(cents)",
    "WindChillC": "min(k) - 20",
    "WindChillF": "min(cents) - 500",
    "WindGustMiles": "count(*) + max(k)",
    "WindGustKmph": "2 * count(*) + 2 * max(k)",
    "FeelsLikeC": "(max(k) + min(k)) {div} 3",
    "FeelsLikeF": "(max(cents) + min(cents)) {div} 2",
    "uvIndex": "max(k) {div} 10",
    "precipMM": "min(value)",
    "precipInches": "max(value)",
    "value": "sum(cents)",
}
HOURLY = ["zone", "datetime", "tempF", "windspeedMiles", "humidity", "value"]
PATCHES = {
    "tempF": "CASE WHEN windspeedMiles > 1 THEN tempF END",
    "humidity": "CASE WHEN humidity >= 20 THEN humidity END",
    "value": "CASE WHEN zone <> 'error' OR humidity >= 45 THEN value END",
}


def _typed(name: str, text: str, div: str = "//", quote: str = '"') -> str:
    kind = "DOUBLE" if name in schemas.WEATHER_DOUBLES else "BIGINT"
    return f"CAST({text.format(div=div)} AS {kind}) AS {quote}{name}{quote}"


CTES = {
    "readings": """readings AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)""",
    "keyed": "keyed AS (\n  SELECT date_trunc('hour', ts) AS datetime, event_type AS zone,\n"
    "         min(event_id) AS row_id, event_type || ' - Area' AS \"subba-name\",\n"
    "         'megawatthours' AS \"value-units\",\n         "
    + ",\n         ".join(_typed(n, t) for n, t in MEASURES.items())
    + "\n  FROM readings GROUP BY 1, 2)",
    "raw": "raw AS (SELECT "
    + ", ".join(f'"{f.name}"' for f in schemas.RAW_SCHEMA.fields)
    + " FROM keyed)",
    "hourly": "hourly AS (SELECT " + ", ".join(f'"{c}"' for c in HOURLY) + " FROM keyed)",
    "patchy": "patchy AS (SELECT "
    + ", ".join(f'{PATCHES[c]} AS "{c}"' if c in PATCHES else f'"{c}"' for c in HOURLY)
    + " FROM hourly)",
    "recent": "recent AS (SELECT * FROM hourly WHERE datetime >= "
    "(SELECT max(datetime) FROM hourly) - INTERVAL 7 DAY)",
    "predicted": "predicted AS (SELECT * FROM (SELECT *, lag(value) OVER "
    "(PARTITION BY zone ORDER BY datetime) AS guess FROM hourly) WHERE guess IS NOT NULL)",
    "places": """places AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         CAST(25 AS DOUBLE) + c_nationkey + round(c_acctbal) / 16384 AS lat,
         -(CAST(70 AS DOUBLE) + 2 * c_nationkey + round(c_acctbal) / 32768) AS lon
  FROM customer)""",
}
NEEDS = {
    "readings": [],
    "keyed": ["readings"],
    "raw": ["readings", "keyed"],
    "hourly": ["readings", "keyed"],
    "patchy": ["readings", "keyed", "hourly"],
    "recent": ["readings", "keyed", "hourly"],
    "predicted": ["readings", "keyed", "hourly"],
    "places": [],
}


def sql(body: str, *tables: str, more: str = "", recursive: bool = False) -> str:
    """An oracle query: the named fixture CTEs, further CTEs, then the body."""
    names: list[str] = []
    for t in tables:
        names += [n for n in (*NEEDS[t], t) if n not in names]
    parts = [CTES[n] for n in names] + ([more.strip().rstrip(",")] if more else [])
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" if parts else ""
    return head + body.strip()


def entry(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the same question for DuckDB."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLE[name] = oracle
        return build

    return register


def r(column: Column | str, digits: int = 6) -> Column:
    """Rounded, with minus zero made plain zero."""
    column = cname(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def rq(expression: str, digits: int = 6) -> str:
    """The SQL twin of ``r``."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0.0)"


def stamp(column: Column | str, name: str = "datetime") -> Column:
    """A timestamp as text."""
    column = cname(column) if isinstance(column, str) else column
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)


def stamp_q(expression: str, name: str = "datetime") -> str:
    """The SQL twin of ``stamp``."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"


def seeded_q(*keys: str, seed: int = 42) -> str:
    """The SQL twin of ``seeded_order``."""
    return f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(keys)})), 1, 15) AS BIGINT)"


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Round the listed columns in place."""
    return df.select(*[r(c, digits).alias(c) if c in columns else cname(c) for c in df.columns])


def timed(df: DataFrame, column: str = "datetime") -> DataFrame:
    """Turn a timestamp column to text in place."""
    return df.withColumn(column, stamp(column, column))
