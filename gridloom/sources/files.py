"""CSV, JSON, Parquet and text files: plain Spark readers and writers with fixed schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.calendar import hour_label
from gridloom.operators.ordered import cname


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """One CSV file or a folder of them, with header. Without a schema types are inferred,
    which reads the data twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", hour_columns: Sequence[str] = ()) -> None:
    """CSV with header. ``hour_columns`` are written as ``yyyy-MM-ddTHH``; appending adds files,
    each with its own header, that one read sees as one table."""
    shaped = df.withColumns({c: hour_label(cname(c)) for c in hour_columns}) if hour_columns else df
    shaped.write.mode(mode).option("header", True).csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Line-delimited records or arrays of records."""
    return spark.read.schema(schema).json(path)


def json_records(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """A text column holding a JSON array of records → rows."""
    layout = schema if isinstance(schema, str) else schema.simpleString()
    return df.select(F.inline(F.from_json(column, f"array<{layout}>")))


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A folder of text files: (name, text), one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("name"), F.col("value").alias("text")
    )


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A table with a ``split`` column, one folder per split."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split (only its folder is read), without a stray index column."""
    return (
        spark.read.parquet(path).filter(F.col("split") == split).drop("split", "Unnamed: 0")
    )


def write_report(df: DataFrame, path: str) -> None:
    """A findings report: exactly one JSON record."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a findings report back; anything but one record is an error."""
    report = spark.read.schema(schema).json(path)
    found = report.limit(2).count()
    if found != 1:
        raise ValueError(f"expected one report at {path}, found {'none' if not found else 'several'}")
    return report
