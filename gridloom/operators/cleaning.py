"""Row and column selection, null handling, coercion."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom import schemas
from gridloom.operators.ordered import attach, cname, join_on_keys


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any null."""
    return df.na.drop("any")


def clean(df: DataFrame) -> DataFrame:
    """Complete rows, each distinct row once. Copies collapse before the shuffle."""
    return df.na.drop("any").dropDuplicates()


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric columns in schema order, minus the excluded ones."""
    skipped = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skipped
    ]


def first_columns(df: DataFrame, *leading: str) -> DataFrame:
    """Move columns to the front, keep the order of the rest."""
    rest = [c for c in df.columns if c not in leading]
    return df.select(*[cname(c) for c in (*leading, *rest)])


def select_final(df: DataFrame) -> DataFrame:
    """The 32 columns of the preprocessed table."""
    return df.select(*[cname(c) for c in schemas.FINAL_COLUMNS])


def model_columns(
    df: DataFrame, features: Sequence[str] = tuple(schemas.TRAINING_FEATURES),
    since: str | None = None,
) -> DataFrame:
    """Features and label, optionally only from a date on (the filter reaches the scan)."""
    if since is not None:
        df = df.filter(cname("datetime") >= F.lit(since).cast(df.schema["datetime"].dataType))
    return df.select(*[cname(c) for c in (*features, schemas.MODEL_LABEL)])


def not_in_groups(df: DataFrame, groups: DataFrame, column: str) -> DataFrame:
    """Rows whose group is not listed; rows without a group are kept."""
    return attach(df, groups.select(cname(column)).distinct(), [column], "left_anti")


def in_groups(df: DataFrame, groups: DataFrame, column: str) -> DataFrame:
    """Rows whose group is listed."""
    return attach(df, groups.select(cname(column)).distinct(), [column], "left_semi")


def fill_zero(df: DataFrame) -> DataFrame:
    """Null numbers become 0."""
    return df.na.fill(0)


def clip_negatives(df: DataFrame, columns: Sequence[str] = tuple(schemas.NON_NEGATIVE)) -> DataFrame:
    """Negative or missing values of the named columns, where present, become 0."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns(
        {c: F.when(cname(c) >= 0, cname(c)).otherwise(F.lit(0)).cast(df.schema[c].dataType)
         for c in present}
    )


def text_nan_to_null(df: DataFrame) -> DataFrame:
    """The text ``nan`` (and a floating NaN) means a missing value."""
    changed: dict[str, Column] = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = F.nullif(cname(field.name), F.lit("nan"))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = F.when(~F.isnan(cname(field.name)), cname(field.name))
    return df.withColumns(changed) if changed else df


def to_number_or_zero(column: Column, integer: bool = True) -> Column:
    """Text to number; anything that is no number becomes 0."""
    number = F.coalesce(column.try_cast("double"), F.lit(0.0))
    return number.cast("bigint") if integer else number


def to_number_or_null(column: Column) -> Column:
    return column.try_cast("double")


def to_hour_or_null(column: Column) -> Column:
    """``yyyy-MM-ddTHH`` text, or a full timestamp text, to a timestamp; null if neither."""
    return F.coalesce(
        F.try_to_timestamp(column, F.lit("yyyy-MM-dd'T'HH")), column.try_cast("timestamp")
    ).cast("timestamp_ntz")


def retype_raw(df: DataFrame) -> DataFrame:
    """Bring text measures to the raw table's types; unlisted columns become text."""
    known = {f.name: f.dataType for f in schemas.RAW_SCHEMA.fields}
    columns = []
    for name in df.columns:
        kind = known.get(name)
        if isinstance(kind, T.LongType):
            column = to_number_or_zero(cname(name).cast("string"))
        elif isinstance(kind, T.DoubleType):
            column = to_number_or_zero(cname(name).cast("string"), integer=False)
        elif isinstance(kind, T.TimestampNTZType):
            column = to_hour_or_null(cname(name).cast("string"))
        else:
            column = cname(name).cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


def features_only(
    df: DataFrame, dropped: Sequence[str] = ("value", "datetime", "subba-name", "zone")
) -> DataFrame:
    """The model input: everything but target and identifiers."""
    return df.drop(*dropped)


def lookup_by_key(rows: DataFrame, source: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Bring dropped columns back to the rows of a split by their row key."""
    return join_on_keys(rows, source.select(*[cname(c) for c in (*key, *columns)]), key, "left")
