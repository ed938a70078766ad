"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_name(column: Column) -> Column:
    """Everything but ASCII letters and digits becomes an underscore."""
    return F.regexp_replace(column, "[^A-Za-z0-9]", "_")


def first_token(column: Column, separator: str = "_") -> Column:
    return F.substring_index(column, separator, 1)


def last_token(column: Column, separator: str = ":") -> Column:
    """Text after the last separator, trimmed."""
    return F.trim(F.substring_index(column, separator, -1))


def company_name(entry: Column) -> Column:
    """``Name:TICKER`` → name."""
    return F.substring_index(entry, ":", 1)


def company_ticker(entry: Column) -> Column:
    """``Name:TICKER.SUFFIX`` → ticker without the suffix."""
    return F.substring_index(F.substring_index(entry, ":", -1), ".", 1)


def row_text(columns: Sequence[str]) -> Column:
    """``"a": 1, "b": x`` — a row as one line of text; a missing value reads ``nan``."""
    return F.concat_ws(
        ", ",
        *[
            F.concat(
                F.lit(f'"{c}": '), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan"))
            )
            for c in columns
        ],
    )


def stamped_name(name: Column, as_of: Column) -> Column:
    """``<safe name>_yyyyMMdd_HHmmss``."""
    return F.concat(safe_name(name), F.lit("_"), F.date_format(as_of, "yyyyMMdd_HHmmss"))
