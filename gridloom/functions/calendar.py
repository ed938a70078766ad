"""Date text, hour text and date ranges as expressions; "today" is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "dd-MM-yyyy"


def hour_of(time_text: Column) -> Column:
    """``0``, ``100`` … ``2300`` → ``00`` … ``23``. Text longer than four is cut, not padded."""
    padded = F.when(F.length(time_text) < 4, F.lpad(time_text, 4, "0")).otherwise(time_text)
    return F.substring(padded, 1, 2)


def hour_text(day: Column, time_text: Column) -> Column:
    """``yyyy-MM-ddTHH``."""
    return F.concat(day, F.lit("T"), hour_of(time_text))


def hour_timestamp(text: Column) -> Column:
    """``yyyy-MM-ddTHH`` → timestamp without zone; null if malformed."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH")).cast("timestamp_ntz")


def hour_label(ts: Column) -> Column:
    """Timestamp → ``yyyy-MM-ddTHH``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone, whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)


def parse_day(text: Column) -> Column:
    """``dd-mm-yyyy`` → date; null if malformed."""
    return F.try_to_timestamp(text, F.lit(DAY_FORMAT)).cast("date")


def iso_day(text: Column) -> Column:
    """``dd-mm-yyyy`` → ``yyyy-MM-dd``; null if malformed."""
    return F.date_format(parse_day(text), "yyyy-MM-dd")


def split_months(start: Column, end: Column, months: int = 1) -> Column:
    """Array of (start, end) ranges of ``months`` months anchored on the start day.

    Each start is the one before plus the step, so a day clamped by a short month (31 Jan →
    28 Feb) stays clamped in the ranges after it.
    """
    count = F.ceil(F.months_between(end, start) / months).cast("int") + F.lit(1)
    chain = F.aggregate(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        F.array(start),
        lambda starts, _: F.concat(
            starts, F.array(F.add_months(F.element_at(starts, -1), months))
        ),
    )
    ranges = F.transform(
        chain,
        lambda s: F.struct(
            s.alias("start"), F.least(F.date_sub(F.add_months(s, months), 1), end).alias("end")
        ),
    )
    return F.filter(ranges, lambda r: r["start"] <= end)


def split_half_years(start: Column, end: Column) -> Column:
    return split_months(start, end, 6)


def split_years(start: Column, end: Column) -> Column:
    """Array of (start, end) ranges cut at calendar years."""
    return F.transform(
        F.sequence(F.year(start), F.year(end)),
        lambda y: F.struct(
            F.greatest(start, F.make_date(y, F.lit(1), F.lit(1))).alias("start"),
            F.least(end, F.make_date(y, F.lit(12), F.lit(31))).alias("end"),
        ),
    )


def last_days(as_of: Column, days: int = 2) -> Column:
    """(start, end) texts ``dd-mm-yyyy`` of the last ``days`` days ending at ``as_of``."""
    return F.struct(
        F.date_format(F.date_sub(as_of, days - 1), DAY_FORMAT).alias("start"),
        F.date_format(as_of, DAY_FORMAT).alias("end"),
    )
