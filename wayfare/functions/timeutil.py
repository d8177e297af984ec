"""Calendar arithmetic on naive timestamps.

Everything here is built from date parts, so a result never depends on the
session time zone, and every expression stays inside generated code.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(c: Column) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(c.cast("date"), F.lit(date(1970, 1, 1)))


def minute_number(c: Column) -> Column:
    """Minutes since the epoch, truncated: differences count boundaries crossed."""
    return day_number(c).cast("long") * 1440 + F.hour(c) * 60 + F.minute(c)


def second_number(c: Column) -> Column:
    return minute_number(c) * 60 + F.second(c)


def minutes_between(earlier: Column, later: Column) -> Column:
    return minute_number(later) - minute_number(earlier)


def seconds_between(earlier: Column, later: Column) -> Column:
    return second_number(later) - second_number(earlier)


def minutes_elapsed(earlier: Column, later: Column) -> Column:
    """Whole minutes of elapsed time, rounded down."""

    def seconds(c: Column) -> Column:
        return minute_number(c) * 60 + F.date_part(F.lit("SECOND"), c)

    return F.floor((seconds(later) - seconds(earlier)) / 60).cast("long")


def day_start(day: Column) -> Column:
    """Midnight of a date as a naive timestamp."""
    return day.cast("timestamp_ntz")


def from_epoch_seconds(c: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c.cast("decimal(18,6)"))


def week_start(day: Column) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(day, "week")


def ntz(value: date | datetime) -> Column:
    return F.lit(value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()).cast(
        "timestamp_ntz"
    )


def within_days(c: Column, start: date, end: date) -> Column:
    """From the start of `start` to the end of `end`; a range a scan can push down."""
    return (c >= ntz(start)) & (c < ntz(end + timedelta(days=1)))
