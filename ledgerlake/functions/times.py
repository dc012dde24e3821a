"""Column -> Column conversions of dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_ts(value: Column, kind: T.DataType) -> Column:
    """A timestamp from whatever the source delivers.

    Change messages carry epoch microseconds, snapshots a real timestamp and documents
    ISO text, so the rule is chosen by the column's type and not by its name.
    """
    if isinstance(kind, T.TimestampType):
        return value
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return value.cast("timestamp")
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(value)
    return F.timestamp_micros(value.try_cast("long"))


def month_year(value: Column) -> Column:
    """`MM/YYYY` (or `M/YYYY`) as the first of that month, null when unreadable."""
    return F.try_to_timestamp(value, F.lit("M/yyyy"))


def compose_ts(year: Column, month: Column, day: Column, clock: Column) -> Column:
    """Timestamp from separate year, month, day and `HH:MM` columns."""
    hour, minute = (F.split_part(clock, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2))
    whole = (part.try_cast("int") for part in (year, month, day))
    return F.try_make_timestamp(*whole, hour, minute, F.lit(0))


def minus_minutes(value: Column, minutes: Column | int) -> Column:
    minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
    return value - F.make_interval(mins=minutes)


def archive_day(arrived: Column) -> list[Column]:
    """The year/month/day folders of the topic archive, by UTC arrival time."""
    return [
        F.date_format(arrived, "yyyy").alias("year"),
        F.date_format(arrived, "MM").alias("month"),
        F.date_format(arrived, "dd").alias("day"),
    ]
