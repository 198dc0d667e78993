"""Time columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cyclic periods collapse all days onto one clock; every other name is a `date_trunc` unit.
CYCLIC = {
    "hour_of_day": F.hour,
    "day_of_week": F.dayofweek,
    "month_of_year": F.month,
}


def period(ts: Column, unit: str = "hour_of_day") -> Column:
    """The time period a timestamp falls into."""
    if unit in CYCLIC:
        return CYCLIC[unit](ts)
    return F.date_trunc(unit, ts)


def utc_wall(ts: Column) -> Column:
    """A `timestamp` as UTC wall clock (`timestamp_ntz`), whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


# Years 1 to 9999; numbers outside make no timestamp, and casting them would end the job.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def epoch_millis(value: Column) -> Column:
    """Milliseconds since 1970 as a timestamp; null if the value is no such number."""
    number = value.try_cast("long")
    known = number.between(FIRST_SECOND * 1000, LAST_SECOND * 1000 + 999)
    return F.timestamp_millis(F.when(known, number))


def epoch_seconds(value: Column) -> Column:
    """Seconds since 1970 as a timestamp; null if the value is no such number."""
    number = value.try_cast("long")
    return F.timestamp_seconds(F.when(number.between(FIRST_SECOND, LAST_SECOND), number))


def day_time(day: str, clock: Column) -> Column:
    """A timestamp from a fixed day and a column of clock times; null if the text is no time."""
    return F.try_to_timestamp(F.concat(F.lit(day + " "), clock), F.lit("yyyy-MM-dd HH:mm:ss"))
