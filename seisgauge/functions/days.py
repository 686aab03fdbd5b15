"""Calendar days and the Julian day numbers the facts are keyed by."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the Julian day number of 1970-01-01.
UNIX_EPOCH_JULIAN_DAY = 2440588


def julian_day(day: Column) -> Column:
    """Julian day number of a date column."""
    return F.unix_date(day) + F.lit(UNIX_EPOCH_JULIAN_DAY)


def from_julian_day(number: Column) -> Column:
    """Date of a Julian day number column."""
    return F.date_from_unix_date(number - F.lit(UNIX_EPOCH_JULIAN_DAY))


def as_date(day: dt.date | str) -> dt.date:
    """A day given as such, as ``YYYY-M-D`` or as ``YYYY-DDD`` (day of the year)."""
    if not isinstance(day, str):
        return day
    year, *rest = map(int, day.split("-"))
    if len(rest) != 1:
        return dt.date.fromisoformat(day) if len(rest) != 2 else dt.date(year, *rest)
    found = dt.date(year, 1, 1) + dt.timedelta(days=rest[0] - 1)
    if found.year != year:
        raise ValueError(f"not a day: {day}")
    return found


def julian_number(day: dt.date | str) -> int:
    """Julian day number of a Python date, so window bounds reach the scan as literals."""
    return (as_date(day) - dt.date(1970, 1, 1)).days + UNIX_EPOCH_JULIAN_DAY


def parse_day(text: Column) -> Column:
    """``YYYY-MM-DD`` or ``YYYY-DDD`` (day of the year); anything else gives NULL."""
    year_start = F.concat(F.substring(text, 1, 4), F.lit("-01-01")).try_cast("date")
    ordinal = F.substring_index(text, "-", -1).try_cast("int")
    by_ordinal = F.date_add(year_start, ordinal - 1)
    return (
        F.when(text.rlike(r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
        .when(
            text.rlike(r"^(?!0000)\d{4}-\d{1,3}$")
            & (ordinal >= 1)
            & (F.year(by_ordinal) == F.year(year_start)),
            by_ordinal,
        )
    )


def day_spine(spark: SparkSession, begin: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day from ``begin`` to ``end``, both included; none if reversed."""
    begin, end = as_date(begin), as_date(end)
    days = max((end - begin).days + 1, 0)
    return spark.range(days).select(
        F.date_add(F.lit(begin), F.col("id").cast("int")).alias("day")
    )
