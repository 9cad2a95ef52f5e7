"""Date parsing, keys and look-back windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(text: Column) -> Column:
    """The day of an ISO timestamp string, from its first ten characters."""
    return F.to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def day_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def run_stamp(ts: Column) -> Column:
    """Timestamp as used in output keys, e.g. 20240701_093000."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def look_back(as_of: dt.date | str, days: int) -> tuple[dt.date, dt.date]:
    """The closed interval of ``days`` days before ``as_of`` up to it."""
    end = as_date(as_of)
    return end - dt.timedelta(days=days), end


# fixed values: look-back of the scheduled run and of the climate job
SCHEDULED_DAYS = 30
CLIMATE_DAYS = 120


def in_days(ts: Column, start: dt.date | str, end: dt.date | str) -> Column:
    """``ts`` falls on a day of the closed interval.

    Written as a half-open range on the raw column, so that it is pushed down
    to the file scan.
    """
    upper = as_date(end) + dt.timedelta(days=1)
    return (ts >= F.lit(as_date(start)).cast("timestamp_ntz")) & (
        ts < F.lit(upper).cast("timestamp_ntz")
    )
