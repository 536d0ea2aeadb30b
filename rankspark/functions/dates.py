"""Calendar buckets for timestamp columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DATE_BUCKETS = ("today", "past_7_days", "this_month", "this_year")


def date_bucket_range(bucket: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Half-open [first day, day after the last) of a bucket seen from ``as_of``."""
    tomorrow = as_of + dt.timedelta(days=1)
    if bucket == "today":
        return as_of, tomorrow
    if bucket == "past_7_days":
        return as_of - dt.timedelta(days=7), tomorrow
    if bucket == "this_month":
        first = as_of.replace(day=1)
        return first, (first + dt.timedelta(days=31)).replace(day=1)
    if bucket == "this_year":
        return dt.date(as_of.year, 1, 1), dt.date(as_of.year + 1, 1, 1)
    raise ValueError(f"unknown date bucket {bucket!r}; known: {', '.join(DATE_BUCKETS)}")


def date_bucket(column: Column, bucket: str, as_of: dt.date) -> Column:
    """Range test against two literals, which file sources can use to skip data.

    The bounds are bare timestamps without zone; Spark reads them in the session
    zone when the column is an instant.
    """
    low, high = date_bucket_range(bucket, as_of)
    return (column >= _midnight(low)) & (column < _midnight(high))


def _midnight(day: dt.date) -> Column:
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")
