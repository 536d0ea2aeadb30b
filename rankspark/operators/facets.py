"""Facet values and facet filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from rankspark.functions import DATE_BUCKETS, date_bucket, date_bucket_range
from rankspark.sinks.layouts import day_column


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column with their row counts, in value order."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def facet_filter(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows with exactly this value; None picks the rows without one."""
    test = F.col(column).isNull() if value is None else F.col(column) == F.lit(value)
    return df.filter(test)


def facet_filter_date(df: DataFrame, column: str, bucket: str, as_of: dt.date) -> DataFrame:
    """Rows of a date bucket; of a table that lies by day (``sinks.layouts``) only its days are read.

    A day more at both ends, as the days may have been written in another time zone.
    """
    rows = df.filter(date_bucket(F.col(column), bucket, as_of))
    day = day_column(column)
    if day not in df.columns:
        return rows
    low, high = date_bucket_range(bucket, as_of)
    near = F.col(day).between(F.lit(low - dt.timedelta(days=1)), F.lit(high))
    return rows.filter(near).drop(day)


def facet_date_counts(df: DataFrame, column: str, as_of: dt.date) -> DataFrame:
    """(bucket, n) for every date bucket; they overlap, and one pass counts them all."""
    counts = df.agg(
        *(F.count_if(date_bucket(F.col(column), b, as_of)).alias(b) for b in DATE_BUCKETS)
    )
    return counts.unpivot([], list(DATE_BUCKETS), "bucket", "n")
