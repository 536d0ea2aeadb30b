"""Layouts for tables that are written once and joined or filtered often.

By item: rows are bucketed and sorted by item id, so that joins and counts by item move no row
of theirs.  A bucket is one task, which adaptive execution cannot split; the rows of hot items, of
which there are few by their definition, therefore lie apart, unbucketed, and are joined by
plain shuffles, which it can.

By day: a partition for each day of a timestamp, so that date filters read only their days.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

#: An item is hot if it holds more than this share of an average bucket.
HOT_SHARE = 0.25


@dataclass(frozen=True)
class ByItem:
    """A table by item: the name of the bucketed part and the path of the hot one, if there is one."""

    spark: SparkSession
    name: str
    hot: str | None
    ddl: str

    @property
    def bucketed(self) -> DataFrame:
        return self.spark.table(self.name)

    def parts(self) -> list[DataFrame]:
        if self.hot is None:
            return [self.bucketed]
        return [self.bucketed, self.spark.read.schema(self.ddl).parquet(self.hot)]

    def frame(self) -> DataFrame:
        return self.each(lambda part: part)

    def each(self, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The rows that ``work`` makes of either part; no item is in both."""
        return reduce(DataFrame.unionByName, map(work, self.parts()))

    def drop(self) -> None:
        """Take the name out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def write_by_item(df: DataFrame, folder: str, buckets: int | None = None, key: str = "movie_id") -> ByItem:
    """Write a table by item below ``folder``, which executors see.

    There are as many buckets as shuffle partitions, so that a shuffle can join them as they
    lie.  At most ``buckets / HOT_SHARE`` items can be hot; only their ids come to the driver.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = df.count() * HOT_SHARE / buckets
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    ids = [row[0] for row in counts.where((F.col("n") > most) & (F.col("n") > 1)).collect()]
    hot = F.coalesce(F.col(key).isin(ids), F.lit(False)) if ids else F.lit(False)
    name = f"by_item_{uuid.uuid4().hex}"
    # One file for each bucket, from the task that has all of its rows.
    rows = df.where(~hot).repartition(buckets, key)
    writer = rows.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/bucketed")
    writer.saveAsTable(name)
    if ids:
        df.where(hot).write.parquet(f"{folder}/hot")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return ByItem(spark, name, f"{folder}/hot" if ids else None, ddl)


def day_column(column: str) -> str:
    return f"{column}_day"


def write_by_day(df: DataFrame, path: str, column: str) -> None:
    """Write a table with a partition for each day of ``column``; a hot day gets several files."""
    day = day_column(column)
    rows = df.withColumn(day, F.col(column).cast("date"))
    rows.hint("rebalance", day).write.partitionBy(day).parquet(path)


def read_by_day(spark: SparkSession, path: str, ddl: str, column: str) -> DataFrame:
    """The table with its day, by which ``facets.facet_filter_date`` picks partitions."""
    return spark.read.schema(f"{ddl}, `{day_column(column)}` date").parquet(path)
