"""Input tables and intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankspark.runtime import new_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@contextmanager
def _shuffles_end_with_the_job(spark: SparkSession) -> Iterator[None]:
    old = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, old)


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = (), compression: str = "snappy") -> DataFrame:
    """The rows as a table of the shared folder: computed once, safe from lost executors.

    Its shuffle files go when it is written, so that the disk never holds the shuffles of
    more than one step.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with _shuffles_end_with_the_job(spark):
        df.write.partitionBy(*partition_by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that `stored` wrote, when nothing will read it again."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def null_safe(column: str) -> Column:
    """An id as a join key: a null id joins a null id."""
    return F.coalesce(F.col(column), F.lit(-(1 << 63)).cast("long"))
