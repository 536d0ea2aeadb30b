"""Scan of published result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankspark.schemas import Table
from rankspark.sinks import versions


def read_stored(spark: SparkSession, base: str, table: Table) -> DataFrame:
    """A result table in contract column order, as the last finished run left it.

    Without a manifest it is the plain folder that ``sinks.write_stored`` writes.  Tables that
    must fit each other are read by ``read_published``.
    """
    manifest = versions.current(spark, base)
    if manifest is None:
        return spark.read.schema(table.ddl).parquet(f"{base.rstrip('/')}/{table.name}")
    return _of(spark, base, manifest, table)


def read_published(spark: SparkSession, base: str, *tables: Table) -> list[DataFrame]:
    """Tables of one state: a run that is published meanwhile changes none of them."""
    manifest = versions.current(spark, base)
    if manifest is None:
        raise FileNotFoundError(f"{base}: nothing is published")
    return [_of(spark, base, manifest, table) for table in tables]


def _of(spark: SparkSession, base: str, manifest: versions.Manifest, table: Table) -> DataFrame:
    found = versions.read(spark, base, manifest, table)
    if found is None:
        raise FileNotFoundError(f"{base}: version {manifest.version} has no {table.name}")
    return found
