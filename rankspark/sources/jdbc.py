"""JDBC table scan (S3).  All connection facts come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """A database: its URL and the driver options (user, password, driver, ...)."""

    url: str
    options: dict[str, str] = field(default_factory=dict, repr=False)


@dataclass(frozen=True)
class Split:
    """Read in parallel by ranges of a numeric or date column."""

    column: str
    lower: object
    upper: object
    partitions: int

    def as_options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_options(
    target: JdbcTarget, table: str, split: Split | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    options = {"url": target.url, "dbtable": table, "fetchsize": str(fetch_size)}
    options.update(target.options)
    if split is not None:
        options.update(split.as_options())
    return options


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    columns: list[str] | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Scan a table; Catalyst sends the column list and simple filters to the database.

    Without a ``split`` the whole table comes through one task, which suits only
    small tables.
    """
    options = read_options(target, table, split, fetch_size)
    df = spark.read.format("jdbc").options(**options).load()
    return df.select(*columns) if columns else df
