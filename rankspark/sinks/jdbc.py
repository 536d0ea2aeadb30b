"""JDBC writers for the two result tables (K1 - K4, K6).

The item table is the parent of the recommendation table and there is no
transaction across both, so parents are written first and children cleared
first (``plans.batch.to_database``).  Overwriting truncates the tables instead of dropping them, which keeps
their keys and makes a repeated run end in the same state.  An append is not
repeatable: a rerun hits the unique item id.

A database that refuses to truncate a table which others refer to must be told
so in the URL; MySQL takes ``sessionVariables=foreign_key_checks=0``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rankspark.schemas import ITEMS, RECOMMENDATIONS, Table, conform
from rankspark.sources.jdbc import JdbcTarget

#: Most connections that one write opens; more tasks take turns.
CONNECTIONS = 8


def write_options(
    target: JdbcTarget, table_name: str, batch_size: int = 10_000, connections: int = CONNECTIONS
) -> dict[str, str]:
    options = {
        "url": target.url,
        "dbtable": table_name,
        "batchsize": str(batch_size),
        "truncate": "true",
        "numPartitions": str(connections),
    }
    return options | target.options


def write_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    table: Table,
    mode: str,
    names: Mapping[str, str] | None = None,
    narrow: bool = True,
    **tuning: int,
) -> None:
    """Write one contract table.

    ``names`` maps contract names to the names used in the database,
    ``connections`` bounds the number of parallel writers.
    """
    options = write_options(target, (names or {}).get(table.name, table.name), **tuning)
    conform(df, table, narrow).write.format("jdbc").options(**options).mode(mode).save()


def clear_tables(spark: SparkSession, target: JdbcTarget, **settings) -> None:
    """Empty both tables, children first."""
    for table in (RECOMMENDATIONS, ITEMS):
        empty = spark.createDataFrame([], table.ddl)
        write_jdbc(empty, target, table, "overwrite", **settings)
