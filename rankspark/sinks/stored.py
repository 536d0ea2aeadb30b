"""Parquet result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rankspark.schemas import Table, conform


def write_stored(df: DataFrame, base: str, table: Table, mode: str = "overwrite") -> str:
    """Write one contract table by itself, in place; ``sinks.versions`` publishes several at once."""
    path = f"{base.rstrip('/')}/{table.name}"
    conform(df, table).write.mode(mode).parquet(path)
    return path


def refuse_stored(rows: DataFrame, stored: DataFrame, table: Table) -> None:
    """Fail if a key of the rows is stored already."""
    keys = list(table.unique)
    if keys and not rows.select(*keys).join(stored.select(*keys), keys, "left_semi").isEmpty():
        raise ValueError(f"{table.name}: rows with these {', '.join(keys)} are stored already")
