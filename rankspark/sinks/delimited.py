"""CSV files in the layout that ``sources.delimited`` reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from rankspark.schemas import CSV_NAMES, ITEMS_CSV, RATINGS_CSV


def write_items_csv(items: DataFrame, base: str) -> None:
    _write(items, ITEMS_CSV, f"{base.rstrip('/')}/movies.csv")


def write_ratings_csv(ratings: DataFrame, base: str) -> None:
    _write(ratings, RATINGS_CSV, f"{base.rstrip('/')}/ratings.csv")


def _write(df: DataFrame, schema: T.StructType, path: str) -> None:
    columns = [df[CSV_NAMES.get(f.name, f.name)].alias(f.name) for f in schema]
    df.select(*columns).write.options(header=True, escape='"').csv(path)
