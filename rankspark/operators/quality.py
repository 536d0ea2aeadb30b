"""Table rules as distributed checks (Q1 - Q5); each returns what breaks a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rankspark.schemas import Table


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n``.

    As in a unique index, a key with a NULL part never clashes.
    """
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def orphans(children: DataFrame, parents: DataFrame, key: str = "movie_id") -> DataFrame:
    """Referenced keys without a parent row, with the number of children ``n``.

    Children are counted per key first: the join then sees one row per key,
    however hot a key is.
    """
    referenced = children.dropna(subset=[key]).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return referenced.join(parents.select(key), key, "left_anti")


def null_violations(df: DataFrame, table: Table) -> DataFrame:
    """(rule, n) per required column, from one pass."""
    return _count_rules(df, null_rules(df, table))


def length_violations(df: DataFrame, table: Table) -> DataFrame:
    """(rule, n) per column with a length limit, from one pass."""
    return _count_rules(df, length_rules(df, table))


def null_rules(df: DataFrame, table: Table) -> dict[str, Column]:
    return {
        f"{table.name}.{c.name}:required": F.col(c.name).isNull()
        for c in table.columns
        if c.required and c.name in df.columns
    }


def length_rules(df: DataFrame, table: Table) -> dict[str, Column]:
    return {
        f"{table.name}.{c.name}:max_length": F.length(c.name) > c.max_length
        for c in table.columns
        if c.max_length and c.name in df.columns
    }


def violating_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that break at least one rule, with the names of the broken ones."""
    broken = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())))
    any_broken = reduce(lambda a, b: a | b, (F.coalesce(t, F.lit(False)) for t in rules.values()))
    return df.filter(any_broken).withColumn("broken_rules", broken)


def _count_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    counts = df.agg(*(F.count_if(test).alias(name) for name, test in rules.items()))
    return counts.unpivot([], [f"`{name}`" for name in rules], "rule", "n")
