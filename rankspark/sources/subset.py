"""Development runs on the first n items (S6) and their ratings (F1)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rankspark.operators.paging import top_n


def item_subset(items: DataFrame, n: int) -> DataFrame:
    """The n items with the smallest ids, so that every run sees the same ones."""
    return top_n(items, [("movie_id", False)], n)


def ratings_of(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Ratings whose item is in ``items``; a NULL id never matches.

    A semi join, so no id list passes through the driver.  Catalyst broadcasts
    the ids only while they are below its size threshold and otherwise shuffles,
    where adaptive execution can split a hot item.
    """
    return ratings.join(items.select("movie_id"), "movie_id", "left_semi")
