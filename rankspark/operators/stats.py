"""Per-item statistics and the three global means.

The three means differ on purpose and are never mixed:

* ``ratings_mean``, ``ratings_prior``: mean over all ratings;
* ``items_prior``: mean of the per-item means of all rated items;
* ``dashboard_mean``: mean over the item table, unrated items counted as 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rankspark.functions import exact_mean, falsy_default

# Fixed value: the mean used when there is no rating, or only zeros.
FALLBACK_MEAN = 3.0


def item_stats(ratings: DataFrame) -> DataFrame:
    """One row per rated item: movie_id, rating_sum, avg_rating, rating_count, row_count.

    NULL ratings count only in ``row_count``; ratings without an item id form one
    group of their own, which no join matches but which both priors include.

    Sums and counts are combined map-side, so a hot item costs one row per task
    in the shuffle.  The CASE around the id holds Catalyst's inferred
    "id is not NULL" above the aggregate.  Pushed below, that test would stand in
    the branch that joins and not in the branch that computes the prior; the two
    would no longer share one exchange, and the ratings would be read twice.  It
    also puts a shuffle of its own under a following join, where adaptive
    execution can split a skewed partition.
    """
    totals = ratings.groupBy("movie_id").agg(
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_count"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return _with_mean(totals)


def merge_stats(*parts: DataFrame) -> DataFrame:
    """The statistics of all ratings from those of disjoint parts of them.

    One row per item and part is shuffled; no rating is read again.
    """
    columns = ["movie_id", "rating_sum", "rating_count", "row_count"]
    rows = reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])
    return _with_mean(rows.groupBy("movie_id").agg(*(F.sum(c).alias(c) for c in columns[1:])))


def _with_mean(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.when(F.col("rating_count") >= 0, F.col("movie_id")).alias("movie_id"),
        "rating_sum",
        F.try_divide("rating_sum", "rating_count").alias("avg_rating"),
        "rating_count",
        "row_count",
    )


def ratings_mean(ratings: DataFrame) -> DataFrame:
    """Mean over all ratings; one row, column ``prior``.

    Reads one column and shuffles one row per task: the cheapest way when nothing
    else is wanted.  With statistics at hand, ``ratings_prior`` costs less.
    """
    return ratings.agg(falsy_default(F.avg("rating"), FALLBACK_MEAN).alias("prior"))


def ratings_prior(stats: DataFrame) -> DataFrame:
    """The same mean from the item sums, without another look at the ratings."""
    mean = F.try_divide(F.sum("rating_sum"), F.sum("rating_count"))
    return stats.agg(falsy_default(mean, FALLBACK_MEAN).alias("prior"))


def items_prior(stats: DataFrame) -> DataFrame:
    """Mean of the item means, whatever their order; NULL when nothing is rated."""
    return stats.agg(exact_mean(F.col("avg_rating")).alias("prior"))


PRIORS = {"ratings": ratings_prior, "items": items_prior}


def prior_value(stats: DataFrame, prior: str) -> Column:
    """The prior as a scalar subquery: computed once, inlined as a literal."""
    if prior not in PRIORS:
        raise ValueError(f"unknown prior {prior!r}; known: {', '.join(PRIORS)}")
    return PRIORS[prior](stats).scalar()


def dashboard_mean(item_table: DataFrame) -> DataFrame:
    """Mean of the item table's means, 0 for an empty table, to two decimals."""
    mean = F.coalesce(F.avg("avg_rating"), F.lit(0.0))
    return item_table.agg(F.round(mean, 2).alias("average_rating"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One (metric, value) row per frame; a Parquet count reads no column."""
    counts = (
        df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
        for name, df in frames.items()
    )
    return reduce(DataFrame.unionByName, counts)


def job_summary(items: DataFrame, stats: DataFrame, recommendations: DataFrame) -> DataFrame:
    """The four totals that a run reports; the ratings were counted with the statistics."""
    rated = stats.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_ratings"),
        F.count(F.lit(1)).alias("movies_with_stats"),
    ).unpivot([], ["total_ratings", "movies_with_stats"], "metric", "value")
    counted = row_counts({"total_movies": items, "recommendations_generated": recommendations})
    return rated.unionByName(counted)
