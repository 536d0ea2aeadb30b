"""Scores, support threshold and key existence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankspark.functions import smoothed_score
from rankspark.operators.stats import prior_value


def score_items(
    rated: DataFrame,
    stats: DataFrame,
    prior: str = "ratings",
    m: float = 10,
    min_ratings: int | None = None,
) -> DataFrame:
    """Add ``recommendation_score`` to rows with avg_rating and rating_count.

    ``rated`` is either the statistics themselves or the item table built from
    them; ``stats`` always supplies the prior, which is taken before the
    ``min_ratings`` threshold and includes ratings of unknown items.
    """
    if min_ratings is not None:
        rated = rated.filter(F.col("rating_count") >= min_ratings)
    score = smoothed_score(
        F.col("rating_count"), F.col("avg_rating"), m, prior_value(stats, prior)
    )
    return rated.withColumn("recommendation_score", score)


def existing_only(scores: DataFrame, items: DataFrame) -> DataFrame:
    """Scores whose item is stored.  Ids map to themselves, so a semi join is enough."""
    return scores.join(items.select("movie_id"), "movie_id", "left_semi")
