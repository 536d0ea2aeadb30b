"""The two result tables (J1, P1 - P6, X5) and cascading deletes (Q6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankspark.functions import title_year


def item_table(items: DataFrame, stats: DataFrame) -> DataFrame:
    """Every item with year and statistics; unrated items get 0.0 and 0."""
    return (
        items.select("movie_id", "title", "genres", title_year(F.col("title")).alias("year"))
        .join(stats.select("movie_id", "avg_rating", "rating_count"), "movie_id", "left")
        .na.fill({"avg_rating": 0.0, "rating_count": 0})
    )


def refreshed_items(
    stored: DataFrame, items: DataFrame, stats: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """The stored item table and new items, with statistics that have grown since.

    A stored item keeps its ``created_at``; its ``updated_at`` moves where its mean or its number
    of ratings does.  Items in both must have been refused before.
    """
    stamp = F.current_timestamp() if run_ts is None else run_ts
    before = ["avg_rating", "rating_count", "created_at", "updated_at"]
    known = stored.select("movie_id", "title", "genres", F.struct(*before).alias("before"))
    rows = known.unionByName(items.select("movie_id", "title", "genres"), allowMissingColumns=True)
    rows = rows.join(stats.select("movie_id", "avg_rating", "rating_count"), "movie_id", "left")
    rows = rows.na.fill({"avg_rating": 0.0, "rating_count": 0})
    old = F.col("before")
    same = old["avg_rating"].eqNullSafe(F.col("avg_rating")) & old["rating_count"].eqNullSafe(F.col("rating_count"))
    return rows.select(
        "movie_id",
        "title",
        "genres",
        title_year(F.col("title")).alias("year"),
        "avg_rating",
        "rating_count",
        F.coalesce(old["created_at"], stamp).alias("created_at"),
        F.when(old.isNotNull() & same, old["updated_at"]).otherwise(stamp).alias("updated_at"),
    )


def with_audit(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Add created_at and updated_at, one instant for the whole run."""
    stamp = F.current_timestamp() if run_ts is None else run_ts
    return df.withColumns({"created_at": stamp, "updated_at": stamp})


def recommendation_table(
    scores: DataFrame, run_ts: Column | None = None, popularity: str = "mean"
) -> DataFrame:
    """Rows for the recommendation table.

    ``popularity`` is "mean" (the item's mean rating) or "zero".  The genre match
    is a placeholder and the user is NULL: the rows are the same for everyone.
    """
    if popularity not in ("mean", "zero"):
        raise ValueError("popularity must be 'mean' or 'zero'")
    popular = F.col("avg_rating") if popularity == "mean" else F.lit(0.0)
    rows = scores.select(
        "movie_id",
        "recommendation_score",
        popular.alias("popularity_score"),
        F.lit(0.0).alias("genre_match_score"),
        F.lit(None).cast("bigint").alias("user_id"),
    )
    return with_audit(rows, run_ts)


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str = "movie_id") -> DataFrame:
    """Children that remain after their parents in ``deleted`` are gone.

    Both sides are plain shuffles, so adaptive execution can split a hot key;
    repeated keys in ``deleted`` do no harm and need no distinct.
    """
    return children.join(deleted.select(key), key, "left_anti")
