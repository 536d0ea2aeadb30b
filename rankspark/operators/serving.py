"""Read queries over the stored result tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rankspark.functions import (
    contains_ci,
    fixed,
    genres_label,
    item_label,
    recommendation_label,
    year_label,
)
from rankspark.operators.paging import deep_page, in_rank_order, page
from rankspark.operators.stats import dashboard_mean

# Default page, order of recommendations, size of the top list,
# field names of the JSON answers.
DEFAULT_LIMIT = 20
DEFAULT_OFFSET = 0
TOP_SIZE = 10
BY_SCORE = (("recommendation_score", True), ("movie_id", False))
_KEEP_NULLS = {"ignoreNullFields": "false"}
JSON_TITLE, JSON_GENRES, JSON_YEAR = "movie__title", "movie__genres", "movie__year"


@dataclass(frozen=True)
class PageRequest:
    limit: int = DEFAULT_LIMIT
    offset: int = DEFAULT_OFFSET
    genre: str = ""

    @classmethod
    def parse(cls, parameters: Mapping[str, str]) -> PageRequest:
        """From text parameters (X13); a value that is no whole number is an error."""
        return cls(
            limit=int(parameters.get("limit", DEFAULT_LIMIT)),
            offset=int(parameters.get("offset", DEFAULT_OFFSET)),
            genre=parameters.get("genre", ""),
        )


def genre_filter(items: DataFrame, genre: str) -> DataFrame:
    """Items whose genre text contains the term; an empty term filters nothing."""
    return items.filter(contains_ci(F.col("genres"), genre)) if genre else items


def shown(recommendations: DataFrame, items: DataFrame, genre: str = "") -> DataFrame:
    """Recommendations whose item is stored and belongs to a genre, if one is given.

    Lists, pages and their totals start from these, so that nothing is lost to a later
    join with the items.
    """
    known = genre_filter(items, genre).select("movie_id")
    return recommendations.join(known, "movie_id", "left_semi")


def top_titles(recommendations: DataFrame, items: DataFrame, n: int = TOP_SIZE) -> DataFrame:
    """Best n recommendations with all item columns; only n rows meet those columns."""
    best = page(shown(recommendations, items).select("movie_id", "recommendation_score"), BY_SCORE, n)
    return in_rank_order(best.join(items, "movie_id")).drop("rank")


def recommendation_page(
    recommendations: DataFrame,
    items: DataFrame,
    request: PageRequest = PageRequest(),
    deep: bool = False,
) -> DataFrame:
    """One page in the order of ``rank``: rank, title, genres, year, recommendation_score.

    ``deep`` ranks all rows in parallel, for pages far from the top.  Nothing is cut after
    the page is: an item stored twice gives its rank twice.
    """
    wanted = shown(recommendations, items, request.genre)
    cut = deep_page if deep else page
    rows = cut(wanted.select("movie_id", "recommendation_score"), BY_SCORE, request.limit, request.offset)
    described = rows.join(items.select("movie_id", "title", "genres", "year"), "movie_id")
    listed = described.select("rank", "title", "genres", "year", "recommendation_score")
    return listed.orderBy("rank") if deep else in_rank_order(listed)


def page_entries(
    recommendations: DataFrame, items: DataFrame, request: PageRequest = PageRequest()
) -> DataFrame:
    """One page as (rank, entry) with one JSON text per row, for pages of any size."""
    rows = recommendation_page(recommendations, items, request)
    entry = F.to_json(_json_entry(with_year=True), _KEEP_NULLS)
    return rows.select("rank", entry.alias("entry"))


def page_envelope(
    recommendations: DataFrame, items: DataFrame, request: PageRequest = PageRequest()
) -> DataFrame:
    """The page as one JSON document, column ``envelope``; one task builds it.

    ``page_entries`` writes the same entries row by row, for pages of any size.
    """
    wanted = shown(recommendations, items, request.genre)
    rows = recommendation_page(recommendations, items, request)
    entry = _json_entry(with_year=True)
    data = F.struct(
        wanted.agg(F.count(F.lit(1)).alias("total")).scalar().alias("total"),
        F.lit(request.limit).alias("limit"),
        F.lit(request.offset).alias("offset"),
        _in_rank_order(entry).alias("recommendations"),
    )
    return rows.agg(_envelope(data).alias("envelope"))


def dashboard_totals(items: DataFrame, recommendations: DataFrame) -> DataFrame:
    """One row: total_movies, total_recommendations, average_rating."""
    stored = recommendations.agg(F.count(F.lit(1)).alias("n")).scalar()
    mean = F.round(F.coalesce(F.avg("avg_rating"), F.lit(0.0)), 2)
    return items.agg(
        F.count(F.lit(1)).alias("total_movies"), mean.alias("average_rating")
    ).select("total_movies", stored.alias("total_recommendations"), "average_rating")


def dashboard_top(
    recommendations: DataFrame, items: DataFrame, n: int = TOP_SIZE
) -> DataFrame:
    return top_titles(recommendations, items.select("movie_id", "title", "genres"), n).select(
        "title", "genres", "recommendation_score"
    )


def dashboard_envelope(
    items: DataFrame, recommendations: DataFrame, n: int = TOP_SIZE
) -> DataFrame:
    """Totals and top list as one JSON document, column ``envelope``."""
    scores = shown(recommendations, items).select("movie_id", "recommendation_score")
    best = page(scores, BY_SCORE, n)
    rows = best.join(items.select("movie_id", "title", "genres"), "movie_id")
    data = F.struct(
        items.agg(F.count(F.lit(1))).scalar().alias("total_movies"),
        recommendations.agg(F.count(F.lit(1))).scalar().alias("total_recommendations"),
        dashboard_mean(items).scalar().alias("average_rating"),
        _in_rank_order(_json_entry(with_year=False)).alias("top_recommendations"),
    )
    return rows.agg(_envelope(data).alias("envelope"))


def report_top(recommendations: DataFrame, items: DataFrame, n: int = TOP_SIZE) -> DataFrame:
    """The reporting query as SQL; only the best n rows meet the item columns."""
    return items.sparkSession.sql(
        """
        SELECT i.title, r.recommendation_score, i.avg_rating, i.rating_count
        FROM (
          SELECT movie_id, recommendation_score FROM {recommendations}
          WHERE movie_id IN (SELECT movie_id FROM {items})
          ORDER BY recommendation_score DESC, movie_id LIMIT :n
        ) r JOIN {items} i ON i.movie_id = r.movie_id
        ORDER BY r.recommendation_score DESC, r.movie_id
        """,
        args={"n": n},
        recommendations=recommendations,
        items=items,
    )


def cards(recommendations: DataFrame, items: DataFrame) -> DataFrame:
    """Every recommendation as display text."""
    joined = recommendations.select("movie_id", "recommendation_score").join(
        items.select("movie_id", "title", "genres", "year", "avg_rating"), "movie_id"
    )
    score = F.col("recommendation_score")
    return joined.select(
        "movie_id",
        F.round(score, 3).alias("score"),
        fixed(F.col("avg_rating"), 2).alias("mean_text"),
        genres_label(F.col("genres")).alias("genres_text"),
        genres_label(F.col("genres"), missing="N/A").alias("genres_short"),
        year_label(F.col("year")).alias("year_text"),
        item_label(F.col("title"), F.col("avg_rating")).alias("item_text"),
        recommendation_label(F.col("title"), score).alias("recommendation_text"),
    )


def _json_entry(with_year: bool) -> Column:
    fields = [F.col("title").alias(JSON_TITLE), F.col("genres").alias(JSON_GENRES)]
    if with_year:
        fields.append(F.col("year").alias(JSON_YEAR))
    return F.struct(*fields, "recommendation_score")


def _in_rank_order(entry: Column) -> Column:
    ranked = F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry"))))
    return F.transform(ranked, lambda r: r["entry"])


def _envelope(data: Column) -> Column:
    whole = F.struct(F.lit(True).alias("success"), data.alias("data"))
    return F.to_json(whole, _KEEP_NULLS)
