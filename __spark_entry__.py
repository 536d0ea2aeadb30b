"""

Every query runs over whole tables.  Items are the rows of ``part`` and
``supplier``, ratings the rows of ``lineitem`` (``rankspark.plans.adapters``).
Queries over the result tables read them as published by one batch run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankspark import functions as X, schemas, sinks, sources
from rankspark.operators import browse, facets, paging, quality, serving, stats, tables
from rankspark.operators.scores import existing_only, score_items
from rankspark.plans import adapters, batch
from rankspark.runtime import new_folder
from rankspark.sinks import layouts

try:  # the training-data operators can be left out as a whole
    import corpus_pipeline
    from rankspark.llm import queries as training_data
except ImportError:  # they, or a library that only they use, are not there
    corpus_pipeline = training_data = None

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared by the queries and the oracle SQL.
M = 10
MIN_RATINGS = 30
TOP_N = 100
SUBSET = 100
RUN_TS = "2024-01-30 00:00:00"
AS_OF = dt.date(2024, 1, 30)
UPLOADED = dt.date(1998, 6, 15)
GENRE = "eCoN"
PAGE = serving.PageRequest(limit=20, offset=40, genre=GENRE)
DEEP_LIMIT, DEEP_OFFSET = 50, 120
DELETED_GENRE = "promo"
ITEM_SEARCH = 'ring "brand#1"'
TITLE_SEARCH = "blue (196"
RATING_SEARCH = "12 red"

# --------------------------------------------------------------------------- inputs


def _items(spark: SparkSession, d: str) -> DataFrame:
    return adapters.items(spark, d)


def _ratings(spark: SparkSession, d: str) -> DataFrame:
    return adapters.ratings(spark, d)


def _stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.item_stats(_ratings(spark, d))


def _item_table(spark: SparkSession, d: str) -> DataFrame:
    return tables.item_table(_items(spark, d), _stats(spark, d))


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as wall-clock times of the session zone, as the oracle writes them."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({n: F.col(n).cast(adapters.NTZ) for n in names})


_published: dict[tuple[str, str], str] = {}


ALL_ITEMS = batch.JobConfig.all_items()
TOP_RATED = batch.JobConfig.top_rated(MIN_RATINGS, TOP_N)


def publish(
    spark: SparkSession, d: str, config: batch.JobConfig = ALL_ITEMS, base: str | None = None
) -> str:
    """Run the batch job, by default into a fresh folder of the shared directory."""
    base = base or new_folder(spark, "published")
    batch.run(_items(spark, d), _ratings(spark, d), config, batch.to_folder(base), _run_ts())
    return base


def _stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The published (recommendations, items), built once per application and data set."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _published:
        _published[key] = publish(spark, d)
    return tuple(sources.read_published(spark, _published[key], schemas.RECOMMENDATIONS, schemas.ITEMS))


# --------------------------------------------------------------------------- statistics


def item_stats(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).select("movie_id", "avg_rating", "rating_count")


def prior_ratings(spark: SparkSession, d: str) -> DataFrame:
    return stats.ratings_mean(_ratings(spark, d))


def prior_items(spark: SparkSession, d: str) -> DataFrame:
    return stats.items_prior(_stats(spark, d))


def dashboard_mean(spark: SparkSession, d: str) -> DataFrame:
    return stats.dashboard_mean(_stored(spark, d)[1])


def table_counts(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    return stats.row_counts(
        {
            "movies": items,
            "ratings": _ratings(spark, d),
            "recommendation_data": recommendations,
            "raw_dataset": adapters.datasets(spark, d),
            "user_preference": adapters.preferences(spark, d),
        }
    )


def job_summary(spark: SparkSession, d: str) -> DataFrame:
    items, rated = _items(spark, d), batch.written_stats(_stats(spark, d))
    scores = batch.recommend(items, rated, TOP_RATED)
    summary = stats.job_summary(items, rated, scores)
    return summary.withColumn("value_text", X.thousands(F.col("value")))


# --------------------------------------------------------------------------- scores


def bayes_ratings_prior(spark: SparkSession, d: str) -> DataFrame:
    rated = _stats(spark, d)
    return score_items(rated, rated, "ratings", M).select("movie_id", "recommendation_score")


def bayes_items_prior(spark: SparkSession, d: str) -> DataFrame:
    rated = _stats(spark, d)
    table = tables.item_table(_items(spark, d), rated)
    scored = score_items(table, rated, "items", MIN_RATINGS, MIN_RATINGS)
    score = F.round("recommendation_score", 6).alias("weighted_rating")
    return scored.select("movie_id", score)


def existing_item_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of items in stock, where one product type is no longer stored."""
    return existing_only(bayes_ratings_prior(spark, d), _kept_items(spark, d))


def top10_titles(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    scores = batch.recommend(items, _stats(spark, d), ALL_ITEMS)
    best = serving.top_titles(scores, items.select("movie_id", "title"))
    return best.select("movie_id", "title", "recommendation_score")


def top_n(spark: SparkSession, d: str) -> DataFrame:
    best = batch.recommend(_items(spark, d), _stats(spark, d), TOP_RATED)
    score = F.round("recommendation_score", 6).alias("weighted_rating")
    return best.select("movie_id", score)


def title_year(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select("movie_id", X.title_year(F.col("title")).alias("year"))


# --------------------------------------------------------------------------- tables


def item_table(spark: SparkSession, d: str) -> DataFrame:
    return _item_table(spark, d)


def item_table_narrow(spark: SparkSession, d: str) -> DataFrame:
    """The item table in the 32-bit types of an existing store, with audit columns."""
    table = tables.with_audit(_item_table(spark, d), _run_ts())
    return _plain_times(schemas.conform(table, schemas.ITEMS, narrow=True))


def recommendation_table(spark: SparkSession, d: str) -> DataFrame:
    scores = batch.recommend(_items(spark, d), _stats(spark, d), batch.JobConfig())
    return _plain_times(tables.recommendation_table(scores, _run_ts()))


def stored_items(spark: SparkSession, d: str) -> DataFrame:
    return _plain_times(_stored(spark, d)[1])


def stored_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return _plain_times(_stored(spark, d)[0])


def overwritten_recommendations(spark: SparkSession, d: str) -> DataFrame:
    """A top-rated run over the folder of an earlier run leaves only its own rows."""
    base = publish(spark, d, TOP_RATED, publish(spark, d))
    stored = sources.read_stored(spark, base, schemas.RECOMMENDATIONS)
    score = F.round("recommendation_score", 6).alias("recommendation_score")
    return stored.select("movie_id", score, "popularity_score")


def appended_items(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over one folder: the second adds the suppliers, and the ratings of all items.

    Its recommendations are those of items that either run has stored.
    """
    base, ratings = new_folder(spark, "appended"), _ratings(spark, d)
    parts = adapters.part_items(spark, d)
    suppliers = _items(spark, d).join(parts, "movie_id", "left_anti")
    none = ratings.limit(0)
    batch.run(parts, none, ALL_ITEMS, batch.to_folder(base, "append"), _run_ts())
    batch.run(suppliers, ratings, ALL_ITEMS, batch.to_folder(base, "append"), _run_ts())
    scores, items = sources.read_published(spark, base, schemas.RECOMMENDATIONS, schemas.ITEMS)
    score = F.round("recommendation_score", 6).alias("recommendation_score")
    return items.select("movie_id", "title").join(scores.select("movie_id", score), "movie_id", "left")


def merged_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Ratings that come in three parts, items in two; every run is sent twice.

    Parts are rated up to 1994 first, then suppliers and the ratings of 1995 come, then all later
    ratings.  The tables are those of one run over everything.
    """
    base, ratings = new_folder(spark, "merged"), _ratings(spark, d)
    parts = adapters.part_items(spark, d)
    suppliers = _items(spark, d).join(parts, "movie_id", "left_anti")
    year = F.year("created_at")
    runs = ((parts, year < 1995), (suppliers, year == 1995), (parts.limit(0), year > 1995))
    for number, (items, dates) in enumerate(runs):
        for _ in range(2):
            sink = batch.to_folder(base, "append")
            batch.run(items, ratings.where(dates), ALL_ITEMS, sink, _run_ts(), f"part {number}")
    scores, items = sources.read_published(spark, base, schemas.RECOMMENDATIONS, schemas.ITEMS)
    score = F.round("recommendation_score", 6).alias("recommendation_score")
    rated = items.select("movie_id", "title", "year", "avg_rating", "rating_count")
    return rated.join(scores.select("movie_id", score), "movie_id", "left")


def insert_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Rows without some columns, and with NULL means, as the item table stores them."""
    means = _stats(spark, d).select("movie_id", "avg_rating")
    rows = _items(spark, d).select("movie_id", "title").join(means, "movie_id", "left")
    stored = schemas.conform(rows, schemas.ITEMS)
    return stored.select("movie_id", "title", "genres", "avg_rating", "rating_count")


def item_subset(spark: SparkSession, d: str) -> DataFrame:
    return sources.item_subset(_items(spark, d), SUBSET).select("movie_id", "title")


def ratings_of_subset(spark: SparkSession, d: str) -> DataFrame:
    subset = sources.item_subset(_items(spark, d), SUBSET)
    return sources.ratings_of(_ratings(spark, d), subset).select("user_id", "movie_id", "rating")


def subset_run(spark: SparkSession, d: str) -> DataFrame:
    """A development run: the prior, too, comes from the subset's ratings only."""
    config = batch.JobConfig.all_items(item_limit=SUBSET)
    _, scores = batch.build(_items(spark, d), _ratings(spark, d), config)
    return scores.select("movie_id", "recommendation_score", "popularity_score")


# --------------------------------------------------------------------------- serving


def genre_filter(spark: SparkSession, d: str) -> DataFrame:
    return serving.genre_filter(_items(spark, d), GENRE).select("movie_id", "genres")


def recommendation_page(spark: SparkSession, d: str) -> DataFrame:
    return serving.recommendation_page(*_stored(spark, d), PAGE)


def recommendation_deep_page(spark: SparkSession, d: str) -> DataFrame:
    """A page far down the list, cut from the distributed ranking."""
    request = serving.PageRequest(limit=DEEP_LIMIT, offset=DEEP_OFFSET)
    return serving.recommendation_page(*_stored(spark, d), request, deep=True)


def complete_page(spark: SparkSession, d: str) -> DataFrame:
    """A page while items of one kind are gone: full, with the total of what can be shown."""
    recommendations, items = _stored(spark, d)
    left = items.join(_kept_items(spark, d).select("movie_id"), "movie_id", "left_semi")
    total = serving.shown(recommendations, left).agg(F.count(F.lit(1)).alias("total")).scalar()
    page = serving.recommendation_page(recommendations, left, serving.PageRequest(limit=20))
    return page.withColumn("total", total)


def page_info(spark: SparkSession, d: str) -> DataFrame:
    wanted = serving.shown(*_stored(spark, d), GENRE)
    return paging.page_info(wanted, PAGE.limit, PAGE.offset)


def page_envelope(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    return serving.page_envelope(_rounded(recommendations), items, PAGE)


def page_entries(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    request = serving.PageRequest(limit=DEEP_LIMIT, offset=DEEP_OFFSET)
    return serving.page_entries(_rounded(recommendations), items, request)


def dashboard_envelope(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    return serving.dashboard_envelope(items, _rounded(recommendations))


def _rounded(recommendations: DataFrame) -> DataFrame:
    """Scores with six decimals, which both engines print alike."""
    score = F.round("recommendation_score", 6)
    return recommendations.withColumn("recommendation_score", score)


def dashboard_top10(spark: SparkSession, d: str) -> DataFrame:
    return serving.dashboard_top(*_stored(spark, d))


def dashboard_stats(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    return serving.dashboard_totals(items, recommendations)


def report_top10_sql(spark: SparkSession, d: str) -> DataFrame:
    return serving.report_top(*_stored(spark, d))


def display_cards(spark: SparkSession, d: str) -> DataFrame:
    return serving.cards(*_stored(spark, d))


def rating_labels(spark: SparkSession, d: str) -> DataFrame:
    rated = _ratings(spark, d).join(_items(spark, d).select("movie_id", "title"), "movie_id")
    label = X.rating_label(F.col("user_id"), F.col("title"), F.col("rating"))
    return rated.select(label.alias("label"))


def dataset_labels(spark: SparkSession, d: str) -> DataFrame:
    label = X.dataset_label(F.col("data_file"), F.col("processed"))
    return adapters.datasets(spark, d).select("id", label.alias("label"))


def preference_labels(spark: SparkSession, d: str) -> DataFrame:
    label = X.preference_label(F.col("user"))
    return adapters.preferences(spark, d).select(label.alias("label"))


# --------------------------------------------------------------------------- listings


def item_search(spark: SparkSession, d: str) -> DataFrame:
    found = browse.search(_items(spark, d), schemas.ITEMS, ITEM_SEARCH)
    return found.select("movie_id", "title")


def recommendation_search(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    found = browse.search(recommendations, schemas.RECOMMENDATIONS, TITLE_SEARCH, items)
    found = browse.with_title(found, items)
    return found.select("movie_id", "title", "recommendation_score")


def browse_items(spark: SparkSession, d: str) -> DataFrame:
    _, items = _stored(spark, d)
    rows = browse.browse(items, schemas.ITEMS, query="ring", facets={"year": 1968})
    return _plain_times(rows)


def browse_ratings(spark: SparkSession, d: str) -> DataFrame:
    return browse.browse(
        _ratings(spark, d),
        schemas.RATINGS,
        _items(spark, d),
        query=RATING_SEARCH,
        facets={"rating": 4.5},
        limit=100,
        offset=50,
    )


def browse_recommendations(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    return _plain_times(browse.browse(recommendations, schemas.RECOMMENDATIONS, items, offset=50))


def browse_datasets(spark: SparkSession, d: str) -> DataFrame:
    return _browsed_datasets(adapters.datasets(spark, d))


def _browsed_datasets(datasets: DataFrame) -> DataFrame:
    return browse.browse(
        datasets,
        schemas.DATASETS,
        query="7.csv",
        facets={"processed": False},
        dates={"upload_date": ("this_year", UPLOADED)},
    )


def browse_preferences(spark: SparkSession, d: str) -> DataFrame:
    return browse.browse(adapters.preferences(spark, d), schemas.PREFERENCES, query="customer#0000001")


def facet_values(spark: SparkSession, d: str) -> DataFrame:
    return facets.facet_values(_ratings(spark, d), "rating")


def facet_values_year(spark: SparkSession, d: str) -> DataFrame:
    return facets.facet_values(_stored(spark, d)[1], "year")


def facet_filter_year(spark: SparkSession, d: str) -> DataFrame:
    items = _stored(spark, d)[1]
    chosen = facets.facet_filter(items, "year", 1968)
    unknown = facets.facet_filter(items, "year", None)
    return chosen.unionByName(unknown).select("movie_id", "year")


def facet_filter_rating(spark: SparkSession, d: str) -> DataFrame:
    rows = facets.facet_filter(_ratings(spark, d), "rating", 5.0)
    return rows.select("user_id", "movie_id", "rating")


def facet_filter_processed(spark: SparkSession, d: str) -> DataFrame:
    return facets.facet_filter(adapters.datasets(spark, d), "processed", True)


def facet_filter_dates(spark: SparkSession, d: str) -> DataFrame:
    return facets.facet_date_counts(adapters.datasets(spark, d), "upload_date", UPLOADED)


def facet_rows_past_7_days(spark: SparkSession, d: str) -> DataFrame:
    events = adapters.load(spark, d, "events").select("event_id", "ts")
    return facets.facet_filter_date(events, "ts", "past_7_days", AS_OF)


_by_day: dict[tuple[str, str, str], str] = {}


def _lying_by_day(spark: SparkSession, d: str, name: str, df: DataFrame, column: str) -> DataFrame:
    """A copy with a partition for each day, written once per application and data set."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _by_day:
        _by_day[key] = new_folder(spark, f"{name}-by-day")
        layouts.write_by_day(df, _by_day[key], column)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return layouts.read_by_day(spark, _by_day[key], ddl, column)


def facet_rows_by_day(spark: SparkSession, d: str) -> DataFrame:
    events = adapters.load(spark, d, "events").select("event_id", "ts")
    events = _lying_by_day(spark, d, "events", events, "ts")
    return facets.facet_filter_date(events, "ts", "past_7_days", AS_OF)


def browse_datasets_by_day(spark: SparkSession, d: str) -> DataFrame:
    datasets = _lying_by_day(spark, d, "datasets", adapters.datasets(spark, d), "upload_date")
    return _browsed_datasets(datasets)


# --------------------------------------------------------------------------- rules


def _kept_items(spark: SparkSession, d: str) -> DataFrame:
    deleted = F.coalesce(X.contains_ci(F.col("genres"), DELETED_GENRE), F.lit(False))
    return _items(spark, d).filter(~deleted)


def _deleted_items(spark: SparkSession, d: str) -> DataFrame:
    return serving.genre_filter(_items(spark, d), DELETED_GENRE)


def dup_items(spark: SparkSession, d: str) -> DataFrame:
    """Parts and suppliers merged under their own, overlapping keys."""
    merged = adapters.part_items(spark, d).unionByName(adapters.supplier_items(spark, d))
    return quality.duplicates(merged, ["movie_id"])


def dup_ratings(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicates(_ratings(spark, d), list(schemas.RATINGS.unique))


def orphan_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Ratings left behind when the items of one product type go without a cascade."""
    return quality.orphans(_ratings(spark, d), _kept_items(spark, d))


def cascade_delete(spark: SparkSession, d: str) -> DataFrame:
    left = tables.cascade_delete(_ratings(spark, d), _deleted_items(spark, d))
    return left.select("user_id", "movie_id", "rating")


_by_item: dict[tuple[str, str, str], layouts.ByItem] = {}


def _lying_by_item(spark: SparkSession, d: str, name: str, df: DataFrame) -> layouts.ByItem:
    """A copy bucketed by item, written once per application and data set."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _by_item:
        _by_item[key] = layouts.write_by_item(df, new_folder(spark, f"{name}-by-item"))
    return _by_item[key]


def bucketed_orphans(spark: SparkSession, d: str) -> DataFrame:
    ratings = _lying_by_item(spark, d, "ratings", _ratings(spark, d))
    return ratings.each(lambda part: quality.orphans(part, _kept_items(spark, d)))


def bucketed_cascade(spark: SparkSession, d: str) -> DataFrame:
    ratings = _lying_by_item(spark, d, "ratings", _ratings(spark, d))
    left = ratings.each(lambda part: tables.cascade_delete(part, _deleted_items(spark, d)))
    return left.select("user_id", "movie_id", "rating")


def bucketed_item_table(spark: SparkSession, d: str) -> DataFrame:
    """Items and ratings both by item: the statistics of a bucket meet its items where they lie."""
    ratings = _lying_by_item(spark, d, "ratings", _ratings(spark, d))
    items = _lying_by_item(spark, d, "items", _items(spark, d))
    return tables.item_table(items.bucketed, ratings.each(stats.item_stats))


def orphan_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return quality.orphans(_stored(spark, d)[0], _kept_items(spark, d))


def cascade_delete_recommendations(spark: SparkSession, d: str) -> DataFrame:
    recommendations, items = _stored(spark, d)
    left = tables.cascade_delete(recommendations, serving.genre_filter(items, DELETED_GENRE))
    return left.select("movie_id", "recommendation_score")


def null_violations(spark: SparkSession, d: str) -> DataFrame:
    """The item table before its NULLs are filled."""
    unfilled = _items(spark, d).join(_stats(spark, d), "movie_id", "left")
    return quality.null_violations(unfilled, schemas.ITEMS)


def null_violations_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Every order with its ratings, and those without any."""
    users = adapters.load(spark, d, "orders").select(F.col("o_orderkey").alias("user_id"))
    return quality.null_violations(users.join(_ratings(spark, d), "user_id", "left"), schemas.RATINGS)


def _document_items(spark: SparkSession, d: str) -> DataFrame:
    return adapters.load(spark, d, "documents").select(
        F.col("doc_id").alias("movie_id"),
        F.col("text").alias("title"),
        F.concat_ws("|", "lang", "source").alias("genres"),
    )


def length_violations(spark: SparkSession, d: str) -> DataFrame:
    """Document texts held against the title limit, and the other limited columns."""
    titles = quality.length_violations(_document_items(spark, d), schemas.ITEMS)
    files = quality.length_violations(adapters.datasets(spark, d), schemas.DATASETS)
    tastes = quality.length_violations(adapters.preferences(spark, d), schemas.PREFERENCES)
    return titles.unionByName(files).unionByName(tastes)


def length_violation_rows(spark: SparkSession, d: str) -> DataFrame:
    documents = _document_items(spark, d)
    rules = quality.length_rules(documents, schemas.ITEMS)
    rows = quality.violating_rows(documents, rules)
    return rows.select("movie_id", F.array_join("broken_rules", ",").alias("broken_rules"))


# --------------------------------------------------------------------------- files


_csv: dict[tuple[str, str], str] = {}


def csv_copy(spark: SparkSession, d: str) -> str:
    """Items and ratings as CSV, written once per application and data set."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _csv:
        folder = new_folder(spark, "csv")
        sinks.write_ratings_csv(_ratings(spark, d), folder)
        sinks.write_items_csv(_items(spark, d), folder)
        _csv[key] = folder
    return _csv[key]


def csv_rejected(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a ratings file that do not fit: customers with a segment, suppliers with a name."""
    folder = new_folder(spark, "csv-planted")
    sinks.write_ratings_csv(_ratings(spark, d), folder)
    customers = adapters.load(spark, d, "customer").selectExpr(
        "c_custkey AS userId", "c_mktsegment AS movieId", "'4.5' AS rating", "0 AS timestamp"
    )
    suppliers = adapters.load(spark, d, "supplier").selectExpr(
        "s_suppkey AS userId", "'7' AS movieId", "s_name AS rating", "0 AS timestamp"
    )
    planted = customers.unionByName(suppliers)
    planted.write.mode("append").options(header=True, escape='"').csv(f"{folder}/ratings.csv")
    lines = sources.rejected(sources.read_ratings(spark, folder, checked=True))
    return lines.select("line", "user_id", "movie_id", "rating")


def csv_scan_typed(spark: SparkSession, d: str) -> DataFrame:
    return sources.read_ratings(spark, csv_copy(spark, d))


def csv_scan_inferred(spark: SparkSession, d: str) -> DataFrame:
    ratings = sources.read_ratings(spark, csv_copy(spark, d), infer=True)
    # Inference picks the narrowest type that holds every id of this file.
    ids = ("user_id", "movie_id", "timestamp")
    return ratings.withColumns({c: F.col(c).cast("bigint") for c in ids})


def csv_scan_items(spark: SparkSession, d: str) -> DataFrame:
    return sources.read_items(spark, csv_copy(spark, d))


# --------------------------------------------------------------------------- contract

_QUERIES: tuple[Query, ...] = (
    item_stats,
    prior_ratings,
    prior_items,
    dashboard_mean,
    table_counts,
    job_summary,
    bayes_ratings_prior,
    bayes_items_prior,
    existing_item_scores,
    top10_titles,
    top_n,
    title_year,
    item_table,
    item_table_narrow,
    recommendation_table,
    stored_items,
    stored_recommendations,
    overwritten_recommendations,
    appended_items,
    merged_statistics,
    insert_defaults,
    item_subset,
    ratings_of_subset,
    subset_run,
    genre_filter,
    recommendation_page,
    recommendation_deep_page,
    complete_page,
    page_info,
    page_entries,
    page_envelope,
    dashboard_envelope,
    dashboard_top10,
    dashboard_stats,
    report_top10_sql,
    display_cards,
    rating_labels,
    dataset_labels,
    preference_labels,
    item_search,
    recommendation_search,
    browse_items,
    browse_ratings,
    browse_recommendations,
    browse_datasets,
    browse_preferences,
    facet_values,
    facet_values_year,
    facet_filter_year,
    facet_filter_rating,
    facet_filter_processed,
    facet_filter_dates,
    facet_rows_past_7_days,
    facet_rows_by_day,
    browse_datasets_by_day,
    bucketed_orphans,
    bucketed_cascade,
    bucketed_item_table,
    dup_items,
    dup_ratings,
    orphan_ratings,
    orphan_recommendations,
    cascade_delete,
    cascade_delete_recommendations,
    null_violations,
    null_violations_ratings,
    length_violations,
    length_violation_rows,
    csv_scan_typed,
    csv_scan_inferred,
    csv_scan_items,
    csv_rejected,
)


def entry(spark: SparkSession) -> DataFrame:
    return top10_titles(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    own = {q.__name__: q for q in _QUERIES}
    if training_data is None:
        return own
    return own | training_data.QUERIES | {"pipeline": corpus_pipeline.run}


# Views that the oracle statements build on.
_VIEWS = {
    "part_items": """
        SELECT p_partkey AS movie_id,
               p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' AS title,
               p_type || '|' || p_brand AS genres
        FROM part""",
    "items": """
        SELECT * FROM part_items
        UNION ALL
        SELECT 1000000000 + s_suppkey, s_name, NULL FROM supplier""",
    "ratings": """
        SELECT l_orderkey AS user_id, l_partkey AS movie_id,
               ceil(l_quantity / 5) / 2 AS rating,
               CAST(epoch(l_shipdate) AS BIGINT) AS timestamp, l_shipdate AS created_at
        FROM lineitem""",
    "datasets": """
        SELECT o_orderkey AS id, 'orders-' || CAST(o_orderkey AS VARCHAR) || '.csv' AS data_file,
               o_orderdate AS upload_date, o_orderstatus = 'F' AS processed,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS processed_date,
               CAST(floor(o_totalprice) AS BIGINT) AS record_count
        FROM orders""",
    "preferences": """
        SELECT c_name AS "user", c_mktsegment AS favorite_categories,
               min(o_orderdate) AS created_at, max(o_orderdate) AS updated_at
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey, c_name, c_mktsegment""",
    "stats": """
        SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS rating_count
        FROM ratings GROUP BY movie_id""",
    "prior_of_ratings": """
        SELECT coalesce(nullif(avg(rating), 0), 3.0) AS c FROM ratings""",
    "prior_of_items": "SELECT avg(avg_rating) AS c FROM stats",
    "item_rows": r"""
        SELECT i.movie_id, title, genres,
               try_cast(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') AS INTEGER) AS year,
               coalesce(avg_rating, 0.0) AS avg_rating,
               coalesce(rating_count, 0) AS rating_count
        FROM items i LEFT JOIN stats s ON s.movie_id = i.movie_id""",
    "scores": f"""
        SELECT movie_id, avg_rating, rating_count,
               rating_count / (rating_count + {M}) * avg_rating
               + {M} / (rating_count + {M}) * c AS recommendation_score
        FROM stats, prior_of_ratings""",
    "recs": """
        SELECT * FROM scores WHERE movie_id IN (SELECT movie_id FROM items)""",
    "weighted": f"""
        SELECT movie_id,
               rating_count / (rating_count + {MIN_RATINGS}) * avg_rating
               + {MIN_RATINGS} / (rating_count + {MIN_RATINGS}) * c AS weighted_rating
        FROM item_rows, prior_of_items WHERE rating_count >= {MIN_RATINGS}""",
    "kept_items": f"""
        SELECT * FROM items
        WHERE genres IS NULL OR NOT contains(lower(genres), '{DELETED_GENRE}')""",
    "subset": f"SELECT * FROM items ORDER BY movie_id LIMIT {SUBSET}",
    "subset_ratings": """
        SELECT user_id, movie_id, rating FROM ratings
        WHERE movie_id IN (SELECT movie_id FROM subset)""",
    "genre_recs": f"""
        SELECT r.movie_id, title, genres, year, recommendation_score
        FROM recs r JOIN item_rows i ON i.movie_id = r.movie_id
        WHERE contains(lower(genres), lower('{GENRE}'))""",
    "opened": """
        SELECT o_orderkey AS user_id, movie_id, rating, timestamp, created_at
        FROM orders LEFT JOIN ratings ON user_id = o_orderkey""",
    "document_items": """
        SELECT doc_id AS movie_id, text AS title, lang || '|' || source AS genres
        FROM documents""",
}


def _sql(body: str) -> str:
    views = ",\n".join(f"{name} AS ({text})" for name, text in _VIEWS.items())
    return f"WITH {views}\n{body}"


def oracle_sql() -> dict[str, str]:
    stamp = f"TIMESTAMP '{RUN_TS}'"
    first, last = DEEP_OFFSET + 1, DEEP_OFFSET + DEEP_LIMIT
    statements = {
        "item_stats": "SELECT movie_id, avg_rating, rating_count FROM stats",
        "prior_ratings": "SELECT c AS prior FROM prior_of_ratings",
        # Whole numbers add up without rounding: parts of 30 bits, put together at the end.
        "prior_items": """
            SELECT (sum(w) + (sum(p1) + (sum(p2) + sum(floor(r3)) / 1073741824) / 1073741824)
                   / 1073741824) / count(*) AS prior
            FROM (SELECT w, p1, floor(r2) AS p2, (r2 - floor(r2)) * 1073741824 AS r3
                  FROM (SELECT w, floor(r1) AS p1, (r1 - floor(r1)) * 1073741824 AS r2
                        FROM (SELECT floor(avg_rating) AS w,
                                     (avg_rating - floor(avg_rating)) * 1073741824 AS r1
                              FROM stats WHERE avg_rating IS NOT NULL)))""",
        "dashboard_mean": """
            SELECT round(coalesce(avg(avg_rating), 0), 2) AS average_rating FROM item_rows""",
        "table_counts": """
            SELECT 'movies' AS metric, count(*) AS value FROM items
            UNION ALL SELECT 'ratings', count(*) FROM ratings
            UNION ALL SELECT 'recommendation_data', count(*) FROM recs
            UNION ALL SELECT 'raw_dataset', count(*) FROM orders
            UNION ALL SELECT 'user_preference', count(*) FROM preferences""",
        "job_summary": f"""
            SELECT metric, value, format('{{:,}}', value) AS value_text FROM (
              SELECT 'total_movies' AS metric, count(*) AS value FROM items
              UNION ALL SELECT 'total_ratings', count(*) FROM ratings
              UNION ALL SELECT 'movies_with_stats', count(*) FROM stats
              UNION ALL SELECT 'recommendations_generated', least(count(*), {TOP_N})
                        FROM weighted)""",
        "bayes_ratings_prior": "SELECT movie_id, recommendation_score FROM scores",
        "bayes_items_prior": """
            SELECT movie_id, round(weighted_rating, 6) AS weighted_rating FROM weighted""",
        "existing_item_scores": """
            SELECT movie_id, recommendation_score FROM scores
            WHERE movie_id IN (SELECT movie_id FROM kept_items)""",
        "top10_titles": """
            SELECT r.movie_id, title, recommendation_score
            FROM recs r JOIN items i ON i.movie_id = r.movie_id
            ORDER BY recommendation_score DESC, r.movie_id LIMIT 10""",
        "top_n": f"""
            SELECT movie_id, round(weighted_rating, 6) AS weighted_rating FROM (
              SELECT * FROM weighted ORDER BY weighted_rating DESC, movie_id LIMIT {TOP_N})""",
        "title_year": "SELECT movie_id, year FROM item_rows",
        "item_table": """
            SELECT movie_id, title, genres, year, avg_rating, rating_count FROM item_rows""",
        "item_table_narrow": f"""
            SELECT CAST(movie_id AS INTEGER) AS movie_id, title, genres, year, avg_rating,
                   CAST(rating_count AS INTEGER) AS rating_count,
                   {stamp} AS created_at, {stamp} AS updated_at
            FROM item_rows""",
        "recommendation_table": f"""
            SELECT movie_id, recommendation_score, avg_rating AS popularity_score,
                   CAST(0 AS DOUBLE) AS genre_match_score, CAST(NULL AS BIGINT) AS user_id,
                   {stamp} AS created_at, {stamp} AS updated_at
            FROM recs""",
        "stored_items": f"""
            SELECT movie_id, title, genres, year, avg_rating, rating_count,
                   {stamp} AS created_at, {stamp} AS updated_at
            FROM item_rows""",
        "stored_recommendations": f"""
            SELECT movie_id, recommendation_score, CAST(0 AS DOUBLE) AS popularity_score,
                   CAST(0 AS DOUBLE) AS genre_match_score, CAST(NULL AS BIGINT) AS user_id,
                   {stamp} AS created_at, {stamp} AS updated_at
            FROM recs""",
        "overwritten_recommendations": f"""
            SELECT movie_id, round(weighted_rating, 6) AS recommendation_score,
                   avg_rating AS popularity_score
            FROM (SELECT * FROM weighted JOIN stats USING (movie_id)
                  ORDER BY weighted_rating DESC, movie_id LIMIT {TOP_N})""",
        "item_subset": f"""
            SELECT movie_id, title FROM items ORDER BY movie_id LIMIT {SUBSET}""",
        "ratings_of_subset": "SELECT * FROM subset_ratings",
        "subset_run": f"""
            SELECT movie_id,
                   n / (n + {M}) * mean + {M} / (n + {M}) * c AS recommendation_score,
                   CAST(0 AS DOUBLE) AS popularity_score
            FROM (SELECT movie_id, count(rating) AS n, avg(rating) AS mean
                  FROM subset_ratings GROUP BY movie_id),
                 (SELECT coalesce(nullif(avg(rating), 0), 3.0) AS c FROM subset_ratings)""",
        "genre_filter": f"""
            SELECT movie_id, genres FROM items WHERE contains(lower(genres), lower('{GENRE}'))""",
        "recommendation_page": f"""
            SELECT row_number() OVER (ORDER BY recommendation_score DESC, movie_id) AS rank,
                   title, genres, year, recommendation_score
            FROM genre_recs
            ORDER BY rank LIMIT {PAGE.limit} OFFSET {PAGE.offset}""",
        "recommendation_deep_page": f"""
            SELECT rank, title, genres, year, recommendation_score FROM (
              SELECT row_number() OVER (ORDER BY recommendation_score DESC, movie_id) AS rank,
                     movie_id, recommendation_score FROM recs) r
            JOIN item_rows i ON i.movie_id = r.movie_id
            WHERE rank BETWEEN {first} AND {last}""",
        "page_info": f"""
            SELECT total, page, pages AS total_pages, page > 1 AS has_prev,
                   page < pages AS has_next
            FROM (SELECT count(*) AS total,
                         CAST({PAGE.offset // PAGE.limit + 1} AS BIGINT) AS page,
                         CAST(ceil(count(*) / {PAGE.limit}) AS BIGINT) AS pages
                  FROM genre_recs)""",
        "page_entries": f"""
            SELECT rank, CAST(json_object('movie__title', title, 'movie__genres', genres,
                'movie__year', year, 'recommendation_score', score) AS VARCHAR) AS entry
            FROM (SELECT row_number() OVER (ORDER BY score DESC, movie_id) AS rank, *
                  FROM (SELECT movie_id, round(recommendation_score, 6) AS score FROM recs)
                  JOIN item_rows USING (movie_id))
            WHERE rank BETWEEN {first} AND {last}""",
        "page_envelope": f"""
            SELECT CAST(json_object('success', true, 'data', json_object(
                'total', (SELECT count(*) FROM genre_recs),
                'limit', {PAGE.limit}, 'offset', {PAGE.offset},
                'recommendations', (SELECT coalesce(json_group_array(json_object(
                    'movie__title', title, 'movie__genres', genres, 'movie__year', year,
                    'recommendation_score', score)), json('[]')) FROM (
                  SELECT *, round(recommendation_score, 6) AS score FROM genre_recs
                  ORDER BY score DESC, movie_id
                  LIMIT {PAGE.limit} OFFSET {PAGE.offset})))) AS VARCHAR) AS envelope""",
        "dashboard_envelope": """
            SELECT CAST(json_object('success', true, 'data', json_object(
                'total_movies', (SELECT count(*) FROM items),
                'total_recommendations', (SELECT count(*) FROM recs),
                'average_rating', (SELECT round(avg(avg_rating), 2) FROM item_rows),
                'top_recommendations', (SELECT json_group_array(json_object(
                    'movie__title', title, 'movie__genres', genres,
                    'recommendation_score', score)) FROM (
                  SELECT i.movie_id, title, genres, round(recommendation_score, 6) AS score
                  FROM recs r JOIN items i ON i.movie_id = r.movie_id
                  ORDER BY score DESC, i.movie_id LIMIT 10)))) AS VARCHAR) AS envelope""",
        "dashboard_top10": """
            SELECT title, genres, recommendation_score
            FROM recs r JOIN items i ON i.movie_id = r.movie_id
            ORDER BY recommendation_score DESC, r.movie_id LIMIT 10""",
        "dashboard_stats": """
            SELECT count(*) AS total_movies,
                   (SELECT count(*) FROM recs) AS total_recommendations,
                   round(coalesce(avg(avg_rating), 0), 2) AS average_rating
            FROM item_rows""",
        "report_top10_sql": """
            SELECT title, recommendation_score, i.avg_rating, i.rating_count
            FROM recs r JOIN item_rows i ON i.movie_id = r.movie_id
            ORDER BY recommendation_score DESC, r.movie_id LIMIT 10""",
        "display_cards": """
            SELECT r.movie_id, round(recommendation_score, 3) AS score,
                   printf('%.2f', i.avg_rating) AS mean_text,
                   coalesce(nullif(genres, ''), 'Unknown') AS genres_text,
                   coalesce(nullif(genres, ''), 'N/A') AS genres_short,
                   CASE WHEN coalesce(year, 0) = 0 THEN 'Year unknown'
                        ELSE 'Year: ' || CAST(year AS VARCHAR) END AS year_text,
                   title || ' (' || printf('%.2f', i.avg_rating) || ')' AS item_text,
                   title || ' (Score: ' || printf('%.2f', recommendation_score) || ')'
                       AS recommendation_text
            FROM recs r JOIN item_rows i ON i.movie_id = r.movie_id""",
        "rating_labels": """
            SELECT 'User ' || CAST(user_id AS VARCHAR) || ' rated ' || title || ': '
                   || CAST(rating AS VARCHAR) AS label
            FROM ratings r JOIN items i ON i.movie_id = r.movie_id""",
        "dataset_labels": """
            SELECT id, data_file || CASE WHEN processed THEN ' - Processed'
                                         ELSE ' - Pending' END AS label
            FROM datasets""",
        "preference_labels": """SELECT "user" || '''s preferences' AS label FROM preferences""",
        "item_search": """
            SELECT movie_id, title FROM items
            WHERE (contains(lower(title), 'ring') OR contains(CAST(movie_id AS VARCHAR), 'ring')
                   OR coalesce(contains(lower(genres), 'ring'), false))
              AND (contains(lower(title), 'brand#1')
                   OR contains(CAST(movie_id AS VARCHAR), 'brand#1')
                   OR coalesce(contains(lower(genres), 'brand#1'), false))""",
        "recommendation_search": """
            SELECT r.movie_id, title, recommendation_score
            FROM recs r JOIN items i ON i.movie_id = r.movie_id
            WHERE contains(lower(title), 'blue') AND contains(lower(title), '(196')""",
        "browse_items": f"""
            SELECT row_number() OVER (ORDER BY avg_rating DESC, rating_count DESC, movie_id)
                       AS rank,
                   movie_id, title, genres, year, avg_rating, rating_count,
                   {stamp} AS created_at
            FROM item_rows
            WHERE year = 1968
              AND (contains(lower(title), 'ring') OR contains(CAST(movie_id AS VARCHAR), 'ring')
                   OR contains(lower(genres), 'ring'))
            ORDER BY rank LIMIT 50""",
        "browse_ratings": """
            SELECT row_number() OVER (ORDER BY created_at DESC, user_id, r.movie_id, rating)
                       AS rank,
                   user_id, title, rating, timestamp, created_at
            FROM ratings r JOIN items i ON i.movie_id = r.movie_id
            WHERE rating = 4.5
              AND (contains(CAST(user_id AS VARCHAR), '12') OR contains(lower(title), '12'))
              AND (contains(CAST(user_id AS VARCHAR), 'red') OR contains(lower(title), 'red'))
            ORDER BY rank LIMIT 100 OFFSET 50""",
        "browse_recommendations": f"""
            SELECT row_number() OVER (ORDER BY recommendation_score DESC, r.movie_id) AS rank,
                   title, recommendation_score, CAST(0 AS DOUBLE) AS popularity_score,
                   CAST(NULL AS BIGINT) AS user_id, {stamp} AS created_at
            FROM recs r JOIN items i ON i.movie_id = r.movie_id
            ORDER BY rank LIMIT 50 OFFSET 50""",
        "browse_datasets": """
            SELECT row_number() OVER (ORDER BY upload_date DESC, id) AS rank, *
            FROM datasets WHERE NOT processed AND contains(data_file, '7.csv')
              AND upload_date >= TIMESTAMP '1998-01-01' AND upload_date < TIMESTAMP '1999-01-01'
            ORDER BY rank LIMIT 100""",
        "browse_preferences": """
            SELECT row_number() OVER (ORDER BY created_at DESC, "user") AS rank, *
            FROM preferences WHERE contains(lower("user"), 'customer#0000001')
            ORDER BY rank LIMIT 100""",
        "facet_values": "SELECT rating, count(*) AS n FROM ratings GROUP BY rating",
        "facet_values_year": "SELECT year, count(*) AS n FROM item_rows GROUP BY year",
        "facet_filter_year": """
            SELECT movie_id, year FROM item_rows WHERE year = 1968 OR year IS NULL""",
        "facet_filter_rating": """
            SELECT user_id, movie_id, rating FROM ratings WHERE rating = 5.0""",
        "facet_filter_processed": "SELECT * FROM datasets WHERE processed",
        "facet_filter_dates": """
            SELECT 'today' AS bucket, count(*) AS n FROM datasets
              WHERE upload_date >= TIMESTAMP '1998-06-15' AND upload_date < TIMESTAMP '1998-06-16'
            UNION ALL SELECT 'past_7_days', count(*) FROM datasets
              WHERE upload_date >= TIMESTAMP '1998-06-08' AND upload_date < TIMESTAMP '1998-06-16'
            UNION ALL SELECT 'this_month', count(*) FROM datasets
              WHERE upload_date >= TIMESTAMP '1998-06-01' AND upload_date < TIMESTAMP '1998-07-01'
            UNION ALL SELECT 'this_year', count(*) FROM datasets
              WHERE upload_date >= TIMESTAMP '1998-01-01' AND upload_date < TIMESTAMP '1999-01-01'""",
        "facet_rows_past_7_days": """
            SELECT event_id, ts FROM events
            WHERE ts >= TIMESTAMP '2024-01-23' AND ts < TIMESTAMP '2024-01-31'""",
        "appended_items": """
            SELECT movie_id, title, round(recommendation_score, 6) AS recommendation_score
            FROM items LEFT JOIN scores USING (movie_id)""",
        "merged_statistics": """
            SELECT i.movie_id, title, year, i.avg_rating, i.rating_count,
                   round(recommendation_score, 6) AS recommendation_score
            FROM item_rows i LEFT JOIN scores s ON s.movie_id = i.movie_id""",
        "insert_defaults": """
            SELECT movie_id, title, CAST(NULL AS VARCHAR) AS genres,
                   coalesce(avg_rating, 0.0) AS avg_rating, CAST(0 AS BIGINT) AS rating_count
            FROM items LEFT JOIN stats USING (movie_id)""",
        "complete_page": """
            SELECT row_number() OVER (ORDER BY recommendation_score DESC, r.movie_id) AS rank,
                   title, genres, year, recommendation_score, count(*) OVER () AS total
            FROM recs r JOIN item_rows i ON i.movie_id = r.movie_id
            WHERE r.movie_id IN (SELECT movie_id FROM kept_items)
            ORDER BY rank LIMIT 20""",
        "dup_items": """
            SELECT movie_id, count(*) AS n FROM (
              SELECT movie_id FROM part_items UNION ALL SELECT s_suppkey FROM supplier)
            GROUP BY movie_id HAVING count(*) > 1""",
        "dup_ratings": """
            SELECT user_id, movie_id, count(*) AS n FROM ratings
            GROUP BY user_id, movie_id HAVING count(*) > 1""",
        "orphan_ratings": """
            SELECT movie_id, count(*) AS n FROM ratings r
            WHERE NOT EXISTS (SELECT 1 FROM kept_items k WHERE k.movie_id = r.movie_id)
            GROUP BY movie_id""",
        "cascade_delete": """
            SELECT user_id, movie_id, rating FROM ratings
            WHERE movie_id IN (SELECT movie_id FROM kept_items)""",
        "orphan_recommendations": """
            SELECT movie_id, count(*) AS n FROM recs
            WHERE movie_id NOT IN (SELECT movie_id FROM kept_items) GROUP BY movie_id""",
        "cascade_delete_recommendations": """
            SELECT movie_id, recommendation_score FROM recs
            WHERE movie_id IN (SELECT movie_id FROM kept_items)""",
        "null_violations_ratings": """
            SELECT 'ratings.user_id:required' AS rule,
                   count(*) FILTER (user_id IS NULL) AS n FROM opened
            UNION ALL SELECT 'ratings.movie_id:required',
                   count(*) FILTER (movie_id IS NULL) FROM opened
            UNION ALL SELECT 'ratings.rating:required',
                   count(*) FILTER (rating IS NULL) FROM opened
            UNION ALL SELECT 'ratings.timestamp:required',
                   count(*) FILTER (timestamp IS NULL) FROM opened
            UNION ALL SELECT 'ratings.created_at:required',
                   count(*) FILTER (created_at IS NULL) FROM opened""",
        "null_violations": """
            SELECT 'movies.movie_id:required' AS rule, count(*) FILTER (movie_id IS NULL) AS n FROM items
            UNION ALL SELECT 'movies.title:required', count(*) FROM items WHERE title IS NULL
            UNION ALL SELECT 'movies.avg_rating:required', count(*) FROM items
              WHERE movie_id NOT IN (SELECT movie_id FROM stats)
            UNION ALL SELECT 'movies.rating_count:required', count(*) FROM items
              WHERE movie_id NOT IN (SELECT movie_id FROM stats)""",
        "length_violations": """
            SELECT 'movies.title:max_length' AS rule, count(*) FILTER (length(title) > 500) AS n
            FROM document_items
            UNION ALL SELECT 'movies.genres:max_length', count(*) FILTER (length(genres) > 200)
            FROM document_items
            UNION ALL SELECT 'raw_dataset.data_file:max_length',
                             count(*) FILTER (length(data_file) > 255) FROM datasets
            UNION ALL SELECT 'user_preference.favorite_categories:max_length',
                             count(*) FILTER (length(favorite_categories) > 500)
            FROM preferences""",
        "length_violation_rows": """
            SELECT movie_id, concat_ws(',', CASE WHEN length(title) > 500 THEN 'movies.title:max_length' END,
                       CASE WHEN length(genres) > 200 THEN 'movies.genres:max_length' END) AS broken_rules
            FROM document_items WHERE length(title) > 500 OR length(genres) > 200""",
        "csv_scan_typed": "SELECT user_id, movie_id, rating, timestamp FROM ratings",
        "csv_scan_inferred": "SELECT user_id, movie_id, rating, timestamp FROM ratings",
        "csv_scan_items": "SELECT movie_id, title, genres FROM items",
        "csv_rejected": """
            SELECT c_custkey || ',' || c_mktsegment || ',4.5,0' AS line, c_custkey AS user_id,
                   CAST(NULL AS BIGINT) AS movie_id, 4.5::DOUBLE AS rating FROM customer
            UNION ALL
            SELECT s_suppkey || ',7,' || s_name || ',0', s_suppkey, 7, NULL FROM supplier""",
    }
    # Other layouts of the same tables.
    for name, plain in (
        ("facet_rows_by_day", "facet_rows_past_7_days"),
        ("browse_datasets_by_day", "browse_datasets"),
        ("bucketed_orphans", "orphan_ratings"),
        ("bucketed_cascade", "cascade_delete"),
        ("bucketed_item_table", "item_table"),
    ):
        statements[name] = statements[plain]
    own = {name: _sql(body) for name, body in statements.items()}
    return own if training_data is None else own | training_data.ORACLES
