"""Hand-computed cases: statistics, priors, scores, tables."""

import pytest
from pyspark.sql import functions as F

from rankspark.functions import title_year
from rankspark.operators import stats as S
from rankspark.operators.scores import existing_only, score_items
from rankspark.operators.tables import cascade_delete, item_table, recommendation_table
from rankspark.plans.batch import JobConfig, build, recommend
from rankspark.schemas import ITEMS, RECOMMENDATIONS, conform


def table(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


def rounded(df, column="recommendation_score"):
    return {
        r["movie_id"]: None if r[column] is None else round(r[column], 6) for r in df.collect()
    }


@pytest.fixture(scope="module")
def stats(micro):
    return S.item_stats(micro[1])


def test_item_stats(stats):
    rows = table(stats, "movie_id", F.round("avg_rating", 6), "rating_count", "row_count")
    assert rows == {1: (4.666667, 3, 3), 2: (3.0, 1, 1)}


def test_null_ratings_and_null_items(spark):
    ratings = spark.createDataFrame(
        [(1, 1.0), (1, None), (2, None), (None, 4.0), (None, None)],
        "movie_id bigint, rating double",
    )
    rows = table(S.item_stats(ratings), "movie_id", "avg_rating", "rating_count", "row_count")
    assert rows == {1: (1.0, 1, 2), 2: (None, 0, 1), None: (4.0, 1, 2)}
    assert S.ratings_prior(S.item_stats(ratings)).first()[0] == 2.5


def test_priors_differ(micro, stats):
    assert S.ratings_prior(stats).first()["prior"] == 4.25
    assert S.ratings_mean(micro[1]).first()["prior"] == 4.25
    assert round(S.items_prior(stats).first()["prior"], 6) == 3.833333
    assert S.dashboard_mean(item_table(micro[0], stats)).first()["average_rating"] == 2.56


@pytest.mark.parametrize("values", [[], [(1, 0.0), (2, 0.0)], [(1, None)]])
def test_ratings_prior_falls_back(spark, values):
    ratings = spark.createDataFrame(values, "movie_id bigint, rating double")
    assert S.ratings_prior(S.item_stats(ratings)).first()["prior"] == 3.0
    assert S.ratings_mean(ratings).first()["prior"] == 3.0


def test_no_ratings(spark, micro):
    empty = spark.createDataFrame([], "user_id bigint, movie_id bigint, rating double")
    stats = S.item_stats(empty)
    assert S.items_prior(stats).first()["prior"] is None
    assert score_items(stats, stats).count() == 0
    assert recommend(micro[0], stats, JobConfig.top_rated(1, 10)).count() == 0
    assert S.dashboard_mean(item_table(micro[0].limit(0), stats)).first()[0] == 0.0


def test_scores_against_all_ratings(stats):
    assert rounded(score_items(stats, stats, "ratings", 10)) == {1: 4.346154, 2: 4.136364}


def test_scores_against_item_means(micro, stats):
    rated = item_table(micro[0], stats)
    assert rounded(score_items(rated, stats, "items", 1, 1)) == {1: 4.458333, 2: 3.416667}


def test_threshold_zero_scores_unrated_items_null_and_last(micro, stats):
    best = recommend(micro[0], stats, JobConfig("items", 0, 0, top_n=3))
    assert rounded(best) == {1: 4.666667, 2: 3.0, 3: None}
    assert [r["movie_id"] for r in best.collect()] == [1, 2, 3]


def test_item_with_only_null_ratings_has_null_score(spark, micro):
    ratings = spark.createDataFrame([(1, 4.0), (2, None)], "movie_id bigint, rating double")
    stats = S.item_stats(ratings)
    assert rounded(recommend(micro[0], stats, JobConfig())) == {1: 4.0, 2: None}
    filled = table(item_table(micro[0], stats), "movie_id", "avg_rating", "rating_count")
    assert filled[2] == (0.0, 0)


def test_orphans_count_in_the_prior_and_leave_the_result(spark, micro):
    ratings = spark.createDataFrame(
        [(1, 4.0), (99, 1.0), (None, 1.0)], "movie_id bigint, rating double"
    )
    stats = S.item_stats(ratings)
    assert S.ratings_prior(stats).first()["prior"] == 2.0
    scores = existing_only(score_items(stats, stats, "ratings", 1), micro[0])
    assert rounded(scores) == {1: 3.0}


def test_null_item_ids_never_match(spark):
    items = spark.createDataFrame(
        [(None, "a", "g"), (1, "b", "g")], "movie_id bigint, title string, genres string"
    )
    ratings = spark.createDataFrame([(None, 4.0), (1, 2.0)], "movie_id bigint, rating double")
    stats = S.item_stats(ratings)
    rows = table(item_table(items, stats), "movie_id", "avg_rating", "rating_count")
    assert rows == {None: (0.0, 0), 1: (2.0, 1)}
    assert [r[0] for r in existing_only(stats, items).select("movie_id").collect()] == [1]


def test_repeated_item_ids_repeat_rows(spark, micro, stats):
    items = micro[0].unionAll(micro[0])
    assert item_table(items, stats).count() == 6


@pytest.mark.parametrize(
    "title, year",
    [
        ("Toy Story (1995)", 1995),
        ("2001 (1968) (1999)", 1968),
        ("X (95)", None),
        ("No year", None),
        ("Far (12345)", None),
        (None, None),
    ],
)
def test_title_year(spark, title, year):
    df = spark.createDataFrame([(title,)], "title string")
    assert df.select(title_year(F.col("title"))).first()[0] == year


def test_unknown_prior_is_refused(stats):
    with pytest.raises(ValueError, match="unknown prior"):
        score_items(stats, stats, "median")
    with pytest.raises(ValueError, match="unknown prior"):
        JobConfig(prior="median")


def test_result_tables(spark, micro):
    stamp = F.lit("2024-01-30 00:00:00").cast("timestamp")
    items, scores = build(*micro, JobConfig(), stamp)
    assert items.columns == ITEMS.column_names
    assert conform(scores, RECOMMENDATIONS).columns == RECOMMENDATIONS.column_names
    row = scores.filter("movie_id = 2").first()
    assert (row["popularity_score"], row["genre_match_score"], row["user_id"]) == (3.0, 0.0, None)
    assert row["created_at"] == row["updated_at"]
    zero = build(*micro, JobConfig.all_items(), stamp)[1]
    assert zero.agg(F.sum("popularity_score")).first()[0] == 0.0
    with pytest.raises(ValueError):
        recommendation_table(scores, stamp, "median")


def test_conform_fills_defaults_and_narrows(spark, conf):
    df = spark.createDataFrame([(1, "t", None)], "movie_id bigint, title string, avg_rating double")
    stored = conform(df, ITEMS, narrow=True)
    assert dict(stored.dtypes)["movie_id"] == "int"
    assert dict(stored.dtypes)["rating_count"] == "int"
    row = stored.first()
    assert (row["avg_rating"], row["rating_count"], row["genres"]) == (0.0, 0, None)
    wide = spark.createDataFrame([(2**31, "t")], "movie_id bigint, title string")
    assert conform(wide, ITEMS).first()["movie_id"] == 2**31
    for ansi in ("true", "false"):
        conf(ansi__enabled=ansi)
        with pytest.raises(Exception, match="movie_id does not fit int"):
            conform(wide, ITEMS, narrow=True).collect()


def test_cascade_delete_keeps_null_keys(spark):
    children = spark.createDataFrame([(1,), (2,), (None,)], "movie_id bigint")
    deleted = spark.createDataFrame([(1,), (1,), (None,)], "movie_id bigint")
    left = [r[0] for r in cascade_delete(children, deleted).collect()]
    assert sorted(left, key=str) == [2, None]


def test_development_subset_changes_the_prior(micro):
    _, scores = build(*micro, JobConfig.all_items(item_limit=1))
    assert rounded(scores) == {1: 4.666667}


def test_job_summary(micro, stats):
    scores = recommend(micro[0], stats, JobConfig())
    assert table(S.job_summary(micro[0], stats, scores), "metric", "value") == {
        "total_movies": (3,),
        "total_ratings": (4,),
        "movies_with_stats": (2,),
        "recommendations_generated": (2,),
    }
