"""Rule checks against small tables with known faults."""

import pytest

from rankspark.operators import quality
from rankspark.schemas import ITEMS, RATINGS


@pytest.fixture(scope="module")
def faulty(spark):
    return spark.createDataFrame(
        [
            (1, "ok", "g"),
            (1, None, "g"),
            (None, "x" * 501, "y" * 201),
            (None, "x" * 500, None),
        ],
        "movie_id bigint, title string, genres string",
    )


def counts(df, key):
    return {r[key]: r["n"] for r in df.collect()}


def test_duplicates_ignore_null_keys(faulty):
    assert counts(quality.duplicates(faulty, ["movie_id"]), "movie_id") == {1: 2}


def test_null_violations(faulty):
    assert counts(quality.null_violations(faulty, ITEMS), "rule") == {
        "movies.movie_id:required": 2,
        "movies.title:required": 1,
    }


def test_length_violations(faulty):
    assert counts(quality.length_violations(faulty, ITEMS), "rule") == {
        "movies.title:max_length": 1,
        "movies.genres:max_length": 1,
    }


def test_violating_rows_name_their_rules(faulty):
    rules = quality.null_rules(faulty, ITEMS) | quality.length_rules(faulty, ITEMS)
    broken = [sorted(r["broken_rules"]) for r in quality.violating_rows(faulty, rules).collect()]
    assert sorted(broken) == [
        ["movies.genres:max_length", "movies.movie_id:required", "movies.title:max_length"],
        ["movies.movie_id:required"],
        ["movies.title:required"],
    ]


def test_orphans_and_duplicate_ratings(spark):
    ratings = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 1), (1, 9), (2, 9), (1, None)], "user_id bigint, movie_id bigint"
    )
    items = spark.createDataFrame([(1,), (2,)], "movie_id bigint")
    assert counts(quality.orphans(ratings, items), "movie_id") == {9: 2}
    repeated = quality.duplicates(ratings, list(RATINGS.unique)).collect()
    assert [tuple(r) for r in repeated] == [(1, 1, 2)]
