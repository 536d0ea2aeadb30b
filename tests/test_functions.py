"""Text tests, search terms, dates and labels."""

import datetime as dt
import math
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rankspark import functions as X
from rankspark.operators import facets
from rankspark.operators.serving import PageRequest, genre_filter


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "genres, term, kept",
    [
        ("Sci-Fi|War", "sci", True),
        ("Sci-Fi|War", "%", False),
        ("a%b", "%", True),
        ("Sci-Fi", "_", False),
        ("Brand#10", "brand#1", True),
        (None, "sci", False),
        (None, "", True),
        ("anything", "", True),
    ],
)
def test_genre_filter(spark, genres, term, kept):
    df = spark.createDataFrame([(genres,)], "genres string")
    assert bool(genre_filter(df, term).count()) is kept


@pytest.mark.parametrize(
    "query, terms",
    [
        ("", []),
        ("  ", []),
        ("red ring", ["red", "ring"]),
        ('"red ring" 12', ["red ring", "12"]),
        ("'a b' c", ["a b", "c"]),
        ("it's late", ["it's", "late"]),
        ('open "quote', ["open", '"quote']),
        ('""', []),
    ],
)
def test_search_terms(query, terms):
    assert X.search_terms(query) == terms


def test_contains_any_column(spark):
    df = spark.createDataFrame(
        [(12, "Red ring"), (7, "red 12"), (120, None), (5, None)], "id bigint, title string"
    )
    test = X.contains_any([F.col("id"), F.col("title")], "12")
    assert [r[0] for r in df.select(test).collect()] == [True, True, True, False]


def test_date_buckets():
    day = dt.date(2024, 2, 29)
    assert X.date_bucket_range("today", day) == (day, dt.date(2024, 3, 1))
    assert X.date_bucket_range("past_7_days", day) == (dt.date(2024, 2, 22), dt.date(2024, 3, 1))
    assert X.date_bucket_range("this_month", day) == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    december = X.date_bucket_range("this_month", dt.date(2023, 12, 31))
    assert december == (dt.date(2023, 12, 1), dt.date(2024, 1, 1))
    assert X.date_bucket_range("this_year", day) == (dt.date(2024, 1, 1), dt.date(2025, 1, 1))
    with pytest.raises(ValueError):
        X.date_bucket_range("ever", day)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_date_bucket_edges(spark, kind):
    times = ["2024-01-22 23:59:59", "2024-01-23 00:00:00", "2024-01-30 23:59:59", "2024-01-31", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast(kind))
    as_of = dt.date(2024, 1, 30)
    assert facets.facet_filter_date(df, "t", "past_7_days", as_of).count() == 2
    counts = {r["bucket"]: r["n"] for r in facets.facet_date_counts(df, "t", as_of).collect()}
    assert counts == {"today": 1, "past_7_days": 2, "this_month": 4, "this_year": 4}


def test_facets_with_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "v int")
    assert [tuple(r) for r in facets.facet_values(df, "v").collect()] == [(None, 1), (1, 2)]
    assert facets.facet_filter(df, "v", None).count() == 1
    assert facets.facet_filter(df, "v", 1).count() == 2


def test_labels(spark):
    lit = F.lit
    assert value(spark, X.genres_label(lit(""))) == "Unknown"
    assert value(spark, X.genres_label(lit(None).cast("string"), "N/A")) == "N/A"
    assert value(spark, X.genres_label(lit("War"))) == "War"
    assert value(spark, X.year_label(lit(0))) == "Year unknown"
    assert value(spark, X.year_label(lit(None).cast("int"))) == "Year unknown"
    assert value(spark, X.year_label(lit(1995))) == "Year: 1995"
    assert value(spark, X.item_label(lit("Toy"), lit(4.666667))) == "Toy (4.67)"
    assert value(spark, X.recommendation_label(lit("Toy"), lit(3.0))) == "Toy (Score: 3.00)"
    assert value(spark, X.rating_label(lit(7), lit("Toy"), lit(3.5))) == "User 7 rated Toy: 3.5"
    assert value(spark, X.dataset_label(lit("f"), lit(True))) == "f - Processed"
    assert value(spark, X.dataset_label(lit("f"), lit(None).cast("boolean"))) == "f - Pending"
    assert value(spark, X.preference_label(lit("ann"))) == "ann's preferences"
    assert value(spark, X.thousands(lit(1234567))) == "1,234,567"


def test_fixed_rounds_like_c(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=50))
    def check(values):
        values = [*values, 0.125, 2.675, 0.375, 1.005, 4.0625]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        rows = df.select("v", X.fixed(F.col("v"), 2).alias("t")).collect()
        for v, text in rows:
            expected = f"{v:.2f}"
            assert float(text) == float(expected)
            if float(expected):
                assert text == expected

    check()


def test_page_request():
    assert PageRequest.parse({}) == PageRequest(20, 0, "")
    assert PageRequest.parse({"limit": "5", "offset": "10", "genre": "x"}) == PageRequest(5, 10, "x")
    with pytest.raises(ValueError):
        PageRequest.parse({"limit": "many"})


def test_exact_sum_is_the_same_in_any_order(spark):
    draw = random.Random(11)
    values = [draw.uniform(-1, 1) * 10 ** draw.randint(-9, 12) for _ in range(3000)] + [0.1] * 1000 + [None]
    found, plain = set(), set()
    for partitions in (1, 3, 17):
        draw.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
        row = df.agg(X.exact_sum(F.col("v")), X.exact_mean(F.col("v")), F.sum("v")).first()
        found.add((row[0].hex(), row[1].hex()))
        plain.add(row[2])
    assert len(found) == 1
    exact = math.fsum(v for v in values if v is not None)
    assert float.fromhex(found.pop()[0]) == pytest.approx(exact, rel=1e-15)


@pytest.mark.parametrize("values, wanted", [([], None), ([None], None), ([1.0, math.inf], math.inf), ([-0.75, 0.25], -0.5)])
def test_exact_sum_of_few(spark, values, wanted):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(X.exact_sum(F.col("v"))).first()[0] == wanted


def test_exact_sum_with_nan(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,)], "v double")
    assert math.isnan(df.agg(X.exact_sum(F.col("v"))).first()[0])


def test_items_prior_does_not_depend_on_partitions(spark):
    from rankspark.operators.stats import items_prior

    draw = random.Random(5)
    means = spark.createDataFrame([(i, draw.uniform(0, 5)) for i in range(4000)], "movie_id long, avg_rating double")
    found = {items_prior(means.repartition(n)).first()["prior"].hex() for n in (1, 4, 31)}
    assert len(found) == 1
