"""Listings and searches against plain Python over generated rows."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from rankspark.functions import search_terms
from rankspark.operators.browse import browse, search
from rankspark.schemas import DATASETS, ITEMS, RATINGS

relaxed = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
texts = st.one_of(st.none(), st.text("abAB 12%_'\"", max_size=6))
rows = st.lists(st.tuples(st.integers(1, 30), texts, texts), min_size=1, max_size=40)


@relaxed
@given(rows=rows, query=st.text("abA 12%_\"'", max_size=6))
def test_search_matches_brute_force(spark, rows, query):
    df = spark.createDataFrame(rows, "movie_id bigint, title string, genres string")

    def hit(row):
        fields = [str(v).lower() for v in row if v is not None]
        return all(any(t.lower() in f for f in fields) for t in search_terms(query))

    found = [tuple(r) for r in search(df, ITEMS, query).collect()]
    assert sorted(found, key=str) == sorted(filter(hit, rows), key=str)


@pytest.fixture(scope="module")
def ratings(spark):
    data = [
        (user, item, item % 5 + 0.5, 100 * user, dt.datetime(2024, 1, 1 + (user * item) % 30))
        for user in range(1, 15)
        for item in (1, 2, 3, 5, 8)
    ]
    names = "user_id bigint, movie_id bigint, rating double, timestamp bigint, created_at timestamp"
    titles = {1: "red ring", 2: "Red 12", 3: "blue", 5: None, 8: "green"}
    items = spark.createDataFrame(list(titles.items()), "movie_id bigint, title string")
    return spark.createDataFrame(data, names), items, data, titles


@pytest.mark.parametrize("query", ["", "red", "1 red", "12", "none of it"])
@pytest.mark.parametrize("limit, offset", [(None, 0), (7, 3), (5, 1000)])
def test_browse_ratings(ratings, query, limit, offset):
    df, items, data, titles = ratings
    terms = query.split()
    if query == "none of it":
        query, terms = '"none of it"', ["none of it"]
    kept = [
        r for r in data
        if all(t in str(r[0]) or t in (titles[r[1]] or "").lower() for t in terms)
    ]
    kept.sort(key=lambda r: (-r[4].toordinal(), r[0], r[1], r[2], r[3]))
    size = limit if limit is not None else RATINGS.page_size
    expected = [
        (place, r[0], titles[r[1]], r[2], r[3])
        for place, r in enumerate(kept, start=1)
        if offset < place <= offset + size
    ]
    page = browse(df, RATINGS, items, query=query, limit=limit, offset=offset)
    assert page.columns == ["rank", "user_id", "title", "rating", "timestamp", "created_at"]
    assert [tuple(r)[:5] for r in page.collect()] == expected


def test_facets_and_dates_narrow_the_listing(ratings):
    df, items, data, _ = ratings
    as_of = dt.date(2024, 1, 10)
    page = browse(
        df, RATINGS, items, facets={"rating": 1.5}, dates={"created_at": ("past_7_days", as_of)}
    )
    expected = [r for r in data if r[2] == 1.5 and 3 <= r[4].day <= 10]
    assert page.count() == len(expected) > 0


def test_unknown_facet_and_missing_items_are_refused(ratings):
    df, items, _, _ = ratings
    with pytest.raises(ValueError, match="no facet"):
        browse(df, RATINGS, items, facets={"user_id": 1})
    with pytest.raises(ValueError, match="no facet"):
        browse(df, RATINGS, items, dates={"rating": ("today", dt.date(2024, 1, 1))})
    with pytest.raises(ValueError, match="item table"):
        browse(df, RATINGS)


def test_datasets_newest_first(spark):
    df = spark.createDataFrame(
        [(i, f"f{i}", dt.datetime(2024, 1, 1 + i % 3), i % 2 == 0, None, i) for i in range(6)],
        DATASETS.ddl,
    )
    page = browse(df, DATASETS, facets={"processed": False})
    assert [r["id"] for r in page.collect()] == [5, 1, 3]


def test_titles_are_tested_before_the_join(ratings):
    df, items, _, _ = ratings
    found = search(df, RATINGS, "red 12", items)
    assert found.columns == df.columns
    text = found._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join Inner")
    assert "Outer" not in text
    assert "lower(title" not in text[:join] and "lower(title" in text[join:]


def test_a_rating_without_item_stays_on_its_page(ratings):
    df, items, _, _ = ratings
    page = browse(df, RATINGS, items.limit(0))
    assert page.count() == min(100, df.count())
    assert page.where("title IS NOT NULL").count() == 0
