"""Pages, ranks and page arithmetic against plain Python."""

import random

import pytest

from rankspark.operators.paging import deep_page, global_rank, page, page_info, page_offset, top_n

ORDER = (("score", True), ("id", False))


@pytest.fixture(scope="module")
def scored(spark):
    """A third of the rows share one score, some have none."""
    draw = random.Random(7)
    rows = [
        (i, draw.choice([2.5, draw.uniform(0, 5), round(draw.uniform(0, 5), 1), None]))
        for i in range(2000)
    ]
    draw.shuffle(rows)
    ordered = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    return spark.createDataFrame(rows, "id bigint, score double").repartition(7), ordered


def test_top_n_with_ties(scored):
    df, ordered = scored
    for n in (0, 50, 600, 100_000):
        assert [r["id"] for r in top_n(df, ORDER, n).collect()] == [i for i, _ in ordered[:n]]


def test_global_rank_matches_sort(scored):
    df, ordered = scored
    ranks = {r["id"]: r["rank"] for r in global_rank(df, ORDER).collect()}
    assert ranks == {i: place for place, (i, _) in enumerate(ordered, start=1)}


def test_global_rank_with_one_hot_score(spark):
    df = spark.range(0, 5000, 1, 8).selectExpr("id", "IF(id % 3 = 0, 1.0D, rand(5)) AS score")
    rows = global_rank(df, ORDER).collect()
    expected = sorted(rows, key=lambda r: (-r["score"], r["id"]))
    assert [r["rank"] for r in expected] == list(range(1, 5001))


def test_global_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, score double")
    assert global_rank(df, ORDER).collect() == []


@pytest.mark.parametrize("limit, offset", [(20, 0), (20, 1990), (5, 777), (0, 0), (10, 5000)])
def test_shallow_and_deep_pages_agree(scored, limit, offset):
    df, ordered = scored
    expected = [
        (offset + k, i) for k, (i, _) in enumerate(ordered[offset : offset + limit], start=1)
    ]
    for cut in (page, deep_page):
        assert [(r["rank"], r["id"]) for r in cut(df, ORDER, limit, offset).collect()] == expected


@pytest.mark.parametrize(
    "total, limit, offset, expected",
    [
        (45, 20, 40, (45, 3, 3, True, False)),
        (45, 20, 0, (45, 1, 3, False, True)),
        (0, 20, 0, (0, 1, 0, False, False)),
        (40, 20, 20, (40, 2, 2, True, False)),
        (3, 0, 0, (3, 1, None, False, False)),
    ],
)
def test_page_info(spark, total, limit, offset, expected):
    assert tuple(page_info(spark.range(total), limit, offset).first()) == expected


def test_bad_arguments(spark):
    df = spark.range(3).selectExpr("id", "1.0D AS score")
    for limit, offset in ((-1, 0), (1, -1)):
        with pytest.raises(ValueError):
            page(df, ORDER, limit, offset)
        with pytest.raises(ValueError):
            page_info(df, limit, offset)
    with pytest.raises(ValueError):
        top_n(df, ORDER, -1)
    with pytest.raises(ValueError):
        page_offset(0, 20)
    assert page_offset(3, 20) == 40


def test_large_json_page_is_whole(spark):
    from rankspark.operators.serving import PageRequest, page_entries, page_envelope

    scores = spark.range(3).selectExpr("id AS movie_id", "1.0D AS recommendation_score")
    items = spark.range(3).selectExpr("id AS movie_id", "'t' AS title", "'g' AS genres", "1 AS year")
    assert page_envelope(scores, items, PageRequest(limit=20_000)).first()[0].count('"movie__title"') == 3
    assert page_entries(scores, items, PageRequest(limit=20_000)).count() == 3


@pytest.mark.parametrize("deep", [False, True])
def test_pages_are_whole(spark, deep):
    """Items stored twice repeat their ranks; items that are gone take no place on a page."""
    from rankspark.operators.serving import PageRequest, dashboard_top, recommendation_page, report_top

    scores = spark.range(40).selectExpr("id AS movie_id", "double(id) AS recommendation_score")
    columns = "'g' AS genres", "1 AS year", "1.0D AS avg_rating", "1 AS rating_count"
    items = spark.range(40).selectExpr("id AS movie_id", "string(id) AS title", *columns)
    twice = items.unionAll(items)
    rows = recommendation_page(scores, twice, PageRequest(limit=10), deep).collect()
    assert [r["rank"] for r in rows] == [k for k in range(1, 11) for _ in range(2)]
    even = items.where("movie_id % 2 = 0")
    rows = recommendation_page(scores, even, PageRequest(limit=10), deep).collect()
    assert [(r["rank"], r["title"]) for r in rows] == [(k, str(40 - 2 * k)) for k in range(1, 11)]
    assert dashboard_top(scores, even).count() == report_top(scores, even).count() == 10


def test_null_ids_come_last_in_a_subset(spark):
    from rankspark.sources import item_subset

    items = spark.createDataFrame([(None,), (2,), (1,)], "movie_id bigint")
    assert [r[0] for r in item_subset(items, 2).collect()] == [1, 2]


@pytest.mark.parametrize("few", [0, 10, 300])
@pytest.mark.parametrize("limit, offset", [(20, 0), (20, 1990), (5, 777), (0, 3), (10, 5000), (700, 600)])
def test_deep_pages_by_rounds(scored, limit, offset, few):
    df, ordered = scored
    expected = [(offset + k, i) for k, (i, _) in enumerate(ordered[offset : offset + limit], start=1)]
    assert [(r["rank"], r["id"]) for r in deep_page(df, ORDER, limit, offset, few).collect()] == expected


def test_deep_pages_of_other_types(spark):
    """Dates and texts in the order, NULLs and NaN among the values, both directions."""
    df = spark.range(0, 900, 1, 3).selectExpr(
        "id",
        "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN CAST('NaN' AS double) ELSE id % 11 END AS score",
        "CASE WHEN id % 3 > 0 THEN timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 13) END AS day",
        "CAST(id % 17 AS string) AS name",
    )
    for order in ((("score", True), ("day", False), ("id", True)), (("day", True), ("name", True), ("score", False), ("id", False))):
        for limit, offset in ((7, 100), (30, 555), (10, 880)):
            deep = deep_page(df, order, limit, offset, few=5).collect()
            assert list(map(str, deep)) == list(map(str, page(df, order, limit, offset).collect()))
            assert [r["rank"] for r in deep] == list(range(offset + 1, offset + limit + 1))


def test_deep_page_among_equal_rows(spark):
    df = spark.range(500).selectExpr("1.5D AS score", "CAST(3 AS long) AS id")
    assert [r["rank"] for r in deep_page(df, ORDER, 5, 400, few=2).collect()] == [401, 402, 403, 404, 405]
