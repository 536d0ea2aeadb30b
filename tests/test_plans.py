"""What the executed plans must and must not contain."""

import pytest

import __spark_entry__ as entry
from rankspark.operators import paging, quality
from rankspark.operators.scores import existing_only, score_items
from rankspark.operators.stats import item_stats
from rankspark.operators.tables import cascade_delete, item_table
from rankspark.plans import adapters
from tests import plan
from tests.conftest import TESTDATA

SF = str(TESTDATA / "sf0.01")
QUERIES = {q.__name__: q for q in entry._QUERIES}

# Queries that need the ratings and read them in one scan, prior included.
ONE_RATINGS_SCAN = [
    "item_stats",
    "prior_ratings",
    "prior_items",
    "bayes_ratings_prior",
    "bayes_items_prior",
    "existing_item_scores",
    "top10_titles",
    "top_n",
    "item_table",
    "recommendation_table",
    "subset_run",
    "ratings_of_subset",
    "orphan_ratings",
    "cascade_delete",
    "dup_ratings",
    "null_violations",
]


def ratings_scans(nodes):
    return sum(k == "FileSourceScanExec" and "lineitem.parquet" in t for k, t in nodes)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("name", ONE_RATINGS_SCAN)
def test_ratings_are_read_once(spark, conf, name, threshold):
    conf(autoBroadcastJoinThreshold=threshold)
    nodes = plan.nodes(QUERIES[name](spark, SF))
    assert ratings_scans(nodes) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    nodes = plan.nodes(QUERIES[name](spark, str(TESTDATA / "sf0.001")))
    for kind in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert plan.count(nodes, kind) == 0
    # Nothing is broadcast by hand.
    assert plan.count(nodes, "BroadcastExchange") == 0


@pytest.mark.parametrize("name", ["top10_titles", "top_n", "dashboard_top10", "recommendation_page"])
def test_top_k_instead_of_full_sort(spark, name):
    nodes = plan.nodes(QUERIES[name](spark, SF))
    assert plan.count(nodes, "TakeOrderedAndProject") >= 1
    assert plan.count(nodes, "ShuffleExchangeExec", "rangepartitioning") == 0


@pytest.mark.parametrize("name", ["item_stats", "bayes_ratings_prior"])
def test_only_two_rating_columns_are_read(spark, name):
    nodes = plan.nodes(QUERIES[name](spark, SF))
    scan = next(t for k, t in nodes if k == "FileSourceScanExec")
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in scan


def test_plain_mean_needs_one_column_and_no_key_shuffle(spark):
    nodes = plan.nodes(QUERIES["prior_ratings"](spark, SF))
    assert plan.count(nodes, "FileSourceScanExec", "ReadSchema: struct<l_quantity:double>") == 1
    assert plan.count(nodes, "ShuffleExchangeExec", "hashpartitioning") == 0


def test_statistics_combine_before_the_shuffle(spark):
    nodes = plan.nodes(QUERIES["item_stats"](spark, SF))
    assert plan.count(nodes, "HashAggregate", "partial_sum") == 1


def test_stored_keys_are_a_semi_join(spark):
    nodes = plan.nodes(QUERIES["existing_item_scores"](spark, SF))
    assert any("Join" in k and "LeftSemi" in t for k, t in nodes)


def test_date_facet_reaches_the_scan(spark):
    nodes = plan.nodes(QUERIES["facet_rows_past_7_days"](spark, SF))
    assert plan.count(nodes, "FileSourceScanExec", "GreaterThanOrEqual(ts,") == 1
    assert plan.count(nodes, "FileSourceScanExec", "LessThan(ts,") == 1


def test_stored_facet_reaches_the_scan(spark):
    nodes = plan.nodes(QUERIES["facet_filter_processed"](spark, SF))
    assert plan.count(nodes, "FileSourceScanExec", "EqualTo(o_orderstatus,F)") == 1


def test_orphans_are_counted_before_the_join(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    ratings, items = adapters.ratings(spark, SF), adapters.part_items(spark, SF)
    names = [k for k, _ in plan.nodes(quality.orphans(ratings, items))]
    assert names.index("SortMergeJoinExec") < names.index("HashAggregateExec")


@pytest.fixture
def tiny_skew(conf):
    """Let adaptive execution call a partition of a few kilobytes skewed."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="2KB",
        adaptive__autoBroadcastJoinThreshold="-1",
    )


def skewed_joins(df):
    return [t for k, t in plan.nodes(df) if k == "SortMergeJoinExec" and "skew=true" in t]


def hot(spark, rows, columns):
    """A third of the rows carry key 7."""
    return spark.range(0, rows, 1, 8).selectExpr("IF(id % 3 = 0, 7, id) AS movie_id", *columns)


def test_hot_item_splits_in_rating_joins(spark, tiny_skew):
    ratings = hot(spark, 60_000, ["id AS user_id", "1.5D AS rating"])
    deleted = spark.range(10, 30_000, 2).toDF("movie_id")
    left = cascade_delete(ratings, deleted)
    assert skewed_joins(left)
    assert left.count() == ratings.filter("NOT (movie_id >= 10 AND movie_id < 30000 AND movie_id % 2 = 0)").count()


def test_hot_item_row_splits_in_the_item_table(spark, tiny_skew):
    items = hot(spark, 60_000, ["CAST(id AS STRING) AS title", "'g' AS genres"])
    ratings = hot(spark, 60_000, ["id AS user_id", "(id % 10 + 1) / 2 AS rating"])
    table = item_table(items, item_stats(ratings))
    assert skewed_joins(table)
    assert table.count() == 60_000
    assert table.filter("movie_id = 7 AND rating_count <> 20001").count() == 0


def test_scores_of_a_hot_item(spark, tiny_skew):
    ratings = hot(spark, 60_000, ["id AS user_id", "(id % 10 + 1) / 2 AS rating"])
    stats = item_stats(ratings)
    items = spark.range(5, 10).toDF("movie_id")
    scores = existing_only(score_items(stats, stats), items)
    assert sorted(r["movie_id"] for r in scores.collect()) == [5, 7, 8]


@pytest.mark.parametrize(
    "name, semi_joins",
    [("dashboard_top10", True), ("report_top10_sql", True), ("browse_recommendations", False), ("page_entries", True)],
)
def test_titles_meet_only_the_page(spark, conf, name, semi_joins):
    """With an item table too large to broadcast, the page is.

    Only ids and scores are shuffled, where a list starts from what has an item.
    """
    conf(autoBroadcastJoinThreshold="5KB")
    nodes = plan.nodes(QUERIES[name](spark, SF))
    assert plan.count(nodes, "BroadcastHashJoin") >= 1
    merged = plan.count(nodes, "SortMergeJoinExec")
    assert plan.count(nodes, "SortMergeJoinExec", "LeftSemi") == merged
    assert (merged > 0) == semi_joins


def test_subset_ids_are_broadcast_to_the_ratings(spark):
    nodes = plan.nodes(QUERIES["ratings_of_subset"](spark, SF))
    assert plan.count(nodes, "BroadcastHashJoin") == 1
    assert plan.count(nodes, "ShuffleExchangeExec") == 0


@pytest.mark.parametrize("name", ["bayes_items_prior", "top10_titles", "subset_run"])
def test_ratings_are_read_once_without_adaptive_execution(spark, conf, name):
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    nodes = plan.nodes(QUERIES[name](spark, SF))
    assert ratings_scans(nodes) == 1
    assert plan.count(nodes, "ReusedExchange") >= 1


def test_deep_page_sorts_only_rows_near_it(spark, conf):
    """No exchange of whole rows: the rounds count, and what is left is one top-k."""
    conf(autoBroadcastJoinThreshold="-1")
    df = spark.range(0, 40_000, 1, 8).selectExpr("id", "CAST(id % 977 AS double) AS score", "repeat('x', 50) AS text")
    found = paging.deep_page(df, (("score", True), ("id", False)), 20, 25_000, few=1000)
    nodes = plan.nodes(found)
    assert plan.count(nodes, "TakeOrderedAndProject") == 1
    assert plan.count(nodes, "ShuffleExchange", "range") == 0 and plan.count(nodes, "RDDScan") == 0
    # The two bounds of the last round stand in the filter; what passes them is little more than the page.
    passed = df.where("true").count(), found.count()
    assert passed == (40_000, 20)
