"""Tables by item and by day: the rows of the plain table, and plans that move or read less."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rankspark.operators import facets, quality
from rankspark.operators.stats import item_stats
from rankspark.operators.tables import cascade_delete, item_table
from rankspark.sinks import layouts
from tests import plan
from tests.conftest import TESTDATA

SF = str(TESTDATA / "sf0.01")


@pytest.fixture
def ratings(spark):
    """A third of all rows on one item, some without an item."""
    item = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 500 END"
    return spark.range(9000).selectExpr("id AS user_id", f"CAST({item} AS long) AS movie_id", "CAST(id % 5 AS double) AS rating")


@pytest.fixture
def by_item(ratings, tmp_path):
    layout = layouts.write_by_item(ratings, str(tmp_path))
    yield layout
    layout.drop()


def rows(df):
    return sorted(map(str, df.collect()))


def test_same_rows_and_hot_items_apart(ratings, by_item):
    cold, hot = by_item.parts()
    assert [r[0] for r in hot.select("movie_id").distinct().collect()] == [7]
    assert cold.where("movie_id = 7").isEmpty()
    assert rows(by_item.frame()) == rows(ratings)


def test_no_hot_items_and_no_rows(spark, tmp_path):
    items = spark.range(100).selectExpr("id AS movie_id", "'t' AS title")
    for name, df in (("items", items), ("none", items.limit(0))):
        layout = layouts.write_by_item(df, str(tmp_path / name))
        assert layout.hot is None and rows(layout.frame()) == rows(df)
        layout.drop()


def scans_below_an_exchange(df, name):
    """Whether rows of the table's files meet a shuffle on their way to the next join or the result."""
    df.collect()
    found = []

    def visit(node, shuffled):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan(), shuffled)
        if kind.endswith("QueryStageExec"):
            return visit(node.plan(), shuffled)
        if kind == "FileSourceScanExec" and name in node.simpleString(10_000):
            found.append(shuffled)
        shuffled = shuffled or kind == "ShuffleExchangeExec"
        for child in plan._seq(node.children().toSeq()):
            visit(child, shuffled)

    visit(df._jdf.queryExecution().executedPlan(), False)
    return found


def test_bucketed_side_is_not_shuffled(spark, conf, ratings, by_item, tmp_path):
    conf(autoBroadcastJoinThreshold="-1")
    items = spark.range(400).selectExpr("id AS movie_id", "concat('t (19', id % 90 + 10, ')') AS title", "'g' AS genres")
    layout = layouts.write_by_item(items, str(tmp_path / "items"))
    cold = by_item.bucketed
    for df, table in (
        (quality.orphans(cold, items), by_item.name),
        (cascade_delete(cold, items.where("movie_id < 50")), by_item.name),
        (item_table(layout.bucketed, item_stats(ratings)), layout.name),
        (item_table(layout.bucketed, by_item.each(item_stats)), layout.name),
    ):
        found = scans_below_an_exchange(df, table)
        assert found == [False], table
    layout.drop()


def test_results_are_those_of_plain_tables(spark, ratings, by_item):
    items = spark.range(400).selectExpr("id AS movie_id", "'t' AS title", "'g' AS genres")
    assert rows(by_item.each(lambda p: quality.orphans(p, items))) == rows(quality.orphans(ratings, items))
    gone = items.where("movie_id < 50")
    assert rows(by_item.each(lambda p: cascade_delete(p, gone))) == rows(cascade_delete(ratings, gone))
    assert rows(by_item.each(item_stats)) == rows(item_stats(ratings))


def test_hot_item_is_still_split(spark, conf, by_item):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="2KB",
    )
    gone = spark.range(0, 400, 1, 4).selectExpr("id AS movie_id").where("movie_id <> 7")
    left = cascade_delete(by_item.parts()[1].repartition(8), gone)
    assert any(k == "SortMergeJoinExec" and "skew=true" in t for k, t in plan.nodes(left))


def test_date_filters_read_only_their_days(spark, tmp_path):
    rows_ = spark.range(400).selectExpr("id", "timestamp_ntz'2024-01-01 12:00:00' + make_interval(0, 0, 0, id % 60) AS ts")
    rows_ = rows_.unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS timestamp_ntz) AS ts"))
    layouts.write_by_day(rows_, str(tmp_path / "t"), "ts")
    table = layouts.read_by_day(spark, str(tmp_path / "t"), "id long, ts timestamp_ntz", "ts")
    assert table.count() == 401
    as_of = dt.date(2024, 1, 30)
    for bucket in ("today", "past_7_days", "this_month", "this_year"):
        found, wanted = (facets.facet_filter_date(df, "ts", bucket, as_of) for df in (table, rows_))
        assert found.columns == ["id", "ts"] and rows(found) == rows(wanted)
    scan = [t for k, t in plan.nodes(facets.facet_filter_date(table, "ts", "today", as_of)) if k == "FileSourceScanExec"]
    assert len(scan) == 1 and "PartitionFilters: [isnotnull(ts_day" in scan[0]


@pytest.mark.parametrize("name", ["facet_rows_by_day", "browse_datasets_by_day"])
def test_queries_by_day_filter_partitions(spark, name):
    scan = [t for k, t in plan.nodes(getattr(entry, name)(spark, SF)) if k == "FileSourceScanExec"]
    assert len(scan) == 1 and "_day" in scan[0].split("PartitionFilters: ")[1].split("]")[0]


def test_zone_of_the_reader(spark, conf, tmp_path):
    """Instants near midnight stay found where days were written in another zone."""
    instants = spark.range(72).select("id", (F.lit("2024-01-29 00:00:00").cast("timestamp") + F.make_interval(hours="id")).alias("ts"))
    layouts.write_by_day(instants, str(tmp_path / "t"), "ts")
    conf(session__timeZone="Asia/Tokyo")
    table = layouts.read_by_day(spark, str(tmp_path / "t"), "id long, ts timestamp", "ts")
    as_of = dt.date(2024, 1, 30)
    found, wanted = (facets.facet_filter_date(df, "ts", "today", as_of) for df in (table, instants))
    assert rows(found.select("id")) == rows(wanted.select("id"))
