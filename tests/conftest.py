import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("rankspark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    old = {}

    def set_(**settings):
        for name, value in settings.items():
            key = "spark.sql." + name.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_
    for key, value in old.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="session")
def micro(spark):
    """Three items; item 1 rated 5, 5, 4, item 2 rated 3, item 3 unrated."""
    items = spark.createDataFrame(
        [(1, "Toy Story (1995)", "Comedy|Drama"), (2, "No year", "Sci-Fi|War"), (3, None, None)],
        "movie_id bigint, title string, genres string",
    )
    ratings = spark.createDataFrame(
        [(1, 1, 5.0), (2, 1, 5.0), (3, 1, 4.0), (1, 2, 3.0)],
        "user_id bigint, movie_id bigint, rating double",
    )
    return items, ratings
