"""JDBC reads and writes as far as they go without a database: options and order."""

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter, functions as F

from rankspark.plans.batch import JobConfig, run, to_database
from rankspark.schemas import ITEMS, RECOMMENDATIONS
from rankspark.sinks.jdbc import write_jdbc
from rankspark.sources import JdbcTarget, read_jdbc
from rankspark.sources.jdbc import Split

TARGET = JdbcTarget("jdbc:none://nowhere/db", {"user": "u", "password": "secret"})


class Calls(list):
    """Records writer calls; ``save`` runs the frame instead of connecting."""

    def install(self, monkeypatch):
        state = {}

        def remember(key):
            def method(writer, *args, **kwargs):
                state.setdefault(id(writer), {})[key] = kwargs or args[0]
                return writer

            return method

        def save(writer):
            settings = state.pop(id(writer))
            rows = writer._df.count()
            self.append((settings["mode"], settings["options"], writer._df.dtypes, rows))

        for name in ("format", "options", "mode"):
            monkeypatch.setattr(DataFrameWriter, name, remember(name))
        monkeypatch.setattr(DataFrameWriter, "save", save)
        return self

    @property
    def steps(self):
        return [(mode, options["dbtable"], rows) for mode, options, _, rows in self]


@pytest.fixture
def calls(monkeypatch):
    return Calls().install(monkeypatch)


@pytest.fixture
def frames(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "movie_id bigint, title string")
    scores = spark.createDataFrame([(1, 4.0)], "movie_id bigint, recommendation_score double")
    return items, scores


def load(frames, **settings):
    write = to_database(frames[0].sparkSession, TARGET, **settings)
    for frame, table in zip(frames, (ITEMS, RECOMMENDATIONS), strict=True):
        write(frame, table)


def test_password_is_not_printed():
    assert "secret" not in repr(TARGET)


def test_append_writes_parents_first(calls, frames):
    load(frames, append=True)
    assert calls.steps == [("append", "movies", 2), ("append", "recommendation_data", 1)]
    options = calls[0][1]
    assert options["url"] == TARGET.url and options["user"] == "u"
    assert options["numPartitions"] == "8"
    assert dict(calls[0][2])["movie_id"] == "int"


def test_overwrite_clears_children_first_and_keeps_keys(calls, frames):
    load(frames)
    assert calls.steps == [
        ("overwrite", "recommendation_data", 0),
        ("overwrite", "movies", 0),
        ("append", "movies", 2),
        ("append", "recommendation_data", 1),
    ]
    assert all(options["truncate"] == "true" for _, options, _, _ in calls)


def test_tuning_and_table_name(calls, frames):
    write_jdbc(frames[0], TARGET, ITEMS, "append", names={"movies": "other"}, connections=4, batch_size=500)
    options = calls[0][1]
    assert (options["dbtable"], options["numPartitions"], options["batchsize"]) == (
        "other", "4", "500",
    )


def test_batch_run_into_a_database(calls, spark, micro, monkeypatch, tmp_path):
    stats_writes = []

    def parquet(writer, path):
        stats_writes.append(path)

    stats = spark.createDataFrame(
        [(1, 14.0, 14 / 3, 3, 3), (2, 3.0, 3.0, 1, 1)],
        "movie_id bigint, rating_sum double, avg_rating double, rating_count bigint, row_count bigint",
    )
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    monkeypatch.setattr(DataFrameReader, "parquet", lambda reader, path: stats)
    totals = run(*micro, JobConfig(), to_database(spark, TARGET), F.current_timestamp())
    assert len(stats_writes) == 1
    assert [s[:2] for s in calls.steps] == [
        ("overwrite", RECOMMENDATIONS.name),
        ("overwrite", ITEMS.name),
        ("append", ITEMS.name),
        ("append", RECOMMENDATIONS.name),
    ]
    assert totals["total_ratings"] == 4 and totals["movies_with_stats"] == 2


def test_read_options(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "format", lambda r, f: seen.update(format=f) or r)
    monkeypatch.setattr(DataFrameReader, "options", lambda r, **o: seen.update(o) or r)
    monkeypatch.setattr(DataFrameReader, "load", lambda r: spark.range(3).toDF("movie_id"))
    df = read_jdbc(spark, TARGET, "movies", ["movie_id"], Split("movie_id", 1, 900, 8))
    assert df.columns == ["movie_id"]
    assert seen["format"] == "jdbc" and seen["dbtable"] == "movies"
    assert (seen["partitionColumn"], seen["lowerBound"], seen["upperBound"]) == ("movie_id", "1", "900")
    assert seen["numPartitions"] == "8"
