"""Published states: visible as a whole, once per run id, merged from parts."""

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from rankspark.plans import batch
from rankspark.plans.batch import JobConfig
from rankspark.schemas import ITEMS, RECOMMENDATIONS, STATISTICS
from rankspark.sinks import versions
from rankspark.sources import read_published, read_stored

ALL = JobConfig.all_items()


@pytest.fixture(autouse=True)
def stamps(spark):
    global STAMP, LATER
    STAMP, LATER = (F.lit(dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc)) for d in (30, 31))


class Killed(RuntimeError):
    pass


def killed_at(sink, table):
    """The sink of a run that dies while it writes the table."""
    write = sink.write

    def dying(df, t):
        if t is table:
            raise Killed
        return write(df, t)

    sink.write = dying
    return sink


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("table", [ITEMS, RECOMMENDATIONS])
@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_killed_run_leaves_the_old_pair(spark, micro, tmp_path, table, mode):
    items, ratings = micro
    base = str(tmp_path)
    batch.run(items.where("movie_id = 1"), ratings.where("movie_id = 1"), ALL, batch.to_folder(base), STAMP)
    before = [rows(df, "movie_id") for df in read_published(spark, base, ITEMS, RECOMMENDATIONS)]
    new = items.where("movie_id > 1"), ratings.where("movie_id > 1")
    with pytest.raises(Killed):
        batch.run(*new, ALL, killed_at(batch.to_folder(base, mode), table), LATER, "second")
    assert [rows(df, "movie_id") for df in read_published(spark, base, ITEMS, RECOMMENDATIONS)] == before
    # The same run id was not published, so the run can be sent again.
    batch.run(*new, ALL, batch.to_folder(base, mode), LATER, "second")
    stored, scores = read_published(spark, base, ITEMS, RECOMMENDATIONS)
    assert [r[0] for r in rows(stored, "movie_id")] == ([1, 2, 3] if mode == "append" else [2, 3])
    assert [r[0] for r in rows(scores, "movie_id")] == ([1, 2] if mode == "append" else [2])


def test_a_run_id_is_published_once(spark, micro, tmp_path):
    items, ratings = micro
    first = batch.run(items, ratings, ALL, batch.to_folder(str(tmp_path), "append"), STAMP, "a")
    again = batch.run(items, ratings, ALL, batch.to_folder(str(tmp_path), "append"), LATER, "a")
    assert first == again and first["total_ratings"] == 4
    manifest = versions.current(spark, str(tmp_path))
    assert manifest.version == 1 and manifest.runs == {"a": first}
    assert read_stored(spark, str(tmp_path), ITEMS).count() == 3
    assert rows(read_stored(spark, str(tmp_path), STATISTICS), "movie_id", "rating_count") == [(1, 3), (2, 1)]


def test_new_ratings_are_merged(spark, micro, tmp_path):
    items, ratings = micro
    base = str(tmp_path)
    batch.run(items, ratings.where("user_id = 1"), ALL, batch.to_folder(base, "append"), STAMP)
    totals = batch.run(items.limit(0), ratings.where("user_id > 1"), ALL, batch.to_folder(base, "append"), LATER)
    whole = str(tmp_path / "whole")
    assert totals == batch.run(items, ratings, ALL, batch.to_folder(whole), STAMP)
    for table in (STATISTICS, RECOMMENDATIONS):
        names = [c for c in table.column_names if not c.endswith("_at")]
        assert rows(read_stored(spark, base, table), *names) == rows(read_stored(spark, whole, table), *names)
    names = [c for c in ITEMS.column_names if not c.endswith("_at")]
    key = str  # rows hold nulls
    ours, theirs = (sorted(map(tuple, read_stored(spark, b, ITEMS).select(*names).collect()), key=key) for b in (base, whole))
    assert ours == theirs
    # Item 1 was rated again, items 2 and 3 were not.
    days = rows(read_stored(spark, base, ITEMS), "movie_id", F.day("created_at"), F.day("updated_at"))
    assert days == [(1, 30, 31), (2, 30, 30), (3, 30, 30)]


def test_merging_reads_no_rating_twice(spark, micro, tmp_path):
    items, ratings = micro
    source = str(tmp_path / "ratings")
    ratings.where("user_id = 1").write.parquet(source)
    base = str(tmp_path / "out")
    batch.run(items, spark.read.parquet(source), ALL, batch.to_folder(base, "append"), STAMP)
    for file in (tmp_path / "ratings").glob("*"):
        file.unlink()  # whoever reads the first ratings again fails
    batch.run(items.limit(0), ratings.where("user_id > 1"), ALL, batch.to_folder(base, "append"), LATER)
    assert rows(read_stored(spark, base, STATISTICS), "movie_id", "rating_count") == [(1, 3), (2, 1)]


def test_of_two_runs_from_one_state_the_first_wins(spark, micro, tmp_path):
    items, ratings = micro
    a, b = (versions.Publication(spark, str(tmp_path), name) for name in "ab")
    for publication in (a, b):
        publication.write(items.withColumns({"created_at": STAMP, "updated_at": STAMP}), ITEMS)
    a.publish({})
    with pytest.raises(versions.Conflict):
        b.publish({})
    assert set(versions.current(spark, str(tmp_path)).runs) == {"a"}


def test_readers_keep_their_state(spark, micro, tmp_path):
    items, ratings = micro
    base = str(tmp_path)
    batch.run(items, ratings, ALL, batch.to_folder(base), STAMP)
    stored, scores = read_published(spark, base, ITEMS, RECOMMENDATIONS)
    batch.run(items.where("movie_id = 2"), ratings, ALL, batch.to_folder(base), LATER)
    assert (stored.count(), scores.count()) == (3, 2)
    assert read_stored(spark, base, ITEMS).count() == 1


def test_a_manifest_that_was_not_finished_does_not_count(spark, micro, tmp_path):
    items, ratings = micro
    base = str(tmp_path)
    batch.run(items, ratings, ALL, batch.to_folder(base), STAMP, "a")
    (tmp_path / "_manifests" / "000000000002.json").write_text('{"tables": {"movies": ["mov')
    assert versions.current(spark, base).version == 1
    batch.run(items.limit(1), ratings, ALL, batch.to_folder(base), STAMP, "b")
    manifest = versions.current(spark, base)
    assert manifest.version == 3 and set(manifest.runs) == {"a", "b"}


def test_expired_folders_go(spark, micro, tmp_path):
    items, ratings = micro
    base = str(tmp_path)
    for number in range(3):
        batch.run(items, ratings, ALL, batch.to_folder(base), STAMP, str(number))
    with pytest.raises(Killed):
        batch.run(items, ratings, ALL, killed_at(batch.to_folder(base), RECOMMENDATIONS), STAMP)
    gone = versions.expire(spark, base)
    assert sorted(f.split("/")[0] for f in gone) == ["item_statistics"] * 2 + ["movies"] * 2 + ["recommendation_data"]
    assert read_stored(spark, base, ITEMS).count() == 3
    with pytest.raises(ValueError):
        versions.expire(spark, base, 0)


def test_manifest_names_what_is_there(spark, micro, tmp_path):
    items, ratings = micro
    batch.run(items, ratings, ALL, batch.to_folder(str(tmp_path)), STAMP, "x")
    text = json.loads((tmp_path / "_manifests" / "000000000001.json").read_text())
    assert set(text) == {"tables", "runs"} and set(text["tables"]) == {"movies", "recommendation_data", "item_statistics"}
    assert all((tmp_path / f).is_dir() for folders in text["tables"].values() for f in folders)
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "elsewhere"), ITEMS)


def test_reader_between_two_runs(spark, micro, tmp_path):
    """Pairs read while runs follow one another always fit together."""
    items, ratings = micro
    base = str(tmp_path)
    batch.run(items, ratings, ALL, batch.to_folder(base), STAMP)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            stored, scores = read_published(spark, base, ITEMS, RECOMMENDATIONS)
            seen.append((stored.count(), scores.count()))

    reader = threading.Thread(target=read)
    reader.start()
    for n in (1, 2, 3):
        batch.run(items.where(f"movie_id <= {n}"), ratings.where(f"movie_id <= {n}"), ALL, batch.to_folder(base), LATER)
    stop.set()
    reader.join()
    assert seen and set(seen) <= {(3, 2), (1, 1), (2, 2)}
