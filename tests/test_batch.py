"""The batch run end to end, and invariants over generated ratings."""

import datetime as dt
import os
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rankspark import sinks
from rankspark.operators.stats import item_stats, ratings_prior
from rankspark.plans import batch
from rankspark.plans.batch import JobConfig
from rankspark.schemas import ITEMS, RECOMMENDATIONS
from rankspark.sources import read_items, read_ratings, read_stored

STAMP = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc)


def test_csv_to_parquet(spark, micro, tmp_path):
    items, ratings = micro
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    sinks.write_items_csv(items, source)
    sinks.write_ratings_csv(ratings.withColumn("timestamp", F.lit(0)), source)
    for _ in range(2):  # a rerun ends in the same state
        totals = batch.run(
            read_items(spark, source),
            read_ratings(spark, source),
            JobConfig.top_rated(1, 1),
            batch.to_folder(target),
            F.lit(STAMP),
        )
        assert totals == {
            "total_movies": 3,
            "total_ratings": 4,
            "movies_with_stats": 2,
            "recommendations_generated": 1,
            "movies_without_id": 0,
            "ratings_without_id": 0,
        }
    stored = read_stored(spark, target, ITEMS)
    assert {r["movie_id"]: r["year"] for r in stored.collect()} == {1: 1995, 2: None, 3: None}
    best = read_stored(spark, target, RECOMMENDATIONS)
    row = best.first()
    assert round(row["recommendation_score"], 6) == 4.458333
    assert round(row["popularity_score"], 6) == 4.666667
    shown = batch.preview(best, stored)
    assert shown.columns == ["title", "genres", "avg_rating", "rating_count", "recommendation_score"]
    assert [(r["title"], r["rating_count"]) for r in shown.collect()] == [("Toy Story (1995)", 3)]


def test_append_refuses_stored_items(spark, micro, tmp_path):
    items, ratings = micro
    write = batch.to_folder(str(tmp_path), "append")
    batch.run(items.where("movie_id = 1"), ratings, JobConfig.all_items(), write, F.lit(STAMP))
    with pytest.raises(ValueError, match="stored already"):
        batch.run(items, ratings, JobConfig.all_items(), write, F.lit(STAMP))
    assert read_stored(spark, str(tmp_path), ITEMS).count() == 1


def test_appending_run_scores_items_of_an_earlier_one(spark, micro, tmp_path):
    items, ratings = micro
    write = batch.to_folder(str(tmp_path), "append")
    batch.run(items.where("movie_id = 1"), ratings.limit(0), JobConfig.all_items(), write, F.lit(STAMP))
    batch.run(items.where("movie_id > 1"), ratings, JobConfig.all_items(), write, F.lit(STAMP))
    assert read_stored(spark, str(tmp_path), ITEMS).count() == 3
    scored = read_stored(spark, str(tmp_path), RECOMMENDATIONS).collect()
    assert sorted(r["movie_id"] for r in scored) == [1, 2]


@pytest.mark.parametrize("config", [JobConfig.all_items(), JobConfig.top_rated(1, 5)])
def test_run_without_ratings(spark, micro, tmp_path, config):
    items, ratings = micro
    totals = batch.run(items, ratings.limit(0), config, batch.to_folder(str(tmp_path)))
    assert totals == {
        "total_movies": 3,
        "total_ratings": 0,
        "movies_with_stats": 0,
        "recommendations_generated": 0,
        "movies_without_id": 0,
        "ratings_without_id": 0,
    }


def test_malformed_lines_are_counted(spark, tmp_path):
    (tmp_path / "movies.csv").write_text("movieId,title,genres\n1,A,x\nbad,B,y\n")
    (tmp_path / "ratings.csv").write_text(
        "userId,movieId,rating,timestamp\n1,1,4,0\n1,?,2,0\n2,?,x,0\n"
    )
    totals = batch.run(
        read_items(spark, str(tmp_path)),
        read_ratings(spark, str(tmp_path)),
        JobConfig.all_items(),
        batch.to_folder(str(tmp_path / "out")),
    )
    assert (totals["movies_without_id"], totals["ratings_without_id"]) == (1, 2)
    assert (totals["total_movies"], totals["total_ratings"]) == (2, 3)
    score = read_stored(spark, str(tmp_path / "out"), RECOMMENDATIONS).first()
    assert score["recommendation_score"] == pytest.approx((4 + 10 * 3) / 11)


def test_command_line(spark, micro, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "movies.csv").write_text('movieId,title,genres\n1,"A, B (1999)",x|y\n2,C,\n')
    (source / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,1,4.5,7\n2,1,3.5,8\n")
    root = Path(__file__).resolve().parents[1]
    settings = (
        "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2"
        f" --conf spark.checkpoint.dir={tmp_path / 'shared'} pyspark-shell"
    )
    done = subprocess.run(
        [sys.executable, "job.py", "--input", str(source), "--output", str(target)],
        cwd=root,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": settings},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr
    assert "total_movies: 2" in done.stdout and "recommendations_generated: 1" in done.stdout
    assert "A, B (1999)" in done.stdout
    row = read_stored(spark, str(target), ITEMS).filter("movie_id = 1").first()
    assert (row["year"], row["avg_rating"], row["rating_count"]) == (1999, 4.0, 2)


def test_standard_runs():
    everything = JobConfig.all_items()
    assert (everything.prior, everything.m, everything.min_ratings, everything.top_n) == (
        "ratings", 10, None, None,
    )
    best = JobConfig.top_rated()
    assert (best.prior, best.m, best.min_ratings, best.top_n) == ("items", 50, 50, 1000)
    with pytest.raises(ValueError):
        JobConfig(m=-1)


def test_arguments():
    args = batch.parse(["--input", "in", "--output", "out", "--prior", "items", "--top-n", "5"])
    assert (args.input, args.output, args.prior, args.top_n, args.run) == ("in", "out", "items", 5, "all-items")
    assert batch.RUNS["top-rated"]() == JobConfig.top_rated()
    with pytest.raises(SystemExit):
        batch.parse(["--input", "in"])
    with pytest.raises(SystemExit):
        batch.parse(["--input", "in", "--output", "o", "--jdbc-url", "u"])


half_stars = st.integers(1, 10).map(lambda n: n / 2)
rating_lists = st.lists(
    st.tuples(st.integers(1, 6), st.one_of(st.none(), half_stars)), min_size=1, max_size=60
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=rating_lists, m=st.integers(0, 20))
def test_scores_match_brute_force(spark, rows, m):
    ratings = spark.createDataFrame(rows, "movie_id bigint, rating double")
    items = spark.range(1, 6).selectExpr("id AS movie_id", "'t' AS title", "'g' AS genres")
    by_item = defaultdict(list)
    for item, rating in rows:
        by_item[item] += [] if rating is None else [rating]
    everything = [r for values in by_item.values() for r in values]
    prior = sum(everything) / len(everything) if everything else 3.0
    means = [sum(v) / len(v) for v in by_item.values() if v]

    stats = item_stats(ratings)
    assert ratings_prior(stats).first()["prior"] == pytest.approx(prior)
    scored = batch.recommend(items, stats, JobConfig(m=m)).collect()
    assert {r["movie_id"] for r in scored} == {i for i in by_item if i < 6}
    for r in scored:
        values = by_item[r["movie_id"]]
        if not values:
            assert r["recommendation_score"] is None
            continue
        n, mean = len(values), sum(values) / len(values)
        assert r["recommendation_score"] == pytest.approx((n * mean + m * prior) / (n + m))
        low, high = sorted((mean, prior))
        assert low - 1e-9 <= r["recommendation_score"] <= high + 1e-9

    chosen = batch.recommend(items, stats, JobConfig("items", m, 2, top_n=3)).collect()
    expected = {
        i: (sum(v) + m * sum(means) / len(means)) / (len(v) + m)
        for i, v in by_item.items()
        if i < 6 and len(v) >= 2
    }
    best = sorted(expected.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))[:3]
    assert sorted(round(r["recommendation_score"], 9) for r in chosen) == pytest.approx(
        sorted(round(s, 9) for _, s in best)
    )
