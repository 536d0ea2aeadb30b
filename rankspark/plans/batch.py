"""The batch run: read, rate, rank, publish.

    spark-submit --py-files rankspark.zip job.py --input hdfs:///in --output hdfs:///out \
        --prior items --m 50 --min-ratings 50 --top-n 1000

where ``job.py`` calls ``main()``.

The ratings are read once.  Their per-item statistics are written to a table, which has one
row per item; the prior, both result tables and the report come from it.  In a folder the
statistics are kept beside the result tables, so that a later run can add its ratings to them,
and all tables of a run become visible at once (``sinks.versions``).
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from rankspark.operators.scores import existing_only, score_items
from rankspark.operators.serving import BY_SCORE, top_titles
from rankspark.operators.paging import top_n
from rankspark.operators.stats import PRIORS, item_stats, merge_stats
from rankspark.operators.tables import item_table, recommendation_table, refreshed_items, with_audit
from rankspark.runtime import new_folder
from rankspark.schemas import ITEMS, RECOMMENDATIONS, STATISTICS, Table
from rankspark.sinks.jdbc import CONNECTIONS, clear_tables, write_jdbc
from rankspark.sinks.stored import refuse_stored
from rankspark.sinks.versions import Publication
from rankspark.sources import (
    JdbcTarget,
    accepted,
    item_subset,
    ratings_of,
    read_items,
    read_ratings,
    read_published,
    rejected,
)

# Parameters of the two standard runs.
ALL_ITEMS_WEIGHT = 10
TOP_RATED_MINIMUM = 50
TOP_RATED_SIZE = 1000


@dataclass(frozen=True)
class JobConfig:
    """What to compute; where to read and write is given to ``run`` apart."""

    prior: str = "ratings"
    m: float = ALL_ITEMS_WEIGHT
    min_ratings: int | None = None
    top_n: int | None = None
    item_limit: int | None = None
    popularity: str = "mean"

    def __post_init__(self) -> None:
        if self.prior not in PRIORS:
            raise ValueError(f"unknown prior {self.prior!r}; known: {', '.join(PRIORS)}")
        if self.m < 0:
            raise ValueError("m must not be negative")

    @classmethod
    def all_items(cls, item_limit: int | None = None) -> JobConfig:
        """Score every rated item against the mean of all ratings."""
        return cls(item_limit=item_limit, popularity="zero")

    @classmethod
    def top_rated(
        cls, min_ratings: int = TOP_RATED_MINIMUM, n: int = TOP_RATED_SIZE
    ) -> JobConfig:
        """Best n well-supported items against the mean of the item means."""
        return cls(prior="items", m=min_ratings, min_ratings=min_ratings, top_n=n)


RUNS: dict[str, Callable[[], JobConfig]] = {
    "all-items": JobConfig.all_items,
    "top-rated": JobConfig.top_rated,
}


def restrict(
    items: DataFrame, ratings: DataFrame, config: JobConfig
) -> tuple[DataFrame, DataFrame]:
    """Cut both inputs down to the first items; this also changes the prior."""
    if not config.item_limit:
        return items, ratings
    items = item_subset(items, config.item_limit)
    return items, ratings_of(ratings, items)


def recommend(
    items: DataFrame, stats: DataFrame, config: JobConfig, stored: DataFrame | None = None
) -> DataFrame:
    """movie_id, avg_rating, rating_count and recommendation_score of the chosen items.

    Without a threshold only rated items are scored, if they are in the ``stored`` item
    table (the input items, if none is given).  With one, the whole item
    table is tested against it, so a threshold of 0 lets unrated items in.
    """
    if config.min_ratings is None:
        known = items if stored is None else stored
        scored = existing_only(score_items(stats, stats, config.prior, config.m), known)
    else:
        scored = score_items(
            item_table(items, stats), stats, config.prior, config.m, config.min_ratings
        )
    scored = scored.select("movie_id", "avg_rating", "rating_count", "recommendation_score")
    return scored if config.top_n is None else top_n(scored, BY_SCORE, config.top_n)


def build(
    items: DataFrame, ratings: DataFrame, config: JobConfig, run_ts: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both result tables as one lazy plan that reads the ratings once per table."""
    items, ratings = restrict(items, ratings, config)
    stats = item_stats(ratings)
    scores = recommend(items, stats, config)
    return (
        with_audit(item_table(items, stats), run_ts),
        recommendation_table(scores, run_ts, config.popularity),
    )


def written_stats(stats: DataFrame) -> DataFrame:
    """The item statistics as a table in the shared folder: later steps read that."""
    spark = stats.sparkSession
    path = new_folder(spark, "item-stats")
    stats.write.parquet(path)
    return spark.read.schema(stats.schema).parquet(path)


class Sink:
    """Where a run's tables go.  By default every run stands for itself and is final as written."""

    def begin(self, spark: SparkSession, run_id: str | None) -> dict[str, int] | None:
        """Called first; the totals of the run with this id, if it was published before."""

    def stored(self, table: Table) -> DataFrame | None:
        """What a run adds to, or None if it starts anew."""

    def write(self, df: DataFrame, table: Table) -> DataFrame | None:
        """Write a table; returns it as it is stored then, if it can be read back."""
        raise NotImplementedError

    def __call__(self, df: DataFrame, table: Table) -> DataFrame | None:
        return self.write(df, table)

    def statistics(self, stats: DataFrame) -> DataFrame:
        """Store the item statistics, from which all else is computed."""
        return written_stats(stats)

    def publish(self, totals: dict[str, int]) -> None:
        """Called last, with all tables written."""


def run(
    items: DataFrame,
    ratings: DataFrame,
    config: JobConfig,
    sink: Sink,
    run_ts: Column | None = None,
    run_id: str | None = None,
) -> dict[str, int]:
    """Write the tables to ``sink``, items first, and publish them; returns the totals.

    Where the sink has stored tables to add to, ``items`` and ``ratings`` are new ones: the
    statistics of the new ratings are added to the stored ones, and both tables follow from the
    sums, for all items.  Ratings of earlier runs are not read again.  Items that are stored
    already are refused.

    A ``run_id`` that the sink has published before does nothing and returns what it returned
    then, so a run that may or may not have come to its end can be repeated.

    The row totals of the tables are observed by the writes themselves, in tasks
    whose results count once even if an executor is lost and they run again.  Rows
    without an item id, such as malformed CSV lines, are counted on the way.
    """
    done = sink.begin(items.sparkSession, run_id)
    if done is not None:
        return done
    items, ratings = restrict(items, ratings, config)
    earlier, known = sink.stored(STATISTICS), sink.stored(ITEMS)
    if known is not None:
        refuse_stored(items, known, ITEMS)
    stats = item_stats(ratings)
    stats = sink.statistics(stats if earlier is None else merge_stats(earlier, stats))
    observed, no_id = {}, F.col("movie_id").isNull()

    def publish(frame: DataFrame, table: Table) -> DataFrame | None:
        observed[table] = Observation(table.name)
        rows = F.count(F.lit(1)).alias("rows")
        without_id = F.count_if(no_id).alias("without_id")
        return sink.write(frame.observe(observed[table], rows, without_id), table)

    if known is None:
        stored = publish(with_audit(item_table(items, stats), run_ts), ITEMS)
    else:
        stored = publish(refreshed_items(known, items, stats, run_ts), ITEMS)
        items = stored
    scores = recommend(items, stats, config, stored)
    publish(recommendation_table(scores, run_ts, config.popularity), RECOMMENDATIONS)
    written = {table: _values(observation) for table, observation in observed.items()}
    sums = stats.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("ratings"),
        F.coalesce(F.sum(F.when(no_id, F.col("row_count"))), F.lit(0)).alias("without_id"),
        F.count(F.lit(1)).alias("items"),
    ).first()
    totals = {
        "total_movies": written[ITEMS]["rows"],
        "total_ratings": sums["ratings"],
        "movies_with_stats": sums["items"],
        "recommendations_generated": written[RECOMMENDATIONS]["rows"],
        "movies_without_id": written[ITEMS]["without_id"],
        "ratings_without_id": sums["without_id"],
    }
    sink.publish(totals)
    return totals


def _values(observation: Observation) -> dict[str, int]:
    """What a write has counted; Spark has no values if it needed no task."""
    try:
        return observation.get
    except Py4JJavaError:
        return {"rows": 0, "without_id": 0}


class FolderSink(Sink):
    """Versioned tables in a folder, which readers see together once the run is published."""

    def __init__(self, base: str, append: bool = False) -> None:
        self.base, self.append = base, append

    def begin(self, spark: SparkSession, run_id: str | None) -> dict[str, int] | None:
        self.publication = Publication(spark, self.base, run_id, self.append)
        return self.publication.done

    def stored(self, table: Table) -> DataFrame | None:
        return self.publication.stored(table) if self.append else None

    def write(self, df: DataFrame, table: Table) -> DataFrame:
        return self.publication.write(df, table)

    def statistics(self, stats: DataFrame) -> DataFrame:
        stored = self.publication.write(stats, STATISTICS)
        return stored.withColumn("avg_rating", F.try_divide("rating_sum", "rating_count"))

    def publish(self, totals: dict[str, int]) -> None:
        self.publication.publish(totals)


class DatabaseSink(Sink):
    """A database; unless appending, both tables are emptied before the first load.

    ``settings`` are those of ``sinks.jdbc.write_jdbc``.
    """

    def __init__(self, spark: SparkSession, target: JdbcTarget, append: bool = False, **settings) -> None:
        self.spark, self.target, self.settings = spark, target, settings
        self.cleared = append

    def write(self, df: DataFrame, table: Table) -> None:
        if not self.cleared:
            clear_tables(self.spark, self.target, **self.settings)
            self.cleared = True
        write_jdbc(df, self.target, table, "append", **self.settings)


def to_folder(base: str, mode: str = "overwrite") -> FolderSink:
    """Replace the tables of a folder, or add new items and ratings to them (``append``)."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    return FolderSink(base, mode == "append")


def to_database(spark: SparkSession, target: JdbcTarget, append: bool = False, **settings) -> DatabaseSink:
    return DatabaseSink(spark, target, append, **settings)


def keep_rejected(checked: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Write the lines of a checked scan that do not fit, as a table of their own.

    Returns the rows that do fit, and how many lines did not; the write counts them.
    """
    observed = Observation("rejected")
    lines = rejected(checked).observe(observed, F.count(F.lit(1)).alias("rows"), F.lit(0).alias("without_id"))
    lines.write.mode("overwrite").parquet(path)
    return accepted(checked), _values(observed)["rows"]


def preview(recommendations: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """The best n with what is known of their items, to be shown on the console."""
    return top_titles(recommendations.select("movie_id", "recommendation_score"), items, n).select(
        "title", "genres", "avg_rating", "rating_count", "recommendation_score"
    )


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rankspark", description="Rate and rank items.")
    parser.add_argument("--input", required=True, help="folder with movies.csv and ratings.csv")
    parser.add_argument("--infer", action="store_true", help="infer the CSV types")
    parser.add_argument("--rejects", help="folder for lines that do not fit, which then do not count")
    sink = parser.add_mutually_exclusive_group(required=True)
    sink.add_argument("--output", help="folder for the result tables")
    sink.add_argument("--jdbc-url", help="database for the result tables")
    parser.add_argument(
        "--jdbc-option", action="append", default=[], metavar="KEY=VALUE",
        help="driver option, such as user=...; may be repeated",
    )
    parser.add_argument(
        "--append", action="store_true", help="add new items and ratings to the tables that are there"
    )
    parser.add_argument("--run-id", help="a run of this id that is published already is not repeated")
    parser.add_argument("--item-table", default=ITEMS.name, help="its name in the database")
    parser.add_argument("--score-table", default=RECOMMENDATIONS.name)
    parser.add_argument("--connections", type=int, default=CONNECTIONS, help="most database writers at once")
    parser.add_argument(
        "--run", choices=sorted(RUNS), default="all-items",
        help="standard run, whose settings the options below change one by one",
    )
    parser.add_argument("--prior", choices=sorted(PRIORS))
    parser.add_argument("--m", type=float)
    parser.add_argument("--min-ratings", type=int)
    parser.add_argument("--top-n", type=int)
    parser.add_argument("--item-limit", type=int, help="development run on the first items")
    parser.add_argument("--popularity", choices=("mean", "zero"))
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None) -> None:
    args = parse(arguments)
    names = ("prior", "m", "min_ratings", "top_n", "item_limit", "popularity")
    given = {name: getattr(args, name) for name in names if getattr(args, name) is not None}
    config = replace(RUNS[args.run](), **given)
    spark = SparkSession.builder.appName("rankspark").getOrCreate()
    try:
        if args.output:
            sink = to_folder(args.output, "append" if args.append else "overwrite")
        else:
            options = dict(o.split("=", 1) for o in args.jdbc_option)
            sink = to_database(
                spark,
                JdbcTarget(args.jdbc_url, options),
                args.append,
                names={ITEMS.name: args.item_table, RECOMMENDATIONS.name: args.score_table},
                connections=args.connections,
            )
        items = read_items(spark, args.input, args.infer, bool(args.rejects))
        ratings = read_ratings(spark, args.input, args.infer, bool(args.rejects))
        refused = {}
        if args.rejects:
            items, refused["rejected_item_lines"] = keep_rejected(items, f"{args.rejects}/movies")
            ratings, refused["rejected_rating_lines"] = keep_rejected(ratings, f"{args.rejects}/ratings")
        totals = run(
            items,
            ratings,
            config,
            sink,
            F.lit(dt.datetime.now(dt.timezone.utc)),
            args.run_id,
        )
        for name, value in (totals | refused).items():
            print(f"{name}: {value:,}")
        if args.output:
            stored = read_published(spark, args.output, RECOMMENDATIONS, ITEMS)
            preview(*stored).show(truncate=False)
    finally:
        spark.stop()


