"""Result tables in versions: all tables of a run become visible at once, or none does.

A run writes its tables to folders of their own.  A manifest then names the folders that make
up each table, and the ids of all runs so far.  Manifests are numbered and never change; the
one with the highest number is the current state, and creating it is the commit.  Readers that
have resolved a manifest keep its folders, whatever later runs publish.

    movies/000000000002-5f0c.../part-*.parquet
    recommendation_data/000000000002-5f0c.../part-*.parquet
    _manifests/000000000002.json

A run that dies leaves folders that no manifest names, and the state before it.  A manifest is
created under its number only if that number is free, so of two runs that start from
one state only the first is published.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from rankspark.schemas import Table, conform

_MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Manifest:
    """A published state: folders by table, and the totals of each run by its id."""

    version: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    runs: dict[str, dict[str, int]] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Another run was published meanwhile."""


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join([parts[0].rstrip("/"), *parts[1:]]))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, base: str) -> list[int]:
    system, folder = _path(spark, base, _MANIFESTS)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _load(spark: SparkSession, base: str, number: int) -> Manifest | None:
    """A manifest, or None if its writer died within it: such a commit never happened."""
    system, path = _path(spark, base, _MANIFESTS, f"{number:012d}.json")
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Manifest(number, found["tables"], found["runs"])


def current(spark: SparkSession, base: str) -> Manifest | None:
    """The state published last, or None."""
    for number in reversed(_numbers(spark, base)):
        manifest = _load(spark, base, number)
        if manifest is not None:
            return manifest
    return None


def _create(spark: SparkSession, base: str, manifest: Manifest) -> None:
    system, path = _path(spark, base, _MANIFESTS, f"{manifest.version:012d}.json")
    text = json.dumps({"tables": manifest.tables, "runs": manifest.runs}, indent=1, sort_keys=True)
    try:
        stream = system.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):
            raise Conflict(f"{base}: version {manifest.version} was published by another run") from None
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read(spark: SparkSession, base: str, manifest: Manifest, table: Table) -> DataFrame | None:
    """A table of a published state, or None if it has none of that name."""
    folders = manifest.tables.get(table.name)
    if not folders:
        return None
    return spark.read.schema(table.ddl).parquet(*[f"{base.rstrip('/')}/{f}" for f in folders])


class Publication:
    """One run's tables, on top of the state that was current when it began.

    ``append`` keeps the state's tables that the run does not write itself; otherwise the run's
    tables are all there is afterwards.  A run id that the state names already was published:
    ``done`` holds its totals, and nothing is to be written again.
    """

    def __init__(self, spark: SparkSession, base: str, run_id: str | None = None, append: bool = False) -> None:
        self.spark, self.base, self.append = spark, base, append
        self.run_id = run_id or uuid.uuid4().hex
        numbers = _numbers(spark, base)
        self.state = current(spark, base) or Manifest()
        self.done = self.state.runs.get(self.run_id)
        # A number that a dead writer holds stays unused.
        self.number = max([self.state.version, *numbers]) + 1
        self.written: dict[str, list[str]] = {}

    def stored(self, table: Table) -> DataFrame | None:
        """A table as it was before this run."""
        return read(self.spark, self.base, self.state, table)

    def write(self, df: DataFrame, table: Table) -> DataFrame:
        folder = f"{table.name}/{self.number:012d}-{uuid.uuid4().hex}"
        conform(df, table).write.parquet(f"{self.base.rstrip('/')}/{folder}")
        self.written[table.name] = [folder]
        return read(self.spark, self.base, Manifest(self.number, self.written), table)

    def publish(self, totals: dict[str, int]) -> Manifest:
        """Make the tables visible, all at once."""
        kept = self.state.tables if self.append else {}
        runs = self.state.runs | {self.run_id: totals}
        manifest = Manifest(self.number, kept | self.written, runs)
        _create(self.spark, self.base, manifest)
        return manifest


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the last ``keep`` states names; returns them.

    Folders of runs that are still writing go as well, so call it when none is.
    """
    if keep < 1:
        raise ValueError("keep must be positive")
    numbers = _numbers(spark, base)
    states = [m for m in (_load(spark, base, n) for n in reversed(numbers)) if m is not None]
    named = {folder for state in states[:keep] for folders in state.tables.values() for folder in folders}
    gone = []
    for table in sorted({t for state in states for t in state.tables}):
        system, path = _path(spark, base, table)
        for status in system.listStatus(path) if system.exists(path) else []:
            folder = f"{table}/{status.getPath().getName()}"
            if folder not in named:
                system.delete(status.getPath(), True)
                gone.append(folder)
    return gone
