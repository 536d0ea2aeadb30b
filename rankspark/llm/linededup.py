"""Lines that stand in many documents, dropped from all of them; built-in functions only.

How many documents hold a line is kept in levelled sorted runs.  A run is a table of line
hashes with their numbers of documents, bucketed and sorted by hash.  Each new batch of
documents is counted, leaves out by a merging anti-join the lines that a run knows to be
frequent already, and adds its own run.  Whenever two runs of one level meet, they are merged
into one of the next level, so that b batches leave log2(b) runs, and a line is written
log2(b) times at most.  All runs have the same buckets: merging them and testing a batch
against them moves no row of a run over the network.

Hashes have 128 bits.  A text is never shuffled but once, to meet the places of its dropped lines.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankspark.llm.tables import stored
from rankspark.runtime import new_folder

#: Documents that must hold a line for it to go, and its least length without outer white space.
THRESHOLD = 10
MIN_LENGTH = 1
#: Batches that `drop_frequent_lines` deals a whole table into.
BATCHES = 4
#: Shares into which the rows of every line are dealt when they meet the frequent lines.
SALTS = 16

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


def _lower(line: Column) -> Column:
    """A-Z as a-z.  ``lower`` is the faster way, and the same for plain ASCII."""
    ascii_ = F.octet_length(line) == F.length(line)
    return F.when(ascii_, F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))


def line_keys(text: Column) -> Column:
    """The key of each line: lower-cased (A-Z), without white space at both ends."""
    return F.transform(F.split(text, "\n", -1), lambda line: _lower(F.btrim(line, F.lit(_SPACE))))


def _hashes(keys: Column, min_length: int) -> Column:
    """Hashes and place of each line, in order of hash; ``first`` tells equal lines apart."""

    def named(key: Column, place: Column) -> Column:
        h1, h2 = F.xxhash64(key), F.xxhash64(F.lit(13), key)
        return F.struct(h1.alias("h1"), h2.alias("h2"), place.alias("place"), F.length(key).alias("length"))

    def marked(ordered: Column) -> Column:
        def mark(x: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)
            new = (before["h1"] != x["h1"]) | (before["h2"] != x["h2"])
            return F.struct(*[x[c].alias(c) for c in (*_HASH, "place")], F.coalesce(new, F.lit(True)).alias("first"))

        return F.transform(ordered, mark)

    long_enough = F.filter(F.transform(keys, named), lambda x: x["length"] >= min_length)
    # Bound to a name: written out in the lambda, it would be sorted anew for each element.
    return F.element_at(F.transform(F.array(F.sort_array(long_enough)), marked), 1)


def _document() -> list[Column]:
    """A document by its id and text: equal ones lose the same lines."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(13), "doc_id", "text").alias("k2")]


def hashed_lines(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """The lines of each row: document (k1, k2), hash (h1, h2), place from 0, whether it is the first."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*_document(), F.inline(_hashes(line_keys(text), min_length)))


@dataclass(frozen=True)
class Run:
    name: str
    level: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


class LineRuns:
    """Numbers of documents by line, over all batches so far.  Use as a context manager.

    The tables lie in the shared folder; their names leave the catalog at the end.
    """

    def __init__(self, spark: SparkSession, threshold: int = THRESHOLD, min_length: int = MIN_LENGTH) -> None:
        if threshold < 1 or min_length < 1:
            raise ValueError("threshold and min_length must be positive")
        self.spark, self.threshold, self.min_length = spark, threshold, min_length
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[Run] = []
        self._names: list[str] = []

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *_: object) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.runs, self._names = [], []

    def _write(self, rows: DataFrame, level: int) -> Run:
        run = Run(f"line_run_{uuid.uuid4().hex}", level)
        writer = rows.select(*_HASH, "n").write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH)
        self._names.append(run.name)
        writer.option("path", new_folder(self.spark, "line-run")).saveAsTable(run.name)
        return run

    def add(self, docs: DataFrame) -> None:
        """A batch of documents with ``text``; a document stands in one batch only."""
        lines = hashed_lines(docs, self.min_length).where("first")
        self.add_counts(lines.groupBy(*_HASH).agg(F.count(F.lit(1)).alias("n")))

    def add_counts(self, counts: DataFrame) -> None:
        """The numbers ``n`` of documents of a batch, one row per hash."""
        new = counts.select(*_HASH, "n")
        for run in self.runs:
            known = run.rows(self.spark).where(F.col("n") >= self.threshold).select(*_HASH)
            new = new.join(known.hint("merge"), _HASH, "left_anti")
        run = self._write(new, 0)
        while self.runs and self.runs[-1].level == run.level:
            run = self._merged(self.runs.pop(), run)
        self.runs.append(run)

    def _merged(self, a: Run, b: Run) -> Run:
        left = a.rows(self.spark).withColumnRenamed("n", "m")
        both = left.join(b.rows(self.spark).hint("merge"), _HASH, "full")
        n = F.coalesce("m", F.lit(0)) + F.coalesce("n", F.lit(0))
        return self._write(both.select(*_HASH, n.alias("n")), a.level + 1)

    def frequent(self) -> DataFrame:
        """h1 and h2 of the lines that at least ``threshold`` documents hold."""
        rows = self.spark.createDataFrame([], "h1 long, h2 long, n long")
        for run in self.runs:
            rows = rows.unionByName(run.rows(self.spark))
        return rows.groupBy(*_HASH).agg(F.sum("n").alias("n")).where(F.col("n") >= self.threshold).select(*_HASH)


def _places(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(k1, k2) -> the places of the lines to drop.

    A frequent line may stand in a third of all documents, so its rows are dealt into
    shares by document, and each frequent line stands in every share.
    """
    rows = lines.select("k1", "k2", *_HASH, "place", F.pmod("k1", F.lit(SALTS).cast("long")).alias("share"))
    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("share")
    found = rows.join(frequent.select(*_HASH, shares).hint("merge"), [*_HASH, "share"])
    return found.groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))


def drop_lines(docs: DataFrame, lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """The documents without those of their ``lines`` that are ``frequent`` (h1, h2)."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    places = stored(_places(lines, frequent), "line-places")
    # The row as one column, so that its names cannot meet those used here.
    rows = docs.select(*_document(), F.struct(*names).alias("row")).join(places, ["k1", "k2"], "left")
    # Through a generator, as Catalyst would copy the lines into every expression that uses them.
    lines = F.inline(F.array(F.struct(F.split(F.coalesce("row.text", F.lit("")), "\n", -1).alias("lines"))))
    rows = rows.select("row", "places", lines).select("row", "lines", F.inline(F.array(_left("lines", "places"))))
    columns = [F.col("left" if c == "text" else f"row.`{c}`").alias(c) for c in names]
    n_lines = F.size("lines").cast("long")
    return rows.select(*columns, n_lines.alias("n_lines"), (n_lines - F.col("n_left")).alias("n_dropped"))


def _left(lines: str, places: str) -> Column:
    """The text and the number of the lines at other places."""
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_except(every, F.coalesce(places, F.array().cast("array<int>")))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    return F.struct(text.alias("left"), F.size(kept).cast("long").alias("n_left"))


def drop_frequent_lines(
    docs: DataFrame, threshold: int = THRESHOLD, min_length: int = MIN_LENGTH, batches: int = BATCHES
) -> DataFrame:
    """(doc_id, text, ...) -> the same rows without the lines that many of them hold.

    A line's key is the line without white space `[\\x20\\x09-\\x0D]` at both ends, A-Z as a-z;
    lines whose key has at least ``min_length`` characters and stands in at least ``threshold``
    documents go from every document, the others stay as they are.  Adds (or replaces) the
    columns ``n_lines`` (before) and ``n_dropped``, of long; other columns pass unchanged.

    A null or empty text is one empty line, which is never dropped; its text becomes empty.  Each
    row counts as a document, also repeated ones and those with null ids.  A document holds a
    line once, however often it stands there.  An empty table gives no rows.
    """
    lines = stored(hashed_lines(docs, min_length), "lines")
    batch = F.pmod("k1", F.lit(batches)).cast("int").alias("batch")
    counts = lines.where("first").groupBy(*_HASH, batch).agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts.select(*_HASH, "n", "batch"), "line-counts", ["batch"])
    with LineRuns(docs.sparkSession, threshold, min_length) as runs:
        for number in range(batches):
            runs.add_counts(counts.where(F.col("batch") == number))
        frequent = stored(runs.frequent(), "line-frequent")
    return drop_lines(docs, lines, frequent)
