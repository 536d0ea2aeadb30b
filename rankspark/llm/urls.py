"""URL filter: rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rankspark.llm import words as W

GRAMS = (3, 4, 5)
BUCKETS = 1 << 18
#: Most rows of a labelled table that one fit may take.
LABELLED = 100_000
STEPS = 400
RIDGE = 1e-4

#: URLs to block and URLs to allow, from which the model is fitted.
BLOCKED = (
    "http://casino-royal.example.com/play/slots", "https://www.casino-bonus.example.net/win/now",
    "http://win-big-casino.example.org/jackpot", "https://casino.example.com/en/free-spins",
    "https://poker-win.example.net/lobby", "http://best-bets.example.com/odds",
    "http://sports-bets.example.org/free-bets/today", "https://free-spins.example.net/bonus",
    "https://m.free-bonus.example.com/bets", "http://cheap-meds.example.net/pills/order",
    "https://pills-online.example.com/cheap/viagra", "http://cheap-viagra.example.org/buy",
    "https://www.discount-pills.example.net/cart", "http://buy-cheap-pills.example.com/no-prescription",
    "http://adult-cams.example.com/live", "https://adult-video.example.net/xxx",
    "https://xxx-tube.example.org/adult", "http://adult-chat.example.com/x/en",
    "http://spam-mail.example.net/list", "https://link-farm.example.com/links/1",
    "https://seo-spam.example.org/farm", "http://content-farm.example.net/articles/spam",
    "http://ads.example.com/click?id=1", "https://ads-server.example.net/banner",
    "https://track.example.org/pixel.gif", "http://click-track.example.com/ads/redirect",
    "https://ad-track.example.net/beacon", "http://payday-loans.example.com/apply/now",
    "https://fast-loans.example.org/cash", "http://replica-watches.example.net/cheap",
    "http://m.casino-club.example.com/en/40.html", "https://blog.adult-club.example.net/de/66",
    "https://www.spam-blog.example.com/fr/90/", "http://www.link-farm.example.com/en/86?page=2",
    "https://www.cheap-loans.example.net/es/29", "https://m.ads-click.example.com/en/4#top",
    "http://blog.track-ads.example.org/de/31.html", "https://m.win-bets.example.net/fr/12",
    "http://www.pills-shop.example.com/en/7/", "https://blog.free-slots.example.org/es/53",
)
ALLOWED = (
    "https://www.library.example.org/en/catalogue", "http://news.example.com/world/2023/05",
    "https://blog.gardening.example.net/roses", "https://m.weather.example.com/today",
    "http://university.example.org/physics/lectures", "https://www.museum.example.net/visit",
    "http://recipes.example.com/soups/12", "https://docs.software.example.org/api/index.html",
    "https://blog.travel.example.com/fr/paris", "http://history.example.net/de/berlin",
    "https://www.science.example.org/journal/44", "http://music.example.com/es/albums",
    "https://books.example.net/en/reviews/825", "https://www.city.example.org/council",
    "http://school.example.com/teachers", "https://hospital.example.net/contact",
    "https://m.railways.example.com/timetable", "http://www.theatre.example.org/programme",
    "https://maths.example.net/en/theorems/770", "http://birds.example.com/nests",
    "https://blog.cooking.example.org/bread", "http://www.mountains.example.net/maps",
    "https://rivers.example.com/en/474.html", "https://www.painting.example.org/oil",
    "http://forum.example.net/threads/978", "https://wiki.example.com/history",
    "http://m.cinema.example.org/films", "https://www.farming-news.example.net/tractors",
    "https://blog.thorough.example.com/fr/65.html", "http://www.attention.example.net/en/17/",
    "http://thatched-roofs.example.net/es/94", "https://m.threading.example.com/en/3.html",
    "https://www.potatoes.example.com/de/86/", "http://blog.thistles.example.net/fr/32?page=2",
    "https://weathered.example.org/en/9#top", "http://www.inherited.example.com/es/70",
    "https://m.handwriting.example.net/de/15", "http://blog.whetstone.example.com/en/28/",
    "https://therein.example.org/fr/41.html", "http://www.fathering.example.net/en/60",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked)"""
    rows = [(u, True) for u in BLOCKED] + [(u, False) for u in ALLOWED]
    return spark.createDataFrame(rows, "url string, blocked boolean")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^[\s\S]*?://([^/?#]*)([^?#]*)"


def host(url: str = "url") -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end; else empty."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PARTS, 1)
    return F.translate(found, _UPPER, _LOWER)


def path(url: str = "url") -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PARTS, 2)


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host and its subdomains below a path; written `host/path`."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]

    def fits(self) -> Column:
        """A test on columns ``host`` and ``path``."""
        own = (F.col("host") == self.host) | F.col("host").endswith(f".{self.host}")
        return own & F.col("path").startswith(self.path)


def rule_of(rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as text, or null."""
    longest_first = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(*[F.when(r.fits(), F.lit(r.text)) for r in longest_first], F.lit(None).cast("string"))


# ---------------------------------------------------------------- model


def grams(texts: pa.Array, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every character n-gram, with a mark at either end of the text.

    Characters are Unicode code points; an n-gram is named by its UTF-8 bytes.
    """
    marked = [b"\x02" + t.encode() + b"\x03" if t else b"" for t in texts.to_pylist()]
    data = np.frombuffer(b"".join(marked), np.uint8)
    begins = (data & 0xC0) != 0x80  # bytes with which characters begin
    start = np.append(np.flatnonzero(begins), len(data))
    bound = np.cumsum([0, *map(len, marked)])
    length = np.diff(np.searchsorted(start, bound))
    row = np.repeat(np.arange(len(marked)), length)
    end = np.repeat(np.cumsum(length), length)
    at = np.arange(len(row))
    prefix = W.prefix_hashes(W.mix(data.astype(np.uint64) + np.uint64(salt << 8)))
    rows, buckets = [], []
    for n in GRAMS:
        ok = at + n <= end
        rows.append(row[ok])
        buckets.append((W.span_hash(prefix, start[at[ok]], start[at[ok] + n]) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(buckets)


@dataclass
class Features:
    """Sparse rows of n-gram counts, each row of length one."""

    n: int
    row: np.ndarray
    bucket: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, hosts: pa.Array, paths: pa.Array) -> Features:
        parts = [grams(hosts, 1), grams(paths, 2)]
        row, bucket = (np.concatenate(x) for x in zip(*parts, strict=True))
        key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
        row, bucket = np.divmod(key, BUCKETS)
        size = np.sqrt(np.bincount(row, count.astype(float) ** 2, len(hosts)))
        return cls(len(hosts), row, bucket, count / size[row])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.bucket] * self.value, self.n)

    def back(self, residuals: np.ndarray) -> np.ndarray:
        return np.bincount(self.bucket, residuals[self.row] * self.value, BUCKETS)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def blocks(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        """Whether the odds of a URL to be one to block are even or better."""
        return Features.of(hosts, paths).times(self.weights) + self.bias >= 0


def fit(labelled: DataFrame, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """Logistic regression by accelerated gradient steps over (url, blocked).

    The table must have at most ``LABELLED`` rows.  Rows without a label are left out; both
    labels weigh the same in all.  Without rows of both kinds the model allows everything.
    """
    rows = labelled.where("blocked is not null").select(
        host().alias("host"), path().alias("path"), F.col("blocked").cast("double").alias("y")
    )
    rows = rows.orderBy("host", "path", "y").limit(LABELLED + 1).toPandas()
    if len(rows) > LABELLED:
        raise ValueError(f"more than {LABELLED} labelled URLs")
    y = rows["y"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(BUCKETS), -1.0)
    x = Features.of(pa.array(rows["host"], pa.string()), pa.array(rows["path"], pa.string()))
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    weights, bias = np.zeros(BUCKETS), 0.0
    look, look_bias = weights, bias
    rate = 1 / (0.25 * 2 + ridge)  # the curvature is at most a quarter of |row|**2 + 1
    for step in range(steps):
        wrong = each * (1 / (1 + np.exp(-x.times(look) - look_bias)) - y)
        new = look - rate * (x.back(wrong) + ridge * look)
        new_bias = look_bias - rate * wrong.sum()
        pace = step / (step + 3)
        look, look_bias = new + pace * (new - weights), new_bias + pace * (new_bias - bias)
        weights, bias = new, new_bias
    return Model(weights, float(bias))


def judge(pages: DataFrame, model: Model, rules: Sequence[Rule] = ()) -> DataFrame:
    """(page_id, url) -> (page_id, host, path, rule, verdict), one row per input row.

    The longest rule that fits decides; where none does, the model.  A null url, or one
    without `://`, has an empty host and path, no rule and no n-grams, so that the model's
    bias decides.  Repeated rows are judged alike; other columns are ignored.
    """
    rows = pages.select("page_id", host().alias("host"), path().alias("path"))
    rows = rows.withColumn("rule", rule_of(rules))
    shipped = pages.sparkSession.sparkContext.broadcast(model)
    allowed = {r.text: r.allow for r in rules}
    schema = T.StructType([*rows.schema.fields]).add("verdict", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocked = shipped.value.blocks(batch.column(1), batch.column(2))
            allow = [allowed.get(r, not b) for r, b in zip(batch.column(3).to_pylist(), blocked, strict=True)]
            verdict = pa.array(["allow" if a else "block" for a in allow], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, verdict], [*batch.schema.names, "verdict"])

    return rows.mapInArrow(run, schema)
