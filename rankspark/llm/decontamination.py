"""Benchmark passages in documents, found by one Aho-Corasick automaton.

The automaton holds every window of the benchmark's normalised words, each word with a space
on both sides.  A document is normalised the same way and scanned once; a match is mapped
back over word numbers to the characters of the original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankspark.llm import words as W
from rankspark.llm.tables import stored

WINDOW = 10
#: Words of benchmark text per automaton (some 0.5 GB); a larger benchmark is scanned in blocks.
BLOCK_WORDS = 1_000_000

_automata: dict[str, tuple[ahocorasick.Automaton, list[int], list[list[int]]]] = {}


def _items(items: DataFrame, block: int, blocks: int) -> list[tuple[int, str]]:
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
    rows = items.where("text is not null and item_id is not null").where(part)
    return [(r[0], r[1]) for r in rows.select("item_id", "text").distinct().collect()]


def normalised(c: W.Chunk) -> tuple[str, np.ndarray]:
    """All words of a chunk of lower-cased text, one character per byte, and where each ends.

    A space stands before and after each word, and a line feed before each text.
    """
    length = c.end - c.start
    doc = np.repeat(np.arange(len(c)), np.diff(c.first))
    sums = np.concatenate([[0], np.cumsum(length)])
    at = sums[:-1] + np.arange(len(doc)) + 2 * (doc + 1)
    out = np.full(int(sums[-1]) + len(doc) + 2 * len(c), 0x20, np.uint8)
    within = np.arange(int(sums[-1])) - np.repeat(sums[:-1], length)
    out[np.repeat(at, length) + within] = c.data[np.repeat(c.start, length) + within]
    out[sums[c.first[:-1]] + c.first[:-1] + 2 * np.arange(len(c))] = 0x0A
    return out.tobytes().decode("latin-1"), at + length


def _windows(items: list[tuple[int, str]], size: int) -> dict[str, tuple[int, set[int]]]:
    """Pattern -> its number of words and the items that hold it."""
    found: dict[str, tuple[int, set[int]]] = {}
    for c in W.chunks(pa.array([text for _, text in items], pa.large_string()), W.ALNUM, lower=True):
        for i in range(len(c)):
            a, b = c.first[i], c.first[i + 1]
            own = [c.data[s:e].tobytes().decode("latin-1") for s, e in zip(c.start[a:b], c.end[a:b], strict=True)]
            for k in range(max(min(len(own), 1), len(own) - size + 1)):
                part = own[k : k + size]
                found.setdefault(f" {' '.join(part)} ", (len(part), set()))[1].add(items[c.row + i][0])
    return found


def _automaton(key: str, patterns: list[tuple[str, int, list[int]]]):
    """Built once for each Python worker."""
    if key not in _automata:
        _automata.clear()
        automaton = ahocorasick.Automaton()
        for number, (pattern, _, _) in enumerate(patterns):
            automaton.add_word(pattern, number)
        if patterns:
            automaton.make_automaton()
        _automata[key] = automaton, [n for _, n, _ in patterns], [ids for _, _, ids in patterns]
    return _automata[key]


_SPAN = "array<struct<start:int,end:int>>"


def _scan(docs: DataFrame, items: list[tuple[int, str]], window: int) -> DataFrame:
    """Adds n_words, n_hit, items and spans to the documents."""
    spark = docs.sparkSession
    patterns = [(p, n, sorted(ids)) for p, (n, ids) in sorted(_windows(items, window).items())]
    key = hashlib.sha256(repr(patterns).encode()).hexdigest()
    shipped = spark.sparkContext.broadcast(patterns)
    names = docs.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, sizes, owners = _automaton(key, shipped.value)
        for batch in batches:
            for c in W.chunks(batch.column(place), W.ALNUM, lower=True):
                n = np.diff(c.first)
                edge = np.zeros(len(c.start) + 1, np.int64)
                held: list[set[int]] = [set() for _ in range(len(c))]
                if sizes and len(c.start):
                    text, ends = normalised(c)
                    hits = list(automaton.iter(text))
                    pattern = np.array([p for _, p in hits], np.int64)
                    last = np.searchsorted(ends, np.array([e for e, _ in hits], np.int64))
                    size = np.array(sizes)[pattern]
                    np.add.at(edge, last + 1 - size, 1)
                    np.add.at(edge, last + 1, -1)
                    doc = np.searchsorted(c.first, last, "right") - 1
                    both = np.unique(np.stack([doc, pattern]), axis=1)
                    for d, p in both.T.tolist():
                        held[d].update(owners[p])
                hit = np.cumsum(edge[:-1]) > 0
                sums = np.concatenate([[0], np.cumsum(hit)])
                rows = slice(c.row, c.row + len(c))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i)[rows] for i in range(len(names))]
                    + [
                        pa.array(n),
                        pa.array(sums[c.first[1:]] - sums[c.first[:-1]]),
                        pa.array([sorted(x) for x in held], pa.list_(pa.int64())),
                        _spans(c, hit),
                    ],
                    [*names, "n_words", "n_hit", "items", "spans"],
                )

    schema = T.StructType([*docs.schema.fields])
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("items", "array<long>"), ("spans", _SPAN)):
        schema = schema.add(name, T.DataType.fromDDL(kind))
    return docs.mapInArrow(run, schema)


def _spans(c: W.Chunk, hit: np.ndarray) -> pa.ListArray:
    """Stretches of hit words as characters of the original texts."""
    doc = np.repeat(np.arange(len(c)), np.diff(c.first))
    starts, ends = hit.copy(), hit.copy()
    if len(hit):
        joined = hit[1:] & hit[:-1] & (doc[1:] == doc[:-1])
        starts[1:] &= ~joined
        ends[:-1] &= ~joined
    chars = np.concatenate([[0], np.cumsum((c.data & 0xC0) != 0x80)])
    own = doc[starts]
    base = chars[c.offset[:-1]][own]
    spans = pa.StructArray.from_arrays(
        [
            pa.array((chars[c.start[starts]] - base).astype(np.int32)),
            pa.array((chars[c.end[ends]] - base).astype(np.int32)),
        ],
        ["start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(len(c) + 1)).astype(np.int32)), spans)


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Documents with what they hold of benchmark items.

    Takes ``doc_id``, ``text`` and any other columns of ``docs``, ``item_id`` and ``text``
    of ``items``, and adds (or replaces) ``n_words``, ``n_hit`` (words inside an occurring
    window), ``items`` (sorted ids of items with an occurring window) and ``spans`` (the hit
    stretches, as characters of the original text).  A-Z count as a-z and words are
    `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`; an item of fewer words than a window is one
    window, one without words none.  Null texts have no words; items without id are left
    out; repeated rows count each for itself; an empty table on either side gives no hits.

    The items are sent to the workers, some ``block_words`` words at a time; a larger
    benchmark takes several scans, whose results are put together row by row.
    """
    added = ("n_words", "n_hit", "items", "spans")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(chars) // (6 * block_words)))
    out = _scan(docs, _items(items, 0, blocks), window)
    for block in range(1, blocks):  # each scan takes the rows of the one before
        rows = stored(out, "decontamination").withColumnsRenamed({c: f"__{c}" for c in added})
        out = _put_together(_scan(rows, _items(items, block, blocks), window)).select(*docs.columns, *added)
    return out


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


def _neighbours(a: Column, b: Column) -> Column:
    """Whether no word stands between the stretch ``a`` and ``b``, which starts after it does."""
    between = F.substring(F.col("text"), a["end"] + 1, b["start"] - a["end"])
    return (b["start"] <= a["end"]) | ~F.lower(between).rlike(_WORD)


def _put_together(rows: DataFrame) -> DataFrame:
    """Two scans of one document as one."""
    in_order = F.array_sort(F.concat("__spans", "spans"))
    start = F.struct(F.array().cast(_SPAN).alias("done"), F.lit(None).cast("struct<start:int,end:int>").alias("open"))

    def step(state, x):
        end = F.greatest(state["open"]["end"], x["end"])
        merged = F.struct(state["open"]["start"].alias("start"), end.alias("end"))
        return (
            F.when(state["open"].isNull(), F.struct(state["done"].alias("done"), x.alias("open")))
            .when(_neighbours(state["open"], x), F.struct(state["done"].alias("done"), merged.alias("open")))
            .otherwise(F.struct(F.concat(state["done"], F.array(state["open"])).alias("done"), x.alias("open")))
        )

    spans = F.aggregate(
        in_order, start, step, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"])))
    )
    rows = rows.withColumns({"items": F.array_sort(F.array_union("__items", "items")), "spans": spans})
    words = F.aggregate(
        "spans",
        F.lit(0).cast("long"),
        lambda n, s: n
        + F.regexp_count(
            F.lower(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])),
            F.lit(_WORD + "+"),
        ),
    )
    return rows.withColumn("n_hit", words)
