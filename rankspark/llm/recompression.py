"""Repeated word sequences across documents, found by recompression.

Every document is parsed on its own, yet equal word sequences get equal symbols.  A symbol
is named by a 64-bit hash of the words it stands for, so that the names of all tasks agree
without a dictionary.  Each round replaces

* a run of one symbol by one symbol, and
* each pair of a *left* and a *right* symbol by one symbol; the side is a bit of the name,
  drawn anew each round, so pairs never overlap.

The words on which a decision rests are tracked: a symbol inside a window of ``window``
words whose deciding words lie inside too stands in every copy of the window.  A window is
filed under the least name of such symbols, the name being that of all deciding words, and
under its own words when it holds none (in runs, for one).  Equal windows are thus filed
under one name, and a document has a name for some five of its words.  The Spark rounds:

1. parse every document; count the names that stand in different texts (exact copies of a
   whole text fall to the one with the least id and take no further part);
2. send these names back to their documents; only windows filed under one are compared;
3. verify: the least document of each such window, by 96 bits of two hashes over its words;
4. remove the words of windows which start in a smaller document.

Both joins meet stored tables on plain shuffles, so adaptive execution can split the
partition of a name or window that a third of the documents share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from rankspark.llm import words as W
from rankspark.llm.tables import null_safe, stored

WINDOW = 13
ROUNDS = 3
_FAR = 1 << 40  # a decision that rests on the end of a text
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Symbols:
    """Symbols of a chunk: words start:end, deciding words low:high, name and document."""

    def __init__(self, names: np.ndarray, doc: np.ndarray) -> None:
        self.words = names
        self.start = np.arange(len(names))
        self.end = self.start + 1
        self.low, self.high = self.start.copy(), self.end.copy()
        self.name, self.doc = names, doc

    def _joined(self) -> np.ndarray:
        """At i: whether symbols i - 1 and i stand in one document."""
        out = np.zeros(len(self.name) + 1, bool)
        out[1:-1] = self.doc[1:] == self.doc[:-1]
        return out

    def runs(self) -> None:
        joined = self._joined()
        same = joined.copy()
        same[1:-1] &= self.name[1:] == self.name[:-1]
        a, b = np.flatnonzero(~same[:-1]), np.flatnonzero(~same[1:])
        before, after = np.maximum(a - 1, 0), np.minimum(b + 1, len(self.name) - 1)
        start, end = self.start[a], self.end[b]
        # Usually the next word alone shows that the neighbour is another symbol.
        word = self.words[np.maximum(start - 1, 0)] != self.words[self.end[a] - 1]
        left = np.where(joined[a], np.where(word, start - 1, self.low[before]), -_FAR)
        word = self.words[np.minimum(end, len(self.words) - 1)] != self.words[self.start[b]]
        right = np.where(joined[b + 1], np.where(word, end + 1, self.high[after]), _FAR)
        self.low, self.high = np.minimum(self.low[a], left), np.maximum(self.high[b], right)
        length = (b - a + 1).astype(np.uint64)
        run = W.mix(W.mix(self.name[a]) + length)
        self.name = np.where(length > 1, run, self.name[a])
        self.start, self.end, self.doc = start, end, self.doc[a]

    def pairs(self, round_: int) -> None:
        joined = self._joined()
        salt = W.mix(np.array([round_ + 1], np.uint64))
        left = (W.mix(self.name ^ salt) >> np.uint64(17)) & np.uint64(1) == 1
        head = np.zeros(len(left), bool)
        head[:-1] = left[:-1] & ~left[1:] & joined[1:-1]
        tail = np.zeros(len(left), bool)
        tail[1:] = head[:-1]
        low, high, end, name = self.low.copy(), self.high.copy(), self.end.copy(), self.name.copy()
        # A single left symbol rests on the next being left, a right one on the one before.
        i = np.flatnonzero(left & ~head)
        j, there = np.minimum(i + 1, len(left) - 1), joined[i + 1]
        low[i] = np.where(there, np.minimum(low[i], self.low[j]), low[i])
        high[i] = np.where(there, np.maximum(high[i], self.high[j]), _FAR)
        i = np.flatnonzero(~left & ~tail)
        j, there = np.maximum(i - 1, 0), joined[i]
        low[i] = np.where(there, np.minimum(low[i], self.low[j]), -_FAR)
        high[i] = np.where(there, np.maximum(high[i], self.high[j]), high[i])
        i = np.flatnonzero(head)
        low[i] = np.minimum(self.low[i], self.low[i + 1])
        high[i] = np.maximum(self.high[i], self.high[i + 1])
        end[i] = self.end[i + 1]
        name[i] = W.mix(W.mix(self.name[i]) ^ W.mix(self.name[i + 1] + np.uint64(1)))
        stay = ~tail
        self.start, self.end, self.doc = self.start[stay], end[stay], self.doc[stay]
        self.low, self.high, self.name = low[stay], high[stay], name[stay]


def window_keys(
    names: np.ndarray, first: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, key, document) of every window; equal windows have equal keys."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(names))
    at = at[at + window <= first[doc + 1]] if len(names) else at
    if not len(at):
        return at, np.zeros(0, np.uint64), at
    symbols = _Symbols(names, doc)
    for r in range(rounds):
        symbols.runs()
        symbols.pairs(r)
    prefix = W.prefix_hashes(names)
    use = (symbols.high - symbols.low <= window) & (symbols.end - symbols.start > 1)
    low, high = symbols.low[use], symbols.high[use]
    name = W.span_hash(prefix, low, high)
    best = np.full(len(names), _NONE)
    for back in range(window):
        seen = low - back >= np.maximum(high - window, 0)
        low, high, name = low[seen], high[seen], name[seen]
        np.minimum.at(best, low - back, name)
    key = best[at]
    alone = key == _NONE
    key[alone] = W.window_hash(names, window)[at[alone]]
    return at, key, doc[at]


def window_names(names: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 more bits that name the windows starting at the given words."""
    first = W.window_hash(names, window)[at]
    other = W.window_hash(W.mix(names + np.uint64(7)), window)[at]
    return first, (other >> np.uint64(32)).astype(np.uint32)


def _lists(doc: np.ndarray, n: int, values: np.ndarray) -> pa.ListArray:
    offsets = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _distinct(doc: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows without repeats, in the order of doc."""
    order = np.lexsort((*columns[::-1], doc))
    doc, columns = doc[order], tuple(x[order] for x in columns)
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return doc[new], *(x[new] for x in columns)


def _identified(docs: DataFrame) -> DataFrame:
    """Join keys of a row: its id, and a hash of its text for ids that occur repeatedly."""
    return docs.withColumns({"__did": null_safe("doc_id"), "__uid": F.xxhash64("text")})


_PARSED = "did long, uid long, n_words long, content long, content2 long, keys array<long>"


def _parse(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column(2), W.PLAIN):
                names, n = c.names(), len(c)
                _, key, doc = window_keys(names, c.first, window)
                doc, key = _distinct(doc, key)
                content, content2 = c.contents(names)
                rows = slice(c.row, c.row + n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows],
                        batch.column(1)[rows],
                        pa.array(np.diff(c.first)),
                        pa.array(content.view(np.int64)),
                        pa.array(content2.view(np.int64)),
                        _lists(doc, n, key),
                    ],
                    ["did", "uid", "n_words", "content", "content2", "keys"],
                )

    return _identified(docs).select("__did", "__uid", "text").mapInArrow(run, _PARSED)


_WINDOWS = "w long, w2 int, did long, uid long"


def _candidates(rows: DataFrame, window: int) -> DataFrame:
    """(did, uid, text, keys) -> each different window of a document filed under its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, uid = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(3)
            for c in W.chunks(batch.column(2), W.PLAIN):
                rows = slice(c.row, c.row + len(c))
                # Whether a key is shared is the same for all documents, so one set will do.
                shared = np.unique(lists[rows].flatten().to_numpy().view(np.uint64))
                names = c.names()
                at, key, doc = window_keys(names, c.first, window)
                hit = np.isin(key, shared)
                first, second = window_names(names, at[hit], window)
                doc, first, second = _distinct(doc[hit], first, second)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first.view(np.int64)),
                        pa.array(second.view(np.int32)),
                        pa.array(did[rows][doc]),
                        pa.array(uid[rows][doc]),
                    ],
                    ["w", "w2", "did", "uid"],
                )

    return rows.select("did", "uid", "text", "keys").mapInArrow(run, _WINDOWS)


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(did, uid, whole, windows): what each document repeats of smaller ones.

    ``whole`` marks a copy of a smaller document's words; ``windows`` holds the hashes of
    the repeated windows of all others.  Documents that repeat nothing are absent.
    """
    docs = docs.select("doc_id", "text")
    parsed = stored(_parse(docs, window), "repeats-parsed").where(F.col("n_words") >= window)
    content = ["content", "content2"]
    least = stored(parsed.groupBy(*content).agg(F.min("did").alias("least")), "repeats-contents")
    copies = parsed.select("did", "uid", *content).join(least, content).where("least < did")
    copies = stored(copies.select("did", "uid").distinct(), "repeats-copies")

    filed = parsed.select("did", "uid", "content", F.explode("keys").alias("key"))
    shared = (
        filed.groupBy("key")
        .agg(F.min("content").alias("a"), F.max("content").alias("b"))
        .where("a != b")
        .select("key")
    )
    shared = stored(shared, "repeats-keys")
    back = filed.select("did", "uid", "key").join(shared, "key")
    back = back.groupBy("did", "uid").agg(F.collect_set("key").alias("keys"))
    back = stored(back.join(copies, ["did", "uid"], "left_anti"), "repeats-filed")

    texts = _identified(docs).select(F.col("__did").alias("did"), F.col("__uid").alias("uid"), "text")
    windows = stored(_candidates(texts.join(back, ["did", "uid"]), window), "repeats-windows")
    first = windows.groupBy("w", "w2").agg(F.min("did").alias("least"), F.max("did").alias("most"))
    first = stored(first.where("least < most").select("w", "w2", "least"), "repeats-first")
    found = windows.join(first, ["w", "w2"]).where("least < did")
    found = found.groupBy("did", "uid").agg(F.collect_set("w").alias("windows"))
    whole = copies.select("did", "uid", F.lit(True).alias("whole"), F.array().cast("array<long>").alias("windows"))
    return stored(whole.unionByName(found.withColumn("whole", F.lit(False))), "repeats-found")


def _kept(c: W.Chunk, gone: np.ndarray, i: int, joined: bool) -> bytes:
    a, b = c.first[i], c.first[i + 1]
    base, size = c.offset[i], c.offset[i + 1] - c.offset[i]
    if not gone[a:b].any():
        text = c.text(i)
    else:
        starts = np.append(c.start[a:b], c.offset[i + 1]) - base
        spans = np.concatenate([[starts[0]], np.diff(starts)])  # what stands before, then each word
        stay = np.repeat(np.concatenate([[True], ~gone[a:b]]), spans)
        text = c.data[base : base + size][stay].tobytes().rstrip(b" \t\n\x0b\x0c\r")
    return b" ".join(text.split()) if joined else text


def remove_repeats(docs: DataFrame, window: int = WINDOW, joined: bool = False) -> DataFrame:
    """Documents without the words that a smaller document holds too, in a window of words.

    Takes ``doc_id`` and ``text`` and any other columns, and returns them with ``text`` cut
    and with ``n_words`` and ``n_removed`` (which replace columns of these names).  Words
    are `[^\\x20\\x09-\\x0D]+`, unchanged.  A word goes if it is in any window of ``window``
    words whose word sequence also starts in a document with a smaller ``doc_id``; windows
    are judged on the input.  The white space after a word goes with it; ``joined`` puts
    the words that stay apart by one space.

    A null text has no words and stays null (joined: empty); a row without doc_id counts as
    smaller than all others; rows with one id are not smaller than each other; texts of
    fewer words than a window stay as they are; an empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    docs = docs.select(*names)
    found = repeats(docs, window)
    right = found.select(
        F.col("did").alias("__did"), F.col("uid").alias("__uid"), F.col("whole").alias("__whole"),
        F.col("windows").alias("__windows"),
    )
    rows = _identified(docs).join(right, ["__did", "__uid"], "left").drop("__did", "__uid")
    place = names.index("text")
    text_type = pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(len(names)).fill_null(False).to_numpy(zero_copy_only=False)
            lists = batch.column(len(names) + 1)
            for c in W.chunks(batch.column(place), W.PLAIN):
                rows = slice(c.row, c.row + len(c))
                n = np.diff(c.first)
                gone = np.repeat(whole[rows], n)
                wanted = lists[rows].flatten().to_numpy().view(np.uint64)
                if len(wanted):
                    word_names = c.names()
                    last = np.repeat(c.first[1:], n)
                    at = np.flatnonzero(np.arange(len(word_names)) + window <= last)
                    hits, _ = window_names(word_names, at, window)
                    at = at[_within(hits, np.searchsorted(c.first, at, "right") - 1, lists[rows])]
                    edge = np.zeros(len(gone) + 1, np.int32)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    gone |= np.cumsum(edge[:-1]) > 0
                texts = [_kept(c, gone, i, joined).decode() for i in range(len(c))]
                text = pa.array(texts, text_type)
                if not joined:
                    text = pc.if_else(batch.column(place)[rows].is_null(), None, text)
                sums = np.concatenate([[0], np.cumsum(gone)])
                columns = [batch.column(i)[rows] for i in range(len(names))]
                columns[place] = text
                columns += [pa.array(n), pa.array(sums[c.first[1:]] - sums[c.first[:-1]])]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_removed"])

    schema = T.StructType([*docs.schema.fields])
    for name in ("n_words", "n_removed"):
        schema = schema.add(name, T.LongType())
    return rows.mapInArrow(run, schema)


def _within(values: np.ndarray, doc: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """Whether each value stands in the list of its document."""
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    member = lists.flatten().to_numpy().view(np.uint64)
    owner = np.repeat(np.arange(len(lists)), length).astype(np.uint64)
    # An unlucky sum would need two equal 64-bit values for different pairs.
    tagged = W.mix(member + W.mix(owner))
    return np.isin(W.mix(values + W.mix(doc.astype(np.uint64))), tagged)
