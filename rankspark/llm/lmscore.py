"""Cross-entropy difference: how much better a target model than a background model predicts.

Both are bigram models with absolute discounting, counted alike over all texts of their side:
the target's documents, and all others.  They share one vocabulary, the words that occur more
than once, and one table of bigrams, all of them; other words are one unknown word.  That holds
at every size.  Words and bigrams are named by 64 bits.

Texts are kept in chunks of some 2^19 words, as packed arrays.  Three times, for words, for bigrams and
for first words, each chunk sends each different name once, with its own counts, to the part of
the names that it falls into.  There, in the same task, a part's names, whose number does not grow
with the corpus, are added up and each chunk gets the sums of those that it sent, so that names
are made, sorted and shuffled once.  A part's names are a range of hashes, so no name makes a part
hot: a name that stands in every text comes once a chunk.  No task or driver ever holds the model.
Chunks meet their answers by shares, so that the disk holds the shuffles of one share only; tables
that nothing will read again are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankspark.llm import words as W
from rankspark.llm.tables import dropped, stored

DISCOUNT = 0.75
#: Names of the unknown word and of the start of a text.
UNKNOWN, START = 0, 1
#: Words of the corpus for one part of the names.
PART_WORDS = 1 << 21
#: Words and texts of a chunk, about: rows by chunk and part are few and large.
CHUNK_WORDS = 1 << 19
#: Shares of the chunks that meet their answers one after another: so many at every size.
SHARES = 2
#: What a row by part does: add its counts (kept in sums), add and ask, or ask only.
_ADDS, _BOTH, _ASKS = 0, 1, 2
_BUFFER = 1 << 21  # names that a task adds up at once
_BATCH_BYTES = 1 << 22
_SIDES = ("t", "b")

# Every table has rows of packed arrays: texts (kind 0), and by part requests, sums (kind 0) and answers (kind 1).
_ROWS = "chunk long, kind int, part int, n long, data array<binary>"
_TYPES = {"chunk": pa.int64(), "kind": pa.int32(), "part": pa.int32(), "n": pa.int64(), "data": pa.list_(pa.binary())}
_Row = tuple[int, int, int, int, list[bytes]]
_Arrays = list[np.ndarray]


def _pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers, not negative: all lowest bytes, then all next ones, as many as the largest needs.

    Of ``rising`` numbers the steps are packed, and the first of all; how it was done comes last.
    """
    values, first = values.astype(np.uint64), b""
    if rising:
        first = values[:1].tobytes()
        values = np.diff(values, prepend=values[:1])
    size = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return values.view(np.uint8).reshape(-1, 8).T[:size].tobytes() + first + bytes([size + len(first)])


def _unpack(data: bytes) -> np.ndarray:
    size, rising = (data[-1] - 8, True) if data[-1] > 8 else (data[-1], False)
    n = (len(data) - 1 - 8 * rising) // size
    out = np.zeros((n, 8), np.uint8)
    out.T[:size] = np.frombuffer(data, np.uint8, n * size).reshape(size, n)
    out = out.view(np.uint64).ravel()
    if rising:
        out[0] = np.frombuffer(data[-9:-1], np.uint64)[0]
        out = np.cumsum(out, dtype=np.uint64)
    return out


def _counts(data: bytes) -> np.ndarray:
    return _unpack(data).view(np.int64)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[_Row]:
    for batch in batches:
        *heads, data = batch.columns
        for i, head in enumerate(zip(*(x.to_pylist() for x in heads), strict=True)):
            yield *head, data[i].as_py()


def _write(rows: Iterator[_Row]) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        columns = [pa.array(x, t) for x, t in zip(zip(*waiting, strict=True), _TYPES.values(), strict=True)]
        return pa.RecordBatch.from_arrays(columns, list(_TYPES))

    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += sum(map(len, row[4]))
        if size > _BATCH_BYTES:
            yield batch()
            waiting, size = [], 0
    if waiting:
        yield batch()


def _mapped(rows: DataFrame, step: Callable[[Iterator[_Row]], Iterator[_Row]]) -> DataFrame:
    return rows.mapInArrow(lambda batches: _write(step(_read(batches))), _ROWS)


def _sided(docs: DataFrame, target: DataFrame | None) -> DataFrame:
    """doc_id, text, and whether it is one of the target's."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if target is None:
        return own.withColumn("target", F.lit(False))
    key = F.coalesce("doc_id", F.xxhash64("text"))  # texts without id are spread
    marks = target.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("key")).distinct()
    # The marks grow with the corpus, so they are joined alike at every size, never broadcast.
    marked = marks.withColumn("marked", F.lit(True)).hint("merge")
    own = own.withColumn("key", key).join(marked, "key", "left")
    return own.select("doc_id", "text", (F.col("marked").isNotNull() & F.col("doc_id").isNotNull()).alias("target"))


def _texts(sided: DataFrame) -> DataFrame:
    """Chunks of texts: see ``_Texts``."""

    def chunk(held: list[_Arrays]) -> _Row:
        row, words, *texts = (np.concatenate(x) for x in zip(*held, strict=True))
        names, tokens = np.unique(words, return_inverse=True)
        return int(row[0]), 0, 0, len(tokens), [_pack(names, True), *map(_pack, (tokens, *texts))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[_Row]:
        held, size = [], 0
        for batch in batches:
            ids, target, rows = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()
            doc_ids, no_id = ids.fill_null(0).to_numpy().view(np.uint64), ids.is_null().to_numpy(zero_copy_only=False)
            for c in W.chunks(batch.column(1), W.PLAIN, lower=True):
                own = slice(c.row, c.row + len(c))
                held.append([rows[own], c.names(), np.diff(c.first), target[own], doc_ids[own], no_id[own]])
                size += len(c.start) + len(c)
                if size >= CHUNK_WORDS:
                    yield chunk(held)
                    held, size = [], 0
        if held:
            yield chunk(held)

    numbered = sided.select("doc_id", "text", "target", F.monotonically_increasing_id().alias("row"))
    return _stored(numbered.mapInArrow(lambda batches: _write(run(batches)), _ROWS), "lm-texts")


class _Texts:
    """One chunk: its different names, sorted, its tokens as places among them, and its texts.

    As stored first, names are words; then they begin with the unknown word and the start, and
    have counts of either side; at last there are counts of each token's bigram and of first words.
    """

    def __init__(self, data: list[bytes]) -> None:
        self.data = data
        self.names, (self.tokens, self.n) = _unpack(data[0]), map(_counts, data[1:3])
        self.target = _counts(data[3]).astype(bool)
        self.side = np.repeat(self.target, self.n)
        self.row = np.repeat(np.arange(len(self.n)), self.n)

    def by_side(self, place: np.ndarray, size: int) -> _Arrays:
        return [np.bincount(place[own], minlength=size) for own in (self.side, ~self.side)]

    def words(self) -> tuple[np.ndarray, _Arrays]:
        return self.names, self.by_side(self.tokens, len(self.names))

    def before(self) -> np.ndarray:
        out = np.ones_like(self.tokens)  # the start's place
        out[1:] = self.tokens[:-1]
        out[(np.cumsum(self.n) - self.n)[self.n > 0]] = START
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names of the different bigrams, sorted, the places of their first words, and each token's place among them."""
        code, place = np.unique(self.before() * len(self.names) + self.tokens, return_inverse=True)
        first, word = np.divmod(code, max(1, len(self.names)))
        names = pair_names(self.names[first], self.names[word])
        order = np.argsort(names)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        return names[order], first[order], rank[place]

    def pairs(self) -> tuple[np.ndarray, _Arrays]:
        size = max(1, len(self.names))
        code = np.sort((self.before() * size + self.tokens) * 2 + self.side)
        if not len(code):
            return code.view(np.uint64), [code, code]
        start = np.flatnonzero(np.append(True, code[1:] >> 1 != code[:-1] >> 1))
        n, target = np.diff(np.append(start, len(code))), np.add.reduceat(code & 1, start)
        first, word = np.divmod(code[start] >> 1, size)
        names = pair_names(self.names[first], self.names[word])
        order = np.argsort(names)
        return names[order], [target[order], (n - target)[order]]

    def firsts(self) -> tuple[np.ndarray, _Arrays]:
        return self.names, [_counts(x) for x in self.data[10:14]]


def pair_names(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(W.mix(first) + word) + np.uint64(0x9E3779B97F4A7C15))


def _part(names: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of names, so sorted names are in the order of their parts."""
    return ((names >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _requests(texts: DataFrame, what: Callable, parts: int, kind: int = _BOTH) -> DataFrame:
    """Each chunk's names and counts, by part; a row that only asks has no counts."""

    def run(rows: Iterator[_Row]) -> Iterator[_Row]:
        for chunk, _, _, _, data in rows:
            names, values = what(_Texts(data))
            values = [np.zeros_like(x) for x in values] if kind == _ASKS else values
            found, at = np.unique(_part(names, parts), return_index=True)
            ends = np.append(at, len(names))[1:]
            for p, a, b in zip(found.tolist(), at.tolist(), ends.tolist(), strict=True):
                yield chunk, kind, p, b - a, [_pack(names[a:b], True), *[_pack(x[a:b]) for x in values]]

    return _mapped(texts, run)


def _batches(rows: Iterator[_Row], size: int) -> Iterator[list[_Row]]:
    """Rows together that have some ``size`` names."""
    held, waiting = [], 0
    for row in rows:
        held.append(row)
        waiting += row[3]
        if waiting > size:
            yield held
            held, waiting = [], 0
    if held:
        yield held


def _sorted(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of names, and where in it each different one starts."""
    order = np.argsort(names)
    ordered = names[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(names)])


def _added(parts_of: list[_Arrays]) -> _Arrays:
    """Names, sorted, with the sums of their counts."""
    names, *values = (np.concatenate(x) for x in zip(*parts_of, strict=True))
    order, start = _sorted(names)
    return [names[order[start]], *[np.add.reduceat(x[order], start) for x in values]]


def _sums_before(total: _Arrays, names: np.ndarray) -> _Arrays:
    """Sums of names, zero for those that have none."""
    at = np.searchsorted(total[0], names)
    at[np.append(total[0], np.uint64(0))[at] != names] = len(total[0])
    return [np.append(x, 0)[at] for x in total[1:]]


class _Batch:
    """Rows of one part: the sums of their counts, and each one's places among the different names."""

    def __init__(self, rows: list[_Row]) -> None:
        self.heads = [row[:4] for row in rows]
        names, *self.counts = (np.concatenate([_counts(x) for x in column]) for column in zip(*map(itemgetter(4), rows), strict=True))
        names = names.view(np.uint64)
        order, start = _sorted(names)
        self.place = np.empty(len(order), np.int32)
        self.place[order] = np.repeat(np.arange(len(start), dtype=np.int32), np.diff(np.append(start, len(order))))
        self.sums = [names[order[start]], *[np.add.reduceat(x[order], start) for x in self.counts]]

    def met(self, total: _Arrays | None) -> list[np.ndarray]:
        """For each count, whether this row is the one of the part that has the name first above zero."""
        found = []
        for k, counts in enumerate(self.counts):
            some = np.flatnonzero(counts)
            one = np.full(len(self.sums[0]), -1)
            one[self.place[some]] = some
            if total is not None:
                one[_sums_before(total, self.sums[0])[k] > 0] = -1
            own = np.zeros(len(counts), bool)
            own[one[one >= 0]] = True
            found.append(own)
        return found


def _met(rows: DataFrame, parts: int, sums: bool = False, own: bool = False) -> DataFrame:
    """For each row that asks, the sums of its names over all rows that add, zero for names that have none.

    ``own``: then, for each count, whether this chunk is the one that stands for the name.
    ``sums``: one more row a part, its names with their sums.
    """

    def run(rows: Iterator[_Row]) -> Iterator[_Row]:
        for part, of_part in groupby(rows, itemgetter(2)):
            total, waiting = None, []
            for found in _batches(of_part, _BUFFER):
                batch = _Batch(found)
                flags = batch.met(total) if own else []
                total = batch.sums if total is None else _added([total, batch.sums])
                waiting.append((batch.heads, batch.sums[0], batch.place, flags))
            if sums:
                yield 0, 0, part, len(total[0]), [_pack(total[0], True), *map(_pack, total[1:])]
            for heads, names, place, flags in waiting:
                at = np.searchsorted(total[0], names) if len(names) < len(total[0]) else np.arange(len(names))
                columns = [*[x[at][place] for x in total[1:]], *flags]
                ends = np.cumsum([n for *_, n in heads]).tolist()
                for (chunk, kind, _, n), b in zip(heads, ends, strict=True):
                    if kind != _ADDS:
                        yield chunk, 1, part, n, [_pack(x[b - n : b]) for x in columns]

    return _mapped(rows.repartition(parts, "part").sortWithinPartitions("part"), run)


def _share(rows: DataFrame, number: int) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64("chunk"), F.lit(SHARES)) == number)


def _answered(texts: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """The chunks' rows, each followed by its answers: to be put together by ``_together``."""
    rows = texts.unionAll(answers.where("kind = 1")).repartition(parts, "chunk")
    return rows.sortWithinPartitions("chunk", "kind", "part")


def _together(rows: Iterator[_Row], width: int) -> Iterator[_Row]:
    """The chunks' rows with their answers at the end of their arrays."""
    for _, (row, *found) in groupby(rows, itemgetter(0)):
        columns = zip(*map(itemgetter(4), found), strict=True) if found else [()] * width
        yield *row[:4], [*row[4], *[_pack(np.concatenate([np.zeros(0, np.uint64), *map(_unpack, x)])) for x in columns]]


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, tables)


def _stored(rows: DataFrame, name: str) -> DataFrame:
    return stored(rows, name, compression="zstd")


def _changed(answered: DataFrame, width: int, change: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    def run(rows: Iterator[_Row]) -> Iterator[_Row]:
        for *head, data in _together(rows, width):
            yield *head, change(data)

    return _mapped(answered, run)


def _given(met: DataFrame) -> DataFrame:
    return met.where("kind = 0")


@dataclass
class Model:
    """Stored sums by part of the names: of words, and of first words; and the models' own chunks."""

    docs: DataFrame
    parts: int
    words: DataFrame  # counts of target and background
    totals: dict[str, int]  # of words on either side, of rare ones, and how many words count (size)
    firsts: DataFrame | None = None  # counts as first words, and numbers of different words after them
    texts: list[DataFrame] | None = None  # by shares
    answers: DataFrame | None = None  # of first words to the models' own chunks

    def named(self, texts: DataFrame, answers: DataFrame) -> list[DataFrame]:
        """Chunks in words that count, with the counts of these, by shares.  Their table, not in use any more, goes."""
        rare = [self.totals[f"rare_{s}"] for s in _SIDES]

        def change(data: list[bytes]) -> list[bytes]:
            names, counts = _unpack(data[0]), [_counts(x) for x in data[6:8]]
            known = counts[0] + counts[1] > 1
            place = np.where(known, np.cumsum(known) + 1, UNKNOWN)
            names = np.append(np.array([UNKNOWN, START], np.uint64), names[known])
            counts = [np.append([r, 0], x[known]) for r, x in zip(rare, counts, strict=True)]
            tokens = place[_counts(data[1])]
            return [_pack(names, True), _pack(tokens), *data[2:6], *[_pack(x) for x in counts]]

        shares = []
        for k in range(SHARES):
            rows = _answered(_share(texts, k), _share(answers, k), self.parts)
            shares.append(_stored(_changed(rows, 2, change), "lm-named"))
        dropped(texts)
        return shares

    def linked(self, texts: list[DataFrame], counted: list[DataFrame]) -> list[DataFrame]:
        """Chunks with the counts that their bigrams have in ``counted``, and with what they add to first words.

        The tables of ``texts`` go.
        """

        def change(data: list[bytes]) -> list[bytes]:
            chunk, own = _Texts(data), [_counts(x).astype(bool) for x in data[10:12]]
            _, first, place = chunk.links()
            size = len(chunk.names)
            values = [*chunk.by_side(chunk.before(), size), *[np.bincount(first[x], minlength=size) for x in own]]
            return [*data[:8], *[_pack(_counts(x)[place]) for x in data[8:10]], *[_pack(x) for x in values]]

        asked = _requests(_union(texts), _Texts.pairs, self.parts, _BOTH if texts is counted else _ASKS)
        if texts is not counted:
            asked = asked.unionAll(_requests(_union(counted), _Texts.pairs, self.parts, _ADDS))
        answers = _stored(_met(asked, self.parts, own=True), "lm-answers")
        shares = []
        for k, share in enumerate(texts):
            rows = _answered(share, _share(answers, k), self.parts)
            shares.append(_stored(_changed(rows, 4, change), "lm-linked"))
            dropped(share)
        dropped(answers)
        return shares

    @property
    def pairs(self) -> DataFrame:
        """Bigrams with their counts, of which no table is kept."""
        return _given(_met(_requests(_union(self.texts), _Texts.pairs, self.parts, _ADDS), self.parts, sums=True))

    def chunks(self, docs: DataFrame) -> tuple[list[DataFrame], DataFrame]:
        """By shares, and the answers of first words to them."""
        if docs is self.docs:
            return self.texts, self.answers
        raw = _texts(_sided(docs, None))
        asked = self.words.unionAll(_requests(raw, _Texts.words, self.parts, _ASKS))
        answers = _stored(_met(asked, self.parts), "lm-answers")
        texts = self.linked(self.named(raw, answers), self.texts)
        dropped(answers)
        asked = self.firsts.unionAll(_requests(_union(texts), _Texts.firsts, self.parts, _ASKS))
        return texts, _stored(_met(asked, self.parts), "lm-answers")


def _totals(words: DataFrame) -> dict[str, int]:
    names = [*_SIDES, *[f"rare_{s}" for s in _SIDES], "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, data in _read(batches):
            t, b = map(_counts, data[1:])
            rare = t + b == 1
            sums = [t.sum(), b.sum(), t[rare].sum(), b[rare].sum(), (~rare).sum()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in sums], names)

    rows = words.mapInArrow(run, ", ".join(f"{x} long" for x in names))
    return rows.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in names]).first().asDict()


def fit(docs: DataFrame, target: DataFrame) -> Model:
    """Models of the documents (doc_id, text) named in ``target`` (doc_id), and of all others."""
    raw = _texts(_sided(docs, target))
    parts = 1 + raw.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // PART_WORDS
    answers = _stored(_met(_requests(raw, _Texts.words, parts), parts, sums=True), "lm-words")
    model = Model(docs, parts, _given(answers), _totals(_given(answers)))
    named = model.named(raw, answers)
    model.texts = model.linked(named, named)
    model.answers = _stored(_met(_requests(_union(model.texts), _Texts.firsts, parts), parts, sums=True), "lm-firsts")
    model.firsts = _given(model.answers)
    return model


_LOSSES = {"doc_id": pa.int64(), "n": pa.int64(), "loss_t": pa.float64(), "loss_b": pa.float64()}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens, target_loss, background_loss, difference.

    Losses are means over the tokens, in nats; the lower the difference, the more a text is
    like the target.  Tokens are words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased.  A null
    text, or one without words, has 0 tokens and null losses.  One row per input row; an
    empty table gives none; other columns are ignored.  The models' own documents, given as
    the same DataFrame, are not read again.
    """
    totals = [model.totals[s] + model.totals["size"] + 1 for s in _SIDES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, data in _together(_read(batches), 4):
            chunk = _Texts(data)
            first, columns = chunk.before(), []
            for k in (0, 1):
                single, pair = _counts(data[6 + k]), _counts(data[8 + k])  # of words, of each token's bigram
                count, after = _counts(data[14 + k]), _counts(data[16 + k])  # of first words
                all_ = np.maximum(count, 1)
                rest = 1 - (count - DISCOUNT * after) / all_
                alone = (single + 1) / totals[k]
                loss = -np.log(np.maximum(pair - DISCOUNT, 0) / all_[first] + rest[first] * alone[chunk.tokens])
                # Without any words, bincount gives whole numbers.
                columns.append(np.bincount(chunk.row, loss, len(chunk.n)).astype(float))
            ids = pa.array(_unpack(data[4]).view(np.int64), mask=_counts(data[5]).astype(bool))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(x) for x in (chunk.n, *columns)]], list(_LOSSES))

    texts, answers = model.chunks(docs)
    losses = []
    for k, share in enumerate(texts):
        whole = _answered(share, _share(answers, k), model.parts)
        found = whole.mapInArrow(run, "doc_id long, n long, loss_t double, loss_b double")
        losses.append(_stored(found, "lm-losses"))
    if answers is not model.answers:
        dropped(answers)
    rows = _union(losses)
    mean = {s: F.when(F.col("n") > 0, F.col(f"loss_{s}") / F.col("n")) for s in _SIDES}
    return rows.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        mean["t"].alias("target_loss"),
        mean["b"].alias("background_loss"),
        (mean["t"] - mean["b"]).alias("difference"),
    )


def good_documents(labels: DataFrame) -> DataFrame:
    """(doc_id) of the documents that all their labels call good and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    votes = labels.groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
    return votes.where("good").select("doc_id")
