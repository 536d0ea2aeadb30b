"""Alignment of the tokens of two tokenizers on the same texts.

Tokens are sets of bytes.  The incidence matrices of tokens and bytes are kept in compressed
rows (CSR), built by hand: tokens x bytes of one tokenizer times bytes x tokens of the other, by
Gustavson's row products, has an entry for every two tokens that overlap.  Bytes at which both
tokenizers end a token cut the tokens into groups; incidence matrices of tokens and groups
give, by the same products, which tokens share a group.

Both tokenizers end a token before a space that follows something else than white space, and
what stands between two such places is tokenised alike in every text.  So a text is a list of
units, mostly words with the space before them, and each different unit is aligned once.

How often two ids are linked is counted over the corpus.  Looking that up for each text would
send most of the corpus through a shuffle, so texts are taken in chunks: a chunk asks once for
each different pair of ids in it, and its answers are summed by unit and text within one task.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rankspark.llm.tables import stored

#: Bytes of text that are cut into units at a time, and that make a chunk.
PIECE_BYTES = 1 << 20
CHUNK_BYTES = 1 << 22
#: Units, and bytes of them, that a worker remembers between chunks.
UNITS, UNIT_BYTES = 200_000, 1 << 23

#: Fixed value: bytes at which white space may end, in ASCII and in UTF-8.
_MAYBE_SPACE = rb"\x00-\x20\x80-\x8a\x85\x9f\xa0\xa8\xa9\xaf"
_CUT = re.compile(rb"(?<=[^" + _MAYBE_SPACE + rb"]) ")
_UNCUT = re.compile(rb"(?!)")
_BLANK = "▁"
#: Texts given to a tokenizer at once; what it returns is large.
_AT_ONCE = 4096


# ---------------------------------------------------------------- matrices


@dataclass(frozen=True)
class Csr:
    """A matrix of zeros and ones: the columns of row i are columns[first[i]:first[i + 1]]."""

    first: np.ndarray
    columns: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.first) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))


def tokens_by_bytes(length: np.ndarray) -> Csr:
    """Tokens that follow one another, by the bytes they hold."""
    first = np.concatenate([[0], np.cumsum(length)])
    return Csr(first, np.arange(first[-1]), int(first[-1]))


def transposed(a: Csr) -> Csr:
    order = np.argsort(a.columns, kind="stable")
    count = np.bincount(a.columns, minlength=a.width)
    return Csr(np.concatenate([[0], np.cumsum(count)]), a.row_of()[order], len(a))


def row_products(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the entries of a @ b, in order.

    Row by row, as Gustavson's: a row of the product adds up the rows of ``b`` that the row of
    ``a`` names.
    """
    start, count = b.first[a.columns], np.diff(b.first)[a.columns]
    stop = np.cumsum(count)
    within = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - count, count)
    column = b.columns[np.repeat(start, count) + within]
    entry, value = np.unique(np.repeat(a.row_of(), count) * b.width + column, return_counts=True)
    return entry // max(1, b.width), entry % max(1, b.width), value


def row_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Entries in each row of a @ b, where each row of ``a`` has one: without making them."""
    return np.diff(b.first)[a.columns]


# ---------------------------------------------------------------- tokenizers


def _byte_of_letter() -> dict[str, int]:
    """Byte-level letters: printable Latin-1 stands for itself, other bytes from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or b >= 0xA1 and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level tokenizer file; special tokens' strings in texts are plain text."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = _byte_of_letter()
        vocabulary = self.tokenizer.get_vocab()
        self.bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for letters, i in vocabulary.items():
            self.bytes[i] = bytes([byte[c] for c in letters]) if set(letters) <= byte.keys() else letters.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of a space and each text."""
        out: list[list[int]] = []
        for i in range(0, len(texts), _AT_ONCE):
            spaced = [" " + text for text in texts[i : i + _AT_ONCE]]
            out += [e.ids for e in self.tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]
        return out


class Pieces:
    """A sentence-piece file, which puts the space before a text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.blank = self.model.piece_to_id(_BLANK)
        # With a space inside a piece, units could not be tokenised one by one.
        self.by_words = not any(_BLANK in p.lstrip(_BLANK) for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of a space and each text; of the space alone, if the text is empty."""
        return [ids or [self.blank] for ids in self.model.encode(texts, num_threads=1)]


# ---------------------------------------------------------------- units

#: What follows an id in the text of the groups.
_MARKS = (b"", b",", b"|", b";")
_LAST, _SAME, _SIDE, _GROUP = range(4)


def _per(owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, minlength=n).astype(np.int64)


class Units:
    """What is known of the units so far.  Number 0 is a unit that cannot be aligned."""

    def __init__(self, a: ByteBpe, b: Pieces) -> None:
        self.a, self.b = a, b
        self.length = [np.array([len(x) for x in t.bytes], np.int64) for t in (a, b)]
        self.cut = _CUT if b.by_words else _UNCUT
        self.ids = max(len(a.bytes), len(b.bytes))
        self.words = [b"%d%s" % (i, mark) for mark in _MARKS for i in range(self.ids)]
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.size = 0  # bytes of all units
        self.groups: list[bytes] = [b""]
        #: Tokens of both, groups, links and links within groups of each unit.
        self.counts = np.zeros((1, 5), np.int64)
        self.first = np.zeros(2, np.int64)  # pairs of unit u: first[u]:first[u + 1]
        self.pairs = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)

    def split(self, text: bytes) -> list[bytes]:
        """The units of a text, each without the space it begins with."""
        return self.cut.split(text)

    def add(self, units: list[bytes]) -> None:
        """Align units that are new."""
        texts = [u.decode() for u in units]
        ids = [self.a.encode(texts), self.b.encode(texts)]
        good = self._spelled(units, ids)
        at = len(self.groups)
        for u, ok in zip(units, good, strict=True):
            self.number[u] = at if ok else 0
            at += ok
        self.size += sum(map(len, units))
        self._align(*[[x for x, ok in zip(side, good, strict=True) if ok] for side in ids])

    def _spelled(self, units: list[bytes], ids: list[list[list[int]]]) -> list[bool]:
        """Whether the tokens of both spell a space and the unit."""
        out = [True] * len(units)
        for known, side in zip((self.a.bytes, self.b.bytes), ids, strict=True):
            found = [b"".join([known[i] for i in x]) for x in side]
            out = [ok and len(f) == len(u) + 1 and f[0] == 0x20 and f.endswith(u) for ok, f, u in zip(out, found, units)]
        return out

    def _align(self, a: list[list[int]], b: list[list[int]]) -> None:
        n = len(a)
        if not n:
            return
        flat = [np.array([i for x in side for i in x], np.int64) for side in (a, b)]
        owner = [np.repeat(np.arange(n), [len(x) for x in side]) for side in (a, b)]
        rows, columns = (tokens_by_bytes(length[ids]) for length, ids in zip(self.length, flat, strict=True))
        left, right, _ = row_products(rows, transposed(columns))
        # Groups end where tokens of both end.
        ends = np.intersect1d(rows.first[1:], columns.first[1:], assume_unique=True)
        group = [np.searchsorted(ends, m.first[1:]) for m in (rows, columns)]
        by_group = [Csr(np.arange(len(g) + 1), g, len(ends)) for g in group]
        shared = row_sizes(by_group[0], transposed(by_group[1]))
        of_group = np.zeros(len(ends), np.int64)
        of_group[group[0]] = owner[0]
        counts = [_per(owner[0], n), _per(owner[1], n), _per(of_group, n), _per(owner[0][left], n)]
        counts.append(np.bincount(owner[0], shared, n).astype(np.int64))
        # The different pairs of ids of each unit.
        pair = flat[0][left] << 32 | flat[1][right]
        order = np.lexsort([pair, owner[0][left]])
        pair, unit = pair[order], owner[0][left][order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (unit[1:] != unit[:-1])
        place = np.flatnonzero(new)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(_per(unit[place], n))])
        self.pairs = np.concatenate([self.pairs, pair[place]])
        self.times = np.concatenate([self.times, np.diff(np.append(place, len(pair)))])
        self.counts = np.concatenate([self.counts, np.stack(counts, axis=1)])
        self.groups += self._texts(flat, group, of_group, n)

    def _texts(self, flat: list[np.ndarray], group: list[np.ndarray], of_group: np.ndarray, n: int) -> list[bytes]:
        """The groups of each unit, as `a1,a2|b1;a3|b2,b3`."""
        ids, g = np.concatenate(flat), np.concatenate(group)
        side = np.repeat([0, 1], [len(x) for x in flat])
        order = np.lexsort([side, g])  # stable: tokens of one side keep their order
        ids, g, side = ids[order], g[order], side[order]
        unit = of_group[g]
        after = np.full(len(ids), _LAST)  # what follows each id
        after[:-1][unit[1:] == unit[:-1]] = _GROUP
        after[:-1][g[1:] == g[:-1]] = _SIDE
        after[:-1][(g[1:] == g[:-1]) & (side[1:] == side[:-1])] = _SAME
        words = [self.words[k] for k in (after * self.ids + ids).tolist()]
        stop = np.cumsum(_per(unit, n)).tolist()
        return [b"".join(words[i:j]) for i, j in zip([0, *stop], stop)]


_units: dict[tuple[str, str], Units] = {}


def units(a_path: str, b_path: str) -> Units:
    """One for each Python worker."""
    key = a_path, b_path
    if key not in _units:
        _units[key] = Units(ByteBpe(a_path), Pieces(b_path))
    return _units[key]


# ---------------------------------------------------------------- chunks

_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


class _Chunk:
    """Texts of one chunk: what they are made of, in units of the worker."""

    def __init__(self, known: Units) -> None:
        self.known = known
        self.size = 0
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.shas: list[str] = []
        self.used: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # text, unit, times

    def add(self, ids: pa.Array, texts: list[bytes]) -> None:
        known = self.known
        cut = [known.split(t) if t else [] for t in texts]
        flat = [u for c in cut for u in c]
        new = set(flat).difference(known.number)
        if new:
            known.add(sorted(new))
        n = len(texts)
        unit = np.fromiter(map(known.number.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(n), [len(c) for c in cut])
        lost = _per(text[unit == 0], n) > 0  # a text with a unit that cannot be aligned has no tokens
        unit, text = unit[~lost[text]], text[~lost[text]]
        sums = np.zeros((len(unit) + 1, len(_COUNTS)), np.int64)
        np.cumsum(known.counts[unit], axis=0, out=sums[1:])
        stop = np.searchsorted(text, np.arange(n + 1))
        self.counts.append(sums[stop[1:]] - sums[stop[:-1]])
        for i, j in zip(stop.tolist(), stop[1:].tolist()):
            joined = b";".join([known.groups[u] for u in unit[i:j].tolist()])
            self.shas.append(hashlib.sha256(joined).hexdigest() if i < j else "")
        entry, times = np.unique(text << 32 | unit, return_counts=True)
        self.used.append((len(self.shas) - n + (entry >> 32), entry & 0xFFFFFFFF, times))
        self.ids.append(ids)
        self.size += sum(map(len, texts))

    def take(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row with the chunk's units and pairs, then one for each text."""
        name = uuid.uuid4().int >> 65
        text, unit, times = (np.concatenate(x) for x in zip(*self.used, strict=True))
        own, local = np.unique(unit, return_inverse=True)
        n = np.bincount(local, times, len(own)).astype(np.int64)
        start, size = self.known.first[own], np.diff(self.known.first)[own]
        stop = np.cumsum(size)
        at = np.repeat(start - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)
        pair, place = np.unique(self.known.pairs[at], return_inverse=True)
        per_unit = self.known.times[at]
        total = np.bincount(place, per_unit * np.repeat(n, size), len(pair)).astype(np.int64)
        made = _packed(size), _packed(place), _packed(per_unit)
        none = {f.name: [None] for f in schema}
        chunk = none | {"chunk": [name], "units": [made], "pairs": [pair], "totals": [total]}
        yield pa.RecordBatch.from_arrays([pa.array(chunk[f.name], f.type) for f in schema], schema=schema)
        counts, m = np.concatenate(self.counts), len(self.shas)
        stop = np.searchsorted(text, np.arange(m + 1)).tolist()
        packed = [(_packed(np.diff(local[i:j], prepend=0)), _packed(times[i:j]), b"") for i, j in zip(stop, stop[1:])]
        rows = {
            "chunk": pa.array(np.full(m, name)),
            "doc_id": pa.concat_arrays(self.ids),
            "units": pa.array(packed, schema.field("units").type),
            "groups_sha256": pa.array(self.shas),
        }
        rows |= {c: pa.array(counts[:, k]) for k, c in enumerate(_COUNTS)}
        yield pa.RecordBatch.from_arrays(
            [rows[f.name] if f.name in rows else pa.nulls(m, f.type) for f in schema], schema=schema
        )


def _packed(values: np.ndarray) -> bytes:
    return values.astype(np.uint32).tobytes()


def _unpacked(values: bytes) -> np.ndarray:
    return np.frombuffer(values, np.uint32).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and texts, some 1 MB at a time."""
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        end = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
        row = 0
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(end, end[row] + PIECE_BYTES, "right")) - 1)
            yield batch.column(0)[row:stop], texts[row:stop].to_pylist()
            row = stop


def _chunks(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    """Rows of texts, and one for each chunk with its different pairs of ids."""
    schema = T.StructType([T.StructField("chunk", T.LongType()), docs.schema["doc_id"]])
    for c in _COUNTS:
        schema = schema.add(c, T.LongType())
    schema = schema.add("groups_sha256", T.StringType())
    schema = schema.add("units", T.DataType.fromDDL("struct<a:binary,b:binary,c:binary>"))
    schema = schema.add("pairs", T.DataType.fromDDL("array<long>")).add("totals", T.DataType.fromDDL("array<long>"))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = units(a_path, b_path)
        chunk = _Chunk(known)
        for ids, texts in _texts(batches):
            chunk.add(ids, texts)
            if chunk.size >= chunk_bytes:
                yield from chunk.take(arrow)
                if len(known.number) > UNITS or known.size > UNIT_BYTES:
                    known.forget()
                chunk = _Chunk(known)
        if chunk.shas:
            yield from chunk.take(arrow)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Links by pair of ids over the corpus, and whether no other first id has more with the second.

    (pair, n, best); a pair is the first id times 2**32 plus the second.
    """
    both = chunks.where("pairs is not null").select(F.inline(F.arrays_zip("pairs", "totals")))
    counts = stored(both.groupBy(F.col("pairs").alias("pair")).agg(F.sum("totals").alias("n")), "pair-counts")
    second = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("second")
    most = counts.groupBy(second).agg(F.max("n").alias("most"))
    rows = counts.withColumn("second", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(most, "second")
    return rows.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _answered(chunks: DataFrame, counts: DataFrame, schema: T.StructType) -> DataFrame:
    """The texts' counts with what the corpus says of their links."""
    asked = chunks.where("pairs is not null").select(F.col("chunk").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts.hint("merge"), "pair").select("asker", "place", "n", "best")

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        made, texts = own.filter(own["is_chunk"]), own.filter(pc.invert(own["is_chunk"]))
        size, place, per_unit = map(_unpacked, made["units"][0].as_py().values())
        m = len(found)
        n, best = np.zeros(m, np.int64), np.zeros(m, np.int64)
        at = found["place"].to_numpy()
        n[at], best[at] = found["n"].to_numpy(), found["best"].to_numpy()
        # Sums over the pairs of each unit: its row of a sparse matrix times the answers.
        so_far = np.zeros((len(place) + 1, 2), np.int64)
        np.cumsum(np.stack([per_unit * n[place], per_unit * best[place]], axis=1), axis=0, out=so_far[1:])
        stop = np.cumsum(size)
        sums = so_far[stop] - so_far[stop - size]
        count_sum, n_best = [], []
        for packed in texts["units"].to_pylist():
            local, times = np.cumsum(_unpacked(packed["a"])), _unpacked(packed["b"])
            count_sum.append(int((sums[local, 0] * times).sum()))
            n_best.append(int((sums[local, 1] * times).sum()))
        columns = [texts[c] for c in ("doc_id", *_COUNTS)] + [pa.array(n_best), pa.array(count_sum)]
        return pa.Table.from_arrays([*columns, texts["groups_sha256"]], names=schema.names)

    own = chunks.select("chunk", "doc_id", *_COUNTS, "groups_sha256", "units", F.col("pairs").isNotNull().alias("is_chunk"))
    return own.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, text) -> how the tokens of tokenizers A (byte-level) and B (pieces) lie over each other.

    Both encode a space and the text.  Returns doc_id; ``n_a``, ``n_b`` tokens; ``n_groups``;
    ``n_links``, pairs of tokens that overlap; ``n_group_links``, pairs of tokens of one group;
    ``n_best``, links whose pair of ids is linked, over the corpus, no less often than any other pair with
    this id of B; ``count_sum``, over links, how often their pair is linked; ``groups_sha256`` of
    `a1,a2|b1;a3|b2,b3`.

    A text that is null or empty, or whose tokens do not spell a space and the text, has no tokens:
    zeros and an empty string.  Repeated rows and null ids count each for itself, other columns
    are ignored, an empty table gives no rows.
    """
    schema = T.StructType([docs.schema["doc_id"]])
    for c in (*_COUNTS, "n_best", "count_sum"):
        schema = schema.add(c, T.LongType())
    schema = schema.add("groups_sha256", T.StringType())
    chunks = stored(_chunks(docs, a_path, b_path, chunk_bytes), "alignment", compression="zstd")
    counts = stored(pair_counts(chunks), "pair-best")
    return _answered(chunks, counts, schema)
