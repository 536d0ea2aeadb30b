"""Packing of pieces into sequences: best fit, then local search by swaps.

Lengths are whole numbers up to the capacity, so all that a packing needs to know of any
number of pieces is how many there are of each length: a table of at most ``capacity`` rows.
The search works on kinds of bins (the lengths they hold, and how many bins of the kind), and
a move is made in as many bins at once as there are.  Each kind then says which pieces it
takes, by their places among the pieces of one length, which Spark counts out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rankspark.llm.tables import stored
from rankspark.llm.tokens import encoder

CAPACITY = 1024
#: Rows that one task puts in order, on average.
BLOCK_ROWS = 50_000

Kind = tuple[int, ...]  # lengths in a bin, largest first


def best_fit(counts: dict[int, int], capacity: int) -> Counter[Kind]:
    """Longest first; each bin takes the longest piece that still fits, again and again."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    bins: Counter[Kind] = Counter()
    while lengths:
        space, kind, used = capacity, [], Counter()
        at = len(lengths)
        while at and space >= lengths[0]:
            at = bisect_right(lengths, space, 0, at)
            while at and used[lengths[at - 1]] >= left[lengths[at - 1]]:
                at -= 1
            if not at:
                break
            n = lengths[at - 1]
            take = min(space // n, left[n] - used[n])
            kind += [n] * take
            used[n] += take
            space -= n * take
        times = min(left[n] // k for n, k in used.items())
        bins[tuple(kind)] += times
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
                lengths.remove(n)
    return bins


def _parts(kind: Kind, most: int) -> list[Kind]:
    """Different choices of 1 to ``most`` pieces of a bin."""
    out = [(a,) for a in dict.fromkeys(kind)]
    if most > 1:
        distinct = sorted(Counter(kind).items())
        for i, (a, n) in enumerate(distinct):
            out += [(a, a)] * (n > 1) + [(a, b) for b, _ in distinct[i + 1 :]]
    return out


def _exchange(kind: Kind, gone: Kind, come: Kind) -> Kind:
    rest = Counter(kind)
    rest.subtract(gone)
    return tuple(sorted((*rest.elements(), *come), reverse=True))


class _Underfull:
    """The underfull kinds, and for each every choice of none, one or two pieces to give back."""

    def __init__(self, bins: Counter[Kind], capacity: int) -> None:
        self.capacity = capacity
        self.kinds = [k for k, c in bins.items() if c and sum(k) < capacity]
        self.kinds.sort(key=lambda k: (sum(k), k))
        rows = [(i, part) for i, k in enumerate(self.kinds) for part in [(), *_parts(k, 2)]]
        self.owner = np.array([i for i, _ in rows], np.int64)
        self.back = [part for _, part in rows]
        self.weight = np.array([sum(part) for part in self.back], np.int64)
        self.size = np.array([len(part) for part in self.back], np.int64)
        self.fill = np.array([sum(k) for k in self.kinds], np.int64)[self.owner] if rows else self.owner

    def best(self, giver: int, single: bool) -> tuple[int, Kind, Kind, int] | None:
        """The move from a bin of kind ``giver`` that gains most: taker, pieces there and back."""
        fill = sum(self.kinds[giver])
        found = None
        for part in _parts(self.kinds[giver], 2):
            more = sum(part) - self.weight
            ok = (more > 0) & (self.fill + more <= self.capacity)
            ok &= (self.size == 1) if len(part) == 2 else (self.size <= 2)
            if single:
                ok &= self.owner != giver
            gain = np.where(ok, 2 * more * (self.fill - fill + more), 0)
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > 0 and (found is None or gain[k] > found[3]):
                found = (int(self.owner[k]), part, self.back[k], int(gain[k]))
        return found


def improve(bins: Counter[Kind], capacity: int) -> Counter[Kind]:
    """Moves, one-for-one and two-for-one exchanges between underfull bins.

    Each increases the sum of squared fills; emptied bins go.  The emptiest bins give first.
    It ends when nothing increases the sum, or when no packing can have fewer bins.
    """
    bins = Counter(bins)
    total = sum(sum(k) * c for k, c in bins.items())
    fewest = -(-total // capacity)
    n_bins = sum(bins.values())
    while n_bins > fewest:
        state = _Underfull(bins, capacity)
        for giver in range(len(state.kinds)):
            a = state.kinds[giver]
            found = state.best(giver, bins[a] == 1)
            if found is not None:
                break
        else:
            break
        taker, there, back, _ = found
        b = state.kinds[taker]
        times = bins[a] // 2 if a == b else min(bins[a], bins[b])
        new_a, new_b = _exchange(a, there, back), _exchange(b, back, there)
        bins[a] -= times
        bins[b] -= times
        bins[new_b] += times
        if new_a:
            bins[new_a] += times
        else:
            n_bins -= times
        bins = +bins
    return bins


def _places(bins: Counter[Kind], capacity: int) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which bins: rows of first rank, first bin, offset."""
    taken: Counter[int] = Counter()
    rows = []
    bin_ = 0
    for kind, count in sorted(bins.items(), reverse=True):
        offset = 0
        for n in kind:
            rows.append((n, taken[n], bin_, offset))
            taken[n] += count
            offset += n
        bin_ += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "bin": table[:, 2], "offset": table[:, 3]}


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Counter[Kind]:
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    return improve(best_fit(counts, capacity), capacity)


def pack(items: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``.

    Takes a stored table, as it reads it twice; ``order`` names the columns that tell its
    rows apart (equal rows may change places).  Sequences are numbered from 0, and offsets
    within one run from 0 without gaps.  No rows give no sequences.
    """
    items = items.drop("sequence_id", "offset")
    blocks_of = F.pmod(F.xxhash64(*order), F.lit(1 << 20))
    n_rows = items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most capacity rows
    counts = {int(r[0]): int(r[1]) for r in n_rows}
    places = _places(plan(counts, capacity), capacity)
    blocks = max(1, -(-sum(counts.values()) // BLOCK_ROWS))
    rows = items.withColumn("__block", blocks_of % blocks)

    groups = stored(rows.groupBy("length", "__block").agg(F.count(F.lit(1)).alias("n")), "packing-groups")
    before = Window.partitionBy("length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = Window.partitionBy("length", "__block").orderBy(*order)
    rows = rows.withColumn("__own", F.row_number().over(own).cast("long"))
    ranked = rows.join(groups, ["length", "__block"]).withColumn("__rank", F.col("__own") + F.col("__before") - 1)
    ranked = ranked.select(*items.columns, "__rank")
    names = items.columns
    length_at = names.index("length")
    far = 1 << 44
    key = places["length"] * far + places["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(length_at).to_numpy().astype(np.int64)
            rank = batch.column(len(names)).to_numpy()
            k = np.searchsorted(key, length * far + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1]
                + [pa.array(places["bin"][k] + rank - places["rank"][k]), pa.array(places["offset"][k])],
                [*names, "sequence_id", "offset"],
            )

    schema = T.StructType([*items.schema.fields])
    return ranked.mapInArrow(run, schema.add("sequence_id", "long").add("offset", "long"))


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, text) -> pieces of at most ``capacity`` ids, the first being the short one.

    Every row gives at least one piece, as each document ends with the id 2; a null text is
    empty.  ``ids_crc32`` is that of the piece's ids as little-endian 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), own.encode(batch.column(1)), strict=True):
                n = len(ids)
                ends = range((n - 1) % capacity + 1, n + 1, capacity)
                start = 0
                for piece, end in enumerate(ends):
                    out.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end].astype("<u4", copy=False))))
                    start = end
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their sequences and places there."""
    rows = stored(pieces(docs, tokenizer, capacity), "packing-pieces")
    return pack(rows, capacity, ("doc_id", "piece", "ids_crc32"))
