"""SimHash near-duplicates, linked through a table of distances to reference fingerprints.

The references are zero and, for each of 16 blocks of 4 bits, three words that are zero
outside the block.  ``d(x, ref) - d(x, 0)`` depends on the block's bits alone, and the three
differences tell all 16 values of a block apart.  A *cell* holds the fingerprints with equal
differences in some blocks.  Two fingerprints within 2 bits differ in 2 blocks at most; of
three groups of blocks, one therefore agrees, and the pair meets in that group's cell.  A
cell of more than ``CELL`` fingerprints is cut again, by three groups of the blocks that it
leaves open.  When two blocks are open it holds 256 different fingerprints at most, so no
cell is ever large, whatever the data, and no pair is lost.

In a cell, the triangle inequality discards each pair with a difference of more than
``bits`` in any coordinate of the table; the rest are verified by their bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rankspark.llm import words as W
from rankspark.llm.components import components
from rankspark.llm.tables import null_safe, stored

SHINGLE = 3
BITS = 2
SEED = 42
CELL = 256
_BLOCKS = 16
#: The words of a block; test_simhash checks that they tell its values apart.
_BLOCK_WORDS = (0b0011, 0b0101, 0b1110)


def references() -> np.ndarray:
    """Zero first, then three words for each block."""
    own = [word << (4 * block) for block in range(_BLOCKS) for word in _BLOCK_WORDS]
    return np.array([0, *own], np.uint64)


def distances(fingerprints: np.ndarray) -> np.ndarray:
    """The pivot table: Hamming distance of each fingerprint to each reference."""
    return np.bitwise_count(fingerprints[:, None] ^ references()[None, :]).astype(np.int8)


# ---------------------------------------------------------------- fingerprints


def _shingle_bounds(c: W.Chunk, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words joined by single spaces, and start, end and document of every shingle."""
    keep = np.zeros(len(c.data) + 1, bool)
    marks = np.zeros(len(c.data) + 2, np.int8)
    np.add.at(marks, c.start, 1)
    np.add.at(marks, c.end, -1)
    keep[:-1] = np.cumsum(marks)[: len(c.data)] > 0
    raw = np.append(c.data, np.uint8(0))
    gaps = c.end[~keep[c.end]]
    raw[gaps] = 0x20
    keep[gaps] = True
    place = np.cumsum(keep) - keep
    n = np.diff(c.first)
    doc = np.repeat(np.arange(len(c)), n)
    k = np.arange(len(doc))
    last = c.first[doc + 1] - 1
    used = (k + size - 1 <= last) | (k == c.first[doc])
    k, doc = k[used], doc[used]
    to = np.minimum(k + size - 1, last[used])
    return raw[keep].tobytes(), place[c.start[k]], place[c.end[to] - 1] + 1, doc


def _fingerprints(c: W.Chunk, size: int) -> np.ndarray:
    text, start, end, doc = _shingle_bounds(c, size)
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(text[a:b], SEED) for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.uint64
    )
    out = np.zeros(len(c), np.uint64)
    if len(hashes):
        with_words, first = np.unique(doc, return_index=True)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        total = np.diff(np.append(first, len(doc)))
        packed = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
        out[with_words] = packed.view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp), one row per input row.

    Lower-cases A-Z; a text of fewer words than a shingle is one shingle, one without words
    (or null) has fingerprint zero.  Shingles count as often as they occur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_fingerprints(c, shingle) for c in W.chunks(batch.column(1), W.PLAIN, lower=True)]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- cells


def _thirds(blocks: tuple[int, ...]) -> list[tuple[int, ...]]:
    return [blocks[i::3] for i in range(3)]


def _patterns() -> list[list[tuple[tuple[int, ...], tuple[int, ...]]]]:
    """By level: (fixed blocks, open blocks) of every kind of cell; children stand in threes."""
    levels = [[((), tuple(range(_BLOCKS)))]]
    while any(len(free) > 2 for _, free in levels[-1]):
        levels.append(
            [
                (fixed + group, tuple(b for b in free if b not in group))
                for fixed, free in levels[-1]
                for group in (_thirds(free) if len(free) > 2 else [(), (), ()])
            ]
        )
    return levels


_LEVELS = _patterns()
_CELL_SCHEMA = "cell long, kind int, fp long, node long"


def _cells(rows: DataFrame, level: int) -> DataFrame:
    """(kind, fp, node) of the level before -> the three cells of this level for each row."""
    kinds = _LEVELS[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = W.mix(np.arange(1, 3 * _BLOCKS + 1, dtype=np.uint64))
        for batch in batches:
            kind = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy().view(np.uint64)
            table = distances(fp)
            from_zero = (table[:, 1:] - table[:, :1]).astype(np.int64).view(np.uint64) * weight
            cells, out_kind = np.zeros((len(fp), 3), np.uint64), np.zeros((len(fp), 3), np.int32)
            for child in range(3):
                out_kind[:, child] = 3 * kind + child
            for k in np.unique(out_kind):
                at = out_kind == k
                columns = [3 * b + i for b in kinds[k][0] for i in range(3)]
                sums = from_zero[np.nonzero(at)[0]][:, columns].sum(axis=1, dtype=np.uint64)
                cells[at] = W.mix(W.mix(sums) + np.uint64(k))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cells.ravel().view(np.int64)),
                    pa.array(out_kind.ravel()),
                    pa.array(np.repeat(fp.view(np.int64), 3)),
                    pa.array(np.repeat(batch.column(2).to_numpy(), 3)),
                ],
                ["cell", "kind", "fp", "node"],
            )

    return rows.select("kind", "fp", "node").mapInArrow(run, _CELL_SCHEMA)


def _spanning(fp: np.ndarray, node: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of one cell, without those that close a circle."""
    table = distances(fp)
    near = np.ones((len(fp), len(fp)), bool)
    for coordinate in table.T:
        near &= np.abs(coordinate[:, None] - coordinate[None, :]) <= bits
    i, j = np.nonzero(np.triu(near, 1))
    ok = np.bitwise_count(fp[i] ^ fp[j]) <= bits
    parent = list(range(len(fp)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
        x, y = top(a), top(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(node[a]), int(node[b])))
    return out


def _links(full_cells: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offset = lists.offsets.to_numpy()
            members = lists.values
            fp = members.field("fp").to_numpy().view(np.uint64)
            node = members.field("node").to_numpy()
            found: list[tuple[int, int]] = []
            for a, b in zip(offset[:-1].tolist(), offset[1:].tolist(), strict=True):
                found += _spanning(fp[a:b], node[a:b], bits)
            ends = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    members = F.collect_list(F.struct("fp", "node")).alias("members")
    return full_cells.groupBy("cell").agg(members).select("members").mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, node) with different fp -> (a, b): node pairs that connect all within ``bits`` bits."""
    if not 0 <= bits <= 2:
        raise ValueError("three groups of blocks find pairs within 2 bits")
    rows = nodes.where("node is not null").select(F.lit(0).alias("kind"), "fp", "node")
    found = None
    for level in range(1, len(_LEVELS)):
        cells = stored(_cells(rows, level), "simhash-cells")
        sizes = stored(
            cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-sizes"
        )
        last = level == len(_LEVELS) - 1
        small = sizes if last else sizes.where(F.col("n") <= CELL)
        part = stored(_links(cells.join(small.select("cell"), "cell"), bits), "simhash-links")
        found = part if found is None else found.union(part)
        large = sizes.where(F.col("n") > CELL).select("cell")
        if last or large.isEmpty():
            break
        rows = cells.join(large, "cell")
    return found


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp, component_id), one row per input row.

    ``component_id`` is the least doc_id reached through fingerprints that differ in at most
    ``bits`` bits, the row's own included.  Rows with one fingerprint are one vertex, and so
    are rows with one doc_id.  A row without doc_id takes part only through its fingerprint;
    where no row of a fingerprint has an id, the component is null.  An empty table gives an
    empty result; columns other than the two are ignored.
    """
    marked = stored(fingerprints(docs, shingle), "simhash-fingerprints")
    # A repeated id with two texts belongs to two fingerprints: both get its least vertex.
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    repeated = (
        marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null")
    )
    same_id = (
        marked.join(repeated.select("doc_id"), "doc_id")
        .join(nodes, "fp")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    roots = components(links(nodes, bits).union(same_id), "simhash-components")
    placed = nodes.join(roots, nodes["node"] == roots["v"], "left").select(
        nodes["fp"].alias("of"), F.coalesce("root", "node").alias("component_id")
    )
    return marked.join(placed, marked["fp"] == placed["of"], "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The documents whose id is the least of their component, with all columns.

    Of rows that repeat an id, all stay or all go; rows without an id stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"), shingle, bits)
    gone = found.where("component_id < doc_id").select(null_safe("doc_id").alias("gone")).distinct()
    gone = stored(gone, "simhash-gone")
    return docs.join(gone, null_safe("doc_id") == gone["gone"], "left_anti")
