"""Token ids in files of fixed bit width, in ascending document order.

A file holds blocks of 65,536 ids (the last may be shorter), each id in the fewest bits that
can tell the vocabulary's ids apart, 64 ids to ``bits`` words of 64 bits.  Behind the blocks
stand, as little-endian arrays: the place of each block (uint64, one more for the end), the
document ids (int64), whether each is null (uint8), and the number of ids up to the end of
each document (uint64).  The last 48 bytes are six uint64: a mark, bits, ids, documents,
blocks, and where the arrays begin.  Any id is found from its block's place without reading
what stands before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rankspark.llm.tables import stored
from rankspark.llm.tokens import encoder
from rankspark.runtime import new_folder

BLOCK = 1 << 16
#: A file ends with the document that brings it to so many ids.
FILE_IDS = 1 << 23
_MARK = 0x31304B5053444954
_TAIL = 48


def width(vocabulary: int) -> int:
    """The fewest bits for the ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of ``bits`` bits each, lowest first, filled up with zeros to a multiple of 64 ids."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    lanes = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    lanes.ravel()[: len(ids)] = ids
    out = np.zeros((len(lanes), bits), "<u8")
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        out[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return out.tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    out = np.zeros((len(words), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        out[:, lane] = value & mask
    return out.ravel()[:n]


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class Writer:
    """Writes one file; it counts only once ``close`` has returned and its row is kept."""

    def __init__(self, uri: str, bits: int) -> None:
        system, path = _open(uri)
        self.out = system.open_output_stream(path)
        self.bits, self.rest = bits, [np.zeros(0, np.uint32)]
        self.waiting = self.n = 0
        self.blocks = [0]
        self.ids: list[int | None] = []
        self.ends: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rest.append(ids)
        self.waiting += len(ids)
        self.n += len(ids)
        self.ids.append(doc_id)
        self.ends.append(self.n)
        if self.waiting >= BLOCK:
            whole = np.concatenate(self.rest)
            cut = len(whole) // BLOCK * BLOCK
            for start in range(0, cut, BLOCK):
                self._block(whole[start : start + BLOCK])
            self.rest, self.waiting = [whole[cut:]], len(whole) - cut

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.blocks.append(self.blocks[-1] + len(data))

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.rest))
        nulls = np.array([i is None for i in self.ids], np.uint8)
        for array in (
            np.array(self.blocks, "<u8"),
            np.array([i or 0 for i in self.ids], "<i8"),
            nulls,
            np.array(self.ends, "<u8"),
            np.array([_MARK, self.bits, self.n, len(self.ids), len(self.blocks) - 1, self.blocks[-1]], "<u8"),
        ):
            self.out.write(array.tobytes())
        self.out.close()


@dataclass
class Reader:
    """One file: its documents, and any stretch of its ids."""

    uri: str

    def __post_init__(self) -> None:
        system, path = _open(self.uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        mark, self.bits, self.n, docs, blocks, at = np.frombuffer(
            self.file.read_at(_TAIL, size - _TAIL), "<u8"
        ).tolist()
        if mark != _MARK:
            raise ValueError(f"{self.uri} is no file of packed ids")
        index = self.file.read_at(size - _TAIL - at, at)
        ends = [8 * (blocks + 1), 8 * docs, docs, 8 * docs]
        a, b, c, _ = np.cumsum(ends).tolist()
        self.blocks = np.frombuffer(index[:a], "<u8")
        self.doc_ids = np.frombuffer(index[a:b], "<i8")
        self.nulls = np.frombuffer(index[b:c], np.uint8).astype(bool)
        self.ends = np.frombuffer(index[c:], "<u8").astype(np.int64)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start``, read from the blocks that hold them."""
        if n <= 0:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (start + n - 1) // BLOCK
        out = []
        for k in range(first, last + 1):
            a, b = int(self.blocks[k]), int(self.blocks[k + 1])
            out.append(unpack(self.file.read_at(b - a, a), self.bits, min(BLOCK, self.n - k * BLOCK)))
        return np.concatenate(out)[start - first * BLOCK : start - first * BLOCK + n]


_WRITTEN = "shard int, part int, file string, n_docs long, n_ids long"


def write(docs: DataFrame, tokenizer: str, folder: str, partitions: int) -> DataFrame:
    """Encodes (doc_id, text) into files below ``folder``; returns the table of files.

    The documents are dealt out by ranges of doc_id (null first; rows with one id stay
    together, in the order of their texts), so that shard and part give the global order.
    A null text is empty.  A task that runs again writes new files; only those of its last
    run are in the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        own = encoder(tokenizer)
        bits = width(own.tokenizer.get_vocab_size())
        rows, writer, uri = [], None, ""
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), own.encode(batch.column(1)), strict=True):
                if writer is None:
                    uri = f"{folder}/{shard:06d}-{len(rows):04d}-{uuid.uuid4().hex}.ids"
                    writer = Writer(uri, bits)
                writer.add(doc_id, ids)
                if writer.n >= FILE_IDS:
                    writer.close()
                    rows.append((uri, len(writer.ids), writer.n))
                    writer = None
        if writer is not None:
            writer.close()
            rows.append((uri, len(writer.ids), writer.n))
        names, docs_, sums = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(rows), pa.int32()),
                pa.array(range(len(rows)), pa.int32()),
                pa.array(names, pa.string()),
                pa.array(docs_, pa.int64()),
                pa.array(sums, pa.int64()),
            ],
            ["shard", "part", "file", "n_docs", "n_ids"],
        )

    _make(folder)
    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(partitions, "doc_id")
    return stored(rows.sortWithinPartitions("doc_id", "text").mapInArrow(run, _WRITTEN), "packed-files")


def _make(folder: str) -> None:
    system, path = _open(folder)
    system.create_dir(path, recursive=True)


def read(files: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, start, ids) of every document in the files; ids are little-endian uint32.

    ``start`` counts the ids of all documents before it, over all files.
    """
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = Reader(uri)
                starts = np.concatenate([[0], reader.ends[:-1]]) if len(reader.ends) else reader.ends
                a = 0
                while a < len(starts):  # some blocks at a time
                    b = max(a + 1, int(np.searchsorted(reader.ends, starts[a] + 8 * BLOCK, "right")))
                    ids = reader.ids(int(starts[a]), int(reader.ends[b - 1] - starts[a])).astype("<u4")
                    cut = (np.append(starts[a:b], reader.ends[b - 1]) - starts[a]) * 4
                    binary = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), b - a, [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(ids)]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids[a:b], mask=reader.nulls[a:b]),
                            pa.array(starts[a:b] + base),
                            binary.cast(pa.binary()),
                        ],
                        ["doc_id", "start", "ids"],
                    )
                    a = b

    rows = files.select("file", "base").repartition(partitions)
    return rows.mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents to a new folder of the shared one and reads them back."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read(write(docs, tokenizer, new_folder(spark, "packed"), partitions), partitions)
