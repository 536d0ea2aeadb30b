"""WARC files of pages: written as one gzip stream, normalised to one member per record.

A file compressed as a whole cannot be entered in the middle.  The normaliser inflates such
a stream once, from start to end, and writes every record as a gzip member of its own, with
a sidecar file of one line per record: offset, compressed length, type, record id.  The
reader fetches records by these lines.  All files lie in the shared folder; a table of files
names those of the tasks' last runs.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from rankspark.llm.tables import stored
from rankspark.runtime import new_folder

#: Fixed values of the WARC 1.1 format.
_VERSION = "WARC/1.1"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: A file ends with the record that brings its records to so many bytes.
FILE_BYTES = 64 << 20
LEVEL = 6
_READ = 1 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").rstrip(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit of the page ``refers_to``, which holds the same payload."""
    block = b"" if refers_to is not None else _HTTP % len(payload) + payload
    head = [
        _VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {_SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def payload(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def inflate(source) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, piece by piece."""
    machine = zlib.decompressobj(31)
    while data := source.read(_READ):
        while data:
            out = machine.decompress(data, _READ)
            if out:
                yield out
            data = machine.unconsumed_tail
            if machine.eof:
                data = machine.unused_data
                machine = zlib.decompressobj(31)
    if out := machine.flush():
        yield out


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """A stream of bytes cut into whole records; one record at a time is held."""
    data = bytearray()
    need = 0  # bytes of the record at hand, once its header is complete
    for piece in pieces:
        data += piece
        while True:
            if not need:
                at = data.find(b"\r\n\r\n")
                if at < 0:
                    break
                size = re.search(rb"\r\nContent-Length: (\d+)", data[:at])
                if size is None:
                    raise ValueError("a record without Content-Length")
                need = at + 4 + int(size[1]) + 4
            if len(data) < need:
                break
            yield bytes(data[:need])
            del data[:need]
            need = 0
    if data:
        raise ValueError("the last record is cut off")


class _Folder:
    """Output files of one task: opened one after another, each rolled at a size."""

    def __init__(self, folder: str, opened: Callable, size: int = FILE_BYTES) -> None:
        self.folder, self.opened, self.size = folder, opened, size
        self.now = None
        self.done: list[tuple[str, int]] = []

    def add(self, data: bytes) -> None:
        if self.now is None:
            self.uri = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            self.now, self.bytes, self.n = self.opened(self.uri), 0, 0
        self.now.add(data)
        self.bytes += len(data)
        self.n += 1
        if self.bytes >= self.size:
            self.close()

    def close(self) -> None:
        if self.now is not None:
            self.now.close()
            self.done.append((self.uri, self.n))
            self.now = None

    def rows(self) -> pa.RecordBatch:
        self.close()
        files, n = zip(*self.done, strict=True) if self.done else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(n, pa.int64())], ["file", "n_records"])


class Monolith:
    """One gzip stream over all records."""

    def __init__(self, uri: str) -> None:
        system, path = _open(uri)
        self.out = system.open_output_stream(path, compression=None)
        self.machine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)

    def add(self, data: bytes) -> None:
        self.out.write(self.machine.compress(data))

    def close(self) -> None:
        self.out.write(self.machine.flush())
        self.out.close()


class Members:
    """One gzip member for each record, and the sidecar."""

    def __init__(self, uri: str) -> None:
        system, path = _open(uri)
        self.out = system.open_output_stream(path, compression=None)
        self.side = system.open_output_stream(path + ".idx", compression=None)
        self.at = 0

    def add(self, data: bytes) -> None:
        fields, _ = parse(data)
        machine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = machine.compress(data) + machine.flush()
        self.out.write(member)
        line = f"{self.at}\t{len(member)}\t{fields['WARC-Type']}\t{fields['WARC-Record-ID']}\n"
        self.side.write(line.encode())
        self.at += len(member)

    def close(self) -> None:
        self.out.close()
        self.side.close()


_FILES = "file string, n_records long"


def _make(folder: str) -> str:
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    return folder


def roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html) and ``refers_to``: the page whose payload a revisit repeats.

    Of equal payloads of ``least_bytes`` or more, rows with the largest page_id are
    responses; a row without id revisits that page, if any row has an id.
    """
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"))
    mark = F.sha1(F.col("html").cast("binary"))
    ids = pages.select("page_id", mark.alias("mark"), F.octet_length("html").alias("n"))
    last = ids.groupBy("mark", "n").agg(F.max("page_id").alias("last")).where(F.col("n") >= least_bytes)
    last = stored(last.select("mark", "last"), "warc-responses")
    refers = F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last"))
    rows = pages.withColumn("mark", mark).join(last, "mark", "left")
    return rows.select("page_id", "url", "html", refers.alias("refers_to"))


def write_monoliths(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record per page into files of one gzip stream each; the table of files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Folder(folder, Monolith)
        for batch in batches:
            page_id, url, html, refers_to = batch.columns
            rows = zip(page_id.to_pylist(), url.to_pylist(), html, refers_to.to_pylist(), strict=True)
            for page, target, text, other in rows:
                files.add(record(page, target, text.as_py().encode(), other))
        yield files.rows()

    _make(folder)
    return stored(roles(pages, least_bytes).mapInArrow(run, _FILES), "warc-monoliths")


def normalise(files: DataFrame, folder: str, partitions: int) -> DataFrame:
    """Rewrites gzip WARC files with one member per record and a sidecar; the new files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Folder(folder, Members)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _open(uri)
                with system.open_input_stream(path, compression=None) as source:
                    for data in records(inflate(source)):
                        out.add(data)
                out.close()
        yield out.rows()

    _make(folder)
    return stored(files.select("file").repartition(partitions).mapInArrow(run, _FILES), "warc-files")


def sidecar(uri: str) -> list[tuple[int, int, str, str]]:
    """(offset, length, type, record id) of every record of a normalised file."""
    system, path = _open(uri + ".idx")
    with system.open_input_stream(path, compression=None) as source:
        lines = source.read().decode().splitlines()
    return [(int(a), int(b), kind, name) for a, b, kind, name in (x.split("\t") for x in lines)]


def record_at(source, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record of a normalised file, without reading the ones before it."""
    return parse(zlib.decompress(source.read_at(length, offset), 31))


_READ_BACK = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read(files: DataFrame, partitions: int) -> DataFrame:
    """A row for each record of normalised files, fetched by the sidecars.

    Size and digest of a response are those of the payload read; those of a revisit, which
    has none, stand in its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _open(uri)
                rows = []
                with system.open_input_file(path) as source:
                    for offset, length, kind, _ in sidecar(uri):
                        fields, block = record_at(source, offset, length)
                        name, url = fields["WARC-Record-ID"], fields.get("WARC-Target-URI")
                        if kind == "response":
                            body = payload(block)
                            rows.append((_page_id(name), url, len(body), digest(body), kind, None))
                        else:
                            mark = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            size = int(fields["X-Payload-Length"])
                            rows.append((_page_id(name), url, size, mark, kind, _page_id(fields["WARC-Refers-To"])))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    return files.select("file").repartition(partitions).mapInArrow(run, _READ_BACK)


def archive(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes, normalises and reads back: a row for each page, as its record tells it.

    Takes ``page_id``, ``url`` and ``html`` and ignores other columns.  A null html is an
    empty payload, a null url has no target field, a null id an empty number; repeated rows
    give repeated records; an empty table gives no files and no rows.
    """
    spark = pages.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monoliths = write_monoliths(pages, new_folder(spark, "warc-monoliths"), least_bytes)
    return read(normalise(monoliths, new_folder(spark, "warc"), partitions), partitions)
