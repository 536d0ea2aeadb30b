import base64
import gzip
import hashlib
import io
import zlib

import pytest
from rankspark.llm import warc as A

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"),
    (3, None, "<p>same</p>"), (4, "http://a/ä b\r\n", "größer \r\n\r\n WARC/1.1\r\nContent-Length: 5\r\n\r\n"),
    (5, "", None), (6, "x", ""), (None, "n", "<p>same</p>"), (None, "m", "only without id"), (7, "l", "x" * 3_000_000),
    (-8, "neg", "other"), (9, "crlf", "\r\n\r\n"),
]
SCHEMA = "page_id long, url string, html string, refers_to string, mark string"


def mark(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def wanted(pages, least=0):
    last = {}
    for i, _, html in pages:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = []
    for i, _, html in pages:
        other = last.get(html or "")
        revisit = len((html or "").encode()) >= least and other is not None and other != i
        size = len((html or "").encode())
        out.append((str(i), size, mark(html), "revisit" if revisit else "response", str(other if revisit else None)))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 1, 12])
@pytest.mark.parametrize("size", [200, A.FILE_BYTES])
def test_round_trip(spark, monkeypatch, least, size):
    monkeypatch.setattr(A, "FILE_BYTES", size)
    pages = spark.createDataFrame([(*p, "r", "m") for p in PAGES], SCHEMA)
    rows = A.archive(pages, least).collect()
    found = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in rows]
    assert sorted(found) == wanted(PAGES, least)


def test_no_pages(spark):
    assert A.archive(spark.createDataFrame([], SCHEMA)).count() == 0


def test_records_of_any_gzip_stream():
    every = [A.record(i, u, (h or "").encode(), None if k % 2 else 1) for k, (i, u, h) in enumerate(PAGES)]
    whole = gzip.compress(b"".join(every))
    members = b"".join(map(gzip.compress, every))
    mixed = gzip.compress(b"".join(every[:5])) + gzip.compress(b"".join(every[5:]))
    for stream in (whole, members, mixed):
        assert list(A.records(A.inflate(io.BytesIO(stream)))) == every
    assert list(A.records(A.inflate(io.BytesIO(b"")))) == []
    with pytest.raises(ValueError, match="cut off"):
        list(A.records(A.inflate(io.BytesIO(whole[: len(whole) // 2]))))


def test_normalised_file_can_be_entered_anywhere(spark, tmp_path):
    every = [A.record(i, u, (h or "").encode(), None) for i, u, h in PAGES]
    (tmp_path / "in.warc.gz").write_bytes(gzip.compress(b"".join(every)))
    files = spark.createDataFrame([(f"{tmp_path}/in.warc.gz", len(every))], "file string, n_records long")
    ((uri, n),) = A.normalise(files, f"{tmp_path}/out", 2).collect()
    lines = A.sidecar(uri)
    assert n == len(lines) == len(every)
    data = open(uri, "rb").read()
    assert gzip.decompress(data) == b"".join(every)
    for record, (offset, length, kind, name) in zip(every, lines, strict=True):
        assert zlib.decompress(data[offset : offset + length], 31) == record
        fields, block = A.parse(record)
        assert (kind, name) == (fields["WARC-Type"], fields["WARC-Record-ID"])
        assert len(block) == int(fields["Content-Length"])


def test_revisits_hold_no_payload():
    fields, block = A.parse(A.record(4, "http://x", b"body", 9))
    assert block == b"" and fields["WARC-Refers-To"] == A.record_id(9) and fields["X-Payload-Length"] == "4"
