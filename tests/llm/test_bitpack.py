import struct
import zlib

import numpy as np
import pytest
from rankspark.llm import bitpack as B, queries as Q

from .conftest import ODD
from .test_tokens import encoder, whole  # noqa: F401


@pytest.mark.parametrize("bits", range(1, 33))
def test_every_width(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = B.pack(ids, bits)
        assert len(data) == -(-n // 64) * 8 * bits
        assert (B.unpack(data, bits, n) == ids).all()


def test_width():
    assert [B.width(v) for v in (1, 2, 3, 256, 257, 50257, 65537)] == [1, 1, 2, 8, 9, 16, 17]
    with pytest.raises(ValueError):
        B.pack(np.array([8], np.uint32), 3)


def test_any_stretch_of_a_file(tmp_path):
    rng = np.random.default_rng(0)
    sizes = [0, 5, 70_000, 1, 0, 200_000, 3]
    docs = [rng.integers(0, 50257, n, dtype=np.uint32) for n in sizes]
    writer = B.Writer(f"{tmp_path}/x.ids", 16)
    for i, ids in enumerate(docs):
        writer.add(None if i == 3 else -i, ids)
    writer.close()
    reader, flat = B.Reader(f"{tmp_path}/x.ids"), np.concatenate(docs)
    assert reader.ends.tolist() == np.cumsum(sizes).tolist()
    assert reader.nulls.tolist() == [i == 3 for i in range(7)]
    for start, n in [(0, 0), (0, 1), (65535, 2), (131072, 65536), (100, 250_000), (len(flat) - 1, 1)]:
        assert (reader.ids(start, n) == flat[start : start + n]).all()


@pytest.mark.parametrize("size", [30, 1 << 23])
def test_round_trip(spark, odd, encoder, monkeypatch, size):  # noqa: F811
    monkeypatch.setattr(B, "FILE_IDS", size)
    rows = B.round_trip(odd, Q.tokenizer()).collect()
    docs = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, wanted = 0, []
    for (i, _), ids in zip(docs, whole(encoder, [t for _, t in docs]), strict=True):
        wanted.append((str(i), start, struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert sorted((str(r.doc_id), r.start, bytes(r.ids)) for r in rows) == sorted(wanted)


def test_nothing(nothing):
    assert B.round_trip(nothing, Q.tokenizer()).count() == 0


def test_query(spark, encoder):  # noqa: F811
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    start, wanted = 0, []
    for r, ids in zip(docs, whole(encoder, [r.text for r in docs]), strict=True):
        wanted.append((r.doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    found = Q.op7_bitpack(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == wanted
