import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from rankspark.llm import alignment as A
from tokenizers import Tokenizer

from .conftest import ODD

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain_tokens():
    """(id, bytes) lists of both tokenizers on whole texts."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    byte = A._byte_of_letter()
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def run(text):
        e = a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in e.ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return left, right

    return run


def brute(rows, plain_tokens):
    out, links = [], []
    for doc, text in rows:
        left, right = plain_tokens(text) if text else ([], [])
        wanted = (" " + (text or "")).encode()
        if any(b"".join(x for _, x in side) != wanted for side in (left, right)):
            left, right = [], []
        spans = []
        for side in (left, right):
            at, own = 0, []
            for i, x in side:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = [([], []) for _ in ends]
        for k, side in enumerate(spans):
            for i, s, _ in side:
                groups[bisect.bisect_right(ends, s)][k].append(i)
        found, j = [], 0
        for i, s, e in spans[0]:
            while j and spans[1][j][1] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                found.append((i, spans[1][k][0]))
                k += 1
        text_groups = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        links.append(found)
        sha = hashlib.sha256(text_groups.encode()).hexdigest() if groups else ""
        inside = sum(len(x) * len(y) for x, y in groups)
        out.append([doc, len(spans[0]), len(spans[1]), len(groups), len(found), inside, sha])
    count = Counter(pair for found in links for pair in found)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    for row, found in zip(out, links, strict=True):
        row[6:6] = [sum(count[p] == most[p[1]] for p in found), sum(count[p] for p in found)]
    return sorted(map(repr, map(tuple, out)))


def aligned(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = A.align(docs, *PATHS, **settings)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(repr(tuple(r)) for r in found.select(*names).collect())


@pytest.mark.parametrize("chunk_bytes", [A.CHUNK_BYTES, 1000])
def test_odd_texts_against_whole_texts(spark, plain_tokens, chunk_bytes):
    rows = [*ODD, (20, "<|endoftext|> <s> </s> <0x41>"), (21, "a▁b"), (22, "x▁ y plain"), (23, "a  b   c "), (24, " ")]
    assert aligned(spark, rows, chunk_bytes=chunk_bytes) == brute(rows, plain_tokens)


@pytest.mark.parametrize("letters", ["ab'  \n\t\xa0é1!s\r\x85\x1c 你Ж", "ab' \n1!s", " theing", "a　  . x   "])
def test_units_against_whole_texts(spark, plain_tokens, letters):
    rng = random.Random(letters)
    rows = [(i, "".join(rng.choices(letters, k=rng.randrange(40)))) for i in range(400)]
    assert aligned(spark, rows, chunk_bytes=2000) == brute(rows, plain_tokens)


def test_workers_that_forget(spark, plain_tokens, monkeypatch):
    rows = [(i, f"word{i} unlike{i * i} others") for i in range(50)]
    monkeypatch.setattr(A, "UNITS", 5)
    known = A.Units(A.ByteBpe(PATHS[0]), A.Pieces(PATHS[1]))
    known.add([b"one", b"two"])
    known.forget()
    known.add([b"two"])
    assert known.number == {b"two": 1} and len(known.groups) == 2
    assert aligned(spark, rows, chunk_bytes=10) == brute(rows, plain_tokens)


def test_documents(spark, plain_tokens):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert aligned(spark, rows) == brute(rows, plain_tokens)


def test_extra_columns_and_no_rows(spark, nothing, odd):
    assert A.align(nothing, *PATHS).count() == 0
    named = odd.withColumnsRenamed({"lang": "chunk", "source": "pairs", "kept": "units"})
    assert A.align(named, *PATHS).count() == len(ODD)


def test_row_products_against_matrices():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, y = (rng.random((5, 7)) < 0.4).astype(int), (rng.random((7, 4)) < 0.4).astype(int)
        a, b = (A.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1]) for m in (x, y))
        rows, columns, values = A.row_products(a, b)
        dense = np.zeros((5, 4), int)
        dense[rows, columns] = values
        assert (dense == x @ y).all() and (values > 0).all()
        t = A.transposed(a)
        assert (t.columns == np.nonzero(x.T)[1]).all() and len(t) == 7
