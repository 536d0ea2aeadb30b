import random
import struct
import zlib
from collections import Counter

import pytest
from rankspark.llm import packing as P, queries as Q

from .conftest import ODD
from .test_tokens import encoder, whole  # noqa: F401


def squares(bins):
    return sum(sum(k) ** 2 * c for k, c in bins.items())


def held(bins):
    out = Counter()
    for kind, c in bins.items():
        for n in kind:
            out[n] += c
    return out


@pytest.mark.parametrize("seed", range(12))
def test_search_keeps_the_pieces_and_never_packs_worse(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1024])
    counts = Counter(rng.randint(1, rng.choice([capacity, capacity // 2])) for _ in range(rng.randrange(1, 400)))
    before = P.best_fit(counts, capacity)
    after = P.improve(before, capacity)
    for bins in (before, after):
        assert held(bins) == counts
        assert all(0 < sum(k) <= capacity for k in bins)
    assert squares(after) >= squares(before)
    assert sum(after.values()) <= sum(before.values())


def test_moves_and_exchanges_empty_bins():
    # 6+3 and 5+4 leave a 1 over from 10; only exchanges fill one bin and empty another.
    bins = Counter({(6, 3): 1, (5, 4): 1, (1,): 1, (1, 1): 1})
    assert sum(P.improve(bins, 10).values()) < 4
    two_for_one = Counter({(7, 2): 1, (6, 1, 1, 1): 1, (2,): 1})
    assert sum(P.improve(two_for_one, 10).values()) == 2
    many = P.improve(Counter({(6, 3): 1000, (5, 4): 1000, (1,): 2000}), 10)
    assert sum(many.values()) == 2000


def test_search_goes_on_while_a_move_is_found(monkeypatch):
    calls = []

    class Endless:
        def __init__(self, bins, capacity):
            self.kinds = [(1, 1)]

        def best(self, giver, single):
            calls.append(giver)
            return (0, (), (), 1) if len(calls) <= 20_500 else None

    monkeypatch.setattr(P, "_Underfull", Endless)
    assert P.improve(Counter({(1, 1): 7}), 10) == Counter({(1, 1): 7})
    assert len(calls) == 20_501


def test_one_bin_does_not_give_to_itself():
    assert P.improve(Counter({(3, 2): 1}), 10) == Counter({(3, 2): 1})
    assert sum(P.improve(Counter({(3, 2): 7}), 10).values()) == 4


def test_lengths_out_of_bounds():
    for n in (0, -1, 11):
        with pytest.raises(ValueError):
            P.plan({n: 1}, 10)


def check(rows, docs, ids, capacity):
    wanted = []
    for (i, _), own in zip(docs, ids, strict=True):
        cuts = [0, *range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted.append((str(i), piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *own[a:b]))))
    assert sorted((str(r.doc_id), *r[1:5]) for r in rows) == sorted(wanted)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize(("capacity", "block"), [(1024, 50_000), (100, 20), (7, 50)])
def test_odd_documents(odd, nothing, encoder, monkeypatch, capacity, block):  # noqa: F811
    monkeypatch.setattr(P, "BLOCK_ROWS", block)
    rows = P.pack_documents(odd, Q.tokenizer(), capacity).collect()
    ids = whole(encoder, [t for _, t in ODD])
    n = check(rows, ODD, ids, capacity)
    assert n <= -(-sum(map(len, ids)) // capacity) + 1
    assert P.pack_documents(nothing, Q.tokenizer(), capacity).count() == 0


def test_query(spark, encoder):  # noqa: F811
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = Q.op2_packing(spark, folder).collect()
    ids = whole(encoder, [t for _, t in docs])
    assert check(rows, docs, ids, 1024) <= -(-sum(map(len, ids)) // 1024) + 2
