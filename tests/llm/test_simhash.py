import itertools
import random

import numpy as np
import pytest
import xxhash
from rankspark.llm import components as C, simhash as S

from .conftest import ODD, babble, lower, plain


def fingerprint(text):
    words = plain(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def top(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def classes(vertices, edges):
    parent = {v: v for v in vertices}
    for a, b in edges:
        a, b = top(parent, a), top(parent, b)
        parent[max(a, b)] = min(a, b)
    return {v: top(parent, v) for v in vertices}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_words_of_a_block_tell_its_values_apart():
    seen = {tuple((x & w).bit_count() for w in S._BLOCK_WORDS) for x in range(16)}
    assert len(seen) == 16
    assert len(set(S.references().tolist())) == 49


def test_every_level_keeps_near_pairs_together():
    for level in S._LEVELS[1:]:
        for a, b in itertools.combinations(range(16), 2):
            assert any(a not in fixed and b not in fixed for fixed, _ in level)
    assert all(len(free) <= 2 for _, free in S._LEVELS[-1])


@pytest.mark.parametrize("cell", [2, 256])
def test_dense_fingerprints_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(S, "CELL", cell)
    rng = random.Random(cell)
    centres = [rng.getrandbits(64) for _ in range(6)]
    made = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centres for _ in range(40)}
    made |= {rng.getrandbits(64) for _ in range(100)}
    nodes = [(signed(f), 1000 + i) for i, f in enumerate(sorted(made))]
    links = S.links(spark.createDataFrame(nodes, "fp long, node long")).collect()
    fp = {n: f & (1 << 64) - 1 for f, n in nodes}
    assert all((fp[a] ^ fp[b]).bit_count() <= 2 for a, b in links)
    near = [(a, b) for a, b in itertools.combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 2]
    assert classes(fp, links) == classes(fp, near)


def test_pairs_farther_than_the_pivots_allow_are_never_near():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    assert np.abs(S.distances(x) - S.distances(y)).max() == 1


def wanted(docs):
    fp = [fingerprint(t) for _, t in docs]
    edges = [(("f", a), ("f", b)) for a, b in itertools.combinations(set(fp), 2) if (a ^ b).bit_count() <= 2]
    edges += [(("f", f), ("i", i)) for f, (i, _) in zip(fp, docs, strict=True) if i is not None]
    group = classes({v for e in edges for v in e} | {("f", f) for f in fp}, edges)
    least = {}
    for (kind, value), g in group.items():
        if kind == "i":
            least[g] = min(value, least.get(g, value))
    return sorted((str(i), f, str(least.get(group["f", f]))) for f, (i, _) in zip(fp, docs, strict=True))


@pytest.mark.parametrize("docs", [ODD, babble(1, 60, 30, "abcd"), babble(2, 80, 12, ["x", "Y", "y"])])
def test_documents_against_brute_force(spark, docs):
    rows = S.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((str(r[0]), r[1] & (1 << 64) - 1, str(r[2])) for r in rows) == wanted(docs)


def test_one_of_each_group_stays(spark, odd, nothing):
    kept = S.one_of_each(odd)
    assert kept.columns == odd.columns
    left = [r.doc_id for r in kept.collect()]
    component = {i: c for i, _, c in wanted(ODD)}
    assert sorted(map(str, left)) == sorted(str(i) for i, _ in ODD if i is None or component[str(i)] == str(i))
    assert S.one_of_each(nothing).count() == 0
    assert S.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1100)]
    edges += [(5000, 5001 + i) for i in range(200)]
    found = C.components(spark.createDataFrame(edges, "a long, b long")).collect()
    vertices = {v for a, b in edges for v in (a, b) if a != b}
    assert {r.v: r.root for r in found} == {v: r for v, r in classes(vertices, edges).items() if v != r}
