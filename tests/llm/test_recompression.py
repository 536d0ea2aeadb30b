import hashlib
import random

import numpy as np
import pytest
from rankspark.llm import recompression as R, words as W

from .conftest import ODD, babble, plain, thue_morse


def wanted(docs, window=R.WINDOW):
    least = {}
    for i, text in docs:
        words = plain(text)
        for k in range(len(words) - window + 1):
            seq = tuple(words[k : k + window])
            key = float("-inf") if i is None else i
            least[seq] = min(key, least.get(seq, key))
    out = []
    for i, text in docs:
        words = plain(text)
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < (float("-inf") if i is None else i):
                gone.update(range(k, k + window))
        out.append((str(i), len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 10, 1000])
@pytest.mark.parametrize("rounds", [1, 3, 5])
def test_equal_windows_have_equal_keys(alphabet, rounds):
    rng = np.random.default_rng(alphabet)
    size = rng.integers(0, 60, 80)
    words = rng.integers(0, alphabet, size.sum())
    if alphabet > 2:  # long repeats, in other surroundings
        words[500:560] = words[100:160]
        words[900:960] = words[100:160]
    first = np.concatenate([[0], np.cumsum(size)])
    at, key, doc = R.window_keys(W.mix(words.astype(np.uint64)), first, 13, rounds)
    assert len(at) == sum(max(0, n - 12) for n in size)
    seen = {}
    for p, k, d in zip(at, key, doc, strict=True):
        assert first[d] <= p <= first[d + 1] - 13
        assert seen.setdefault(tuple(words[p : p + 13]), k) == k


@pytest.mark.parametrize("alphabet", ["a", "ab", "abc", [f"w{i}" for i in range(40)]])
@pytest.mark.parametrize("window", [5, 13])
def test_removed_words_against_brute_force(spark, alphabet, window):
    docs = babble(len(alphabet) + window, 60, 60, alphabet)
    rows = R.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), window, joined=True)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in rows.collect()) == wanted(docs, window)


def test_odd_documents(odd, nothing):
    rows = R.remove_repeats(odd, joined=True).collect()
    found = sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in rows)
    assert found == wanted(ODD)
    cut = R.remove_repeats(odd)
    assert set(cut.columns) == {*odd.columns, "n_removed"}
    rows = cut.collect()
    assert sorted((str(r.doc_id), " ".join(plain(r.text))) for r in rows) == sorted((i, t) for i, _, _, t in wanted(ODD))
    assert sum(r.text is None for r in rows) == sum(t is None for _, t in ODD)
    whole = {(i, t) for i, t in ODD}
    assert all((r.doc_id, r.text) in whole for r in rows if not r.n_removed)
    assert R.remove_repeats(nothing).count() == 0


def test_a_passage_that_many_documents_share(spark):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for i in range(300):
        around = [f"{rng.random()}" for _ in range(40)]
        docs.append((i, " ".join(around[:20] + passage + around[20:])))
    rows = R.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), joined=True).collect()
    assert all(r.n_removed == (60 if r.doc_id else 0) for r in rows)
    assert {hashlib.sha256(r.text.encode()).hexdigest() for r in rows if r.doc_id} == {
        hashlib.sha256(" ".join(w for w in t.split() if w not in passage).encode()).hexdigest() for i, t in docs if i
    }


@pytest.mark.parametrize("n", [1024, 2048])
def test_texts_that_a_polynomial_names_alike(spark, n):
    sides = [" ".join(side) for side in thue_morse(n, "x", "y")]
    words = ["".join(w) for w in thue_morse(n, "a", "b")]
    end = " c d e f g h i j k l m n"  # with one word before it, a window
    rows = [(1, "x y " + sides[0]), (2, "x y " + sides[1]), (3, words[0] + end), (4, words[1] + end)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = R.remove_repeats(docs, joined=True)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in cut.collect()) == wanted(rows)
