import random

import numpy as np
import pyarrow as pa
import pytest
from rankspark.llm import words as W

from .conftest import ODD, alnum, plain, thue_morse


def texts():
    rng = random.Random(4)
    return [t for _, t in ODD] + ["".join(rng.choices("ab é\n\t Zz1ß", k=rng.randrange(30))) for _ in range(500)]


@pytest.mark.parametrize("size", [16, 1 << 21])
@pytest.mark.parametrize(("table", "low", "wanted"), [(W.PLAIN, False, plain), (W.ALNUM, True, alnum)])
def test_words_and_their_names(monkeypatch, size, table, low, wanted):
    monkeypatch.setattr(W, "CHUNK_BYTES", size)
    column = pa.array([None, *texts(), "end"])[1:]  # a slice, so that offsets do not start at 0
    found, names = [], {}
    for c in W.chunks(column, table, low):
        assert c.row == len(found)
        name = c.names()
        for i in range(len(c)):
            own = range(c.first[i], c.first[i + 1])
            found.append([c.data[c.start[k] : c.end[k]].tobytes().decode() for k in own])
            for k, word in zip(own, found[-1], strict=True):
                assert names.setdefault(word, name[k]) == name[k]
    assert found == [wanted(t) for t in column.to_pylist()]
    assert len(set(names.values())) == len(names)


def test_spans_have_equal_names_wherever_they_stand():
    values = W.mix(np.array([5, 1, 2, 3, 9, 1, 2, 3, 1, 2], np.uint64))
    prefix = W.prefix_hashes(values)
    name = W.span_hash(prefix, np.array([1, 5, 0, 1]), np.array([4, 8, 3, 3]))
    assert name[0] == name[1]
    assert len(set(name.tolist())) == 3


def test_no_text():
    assert not list(W.chunks(pa.array([], pa.string()), W.PLAIN))


@pytest.mark.parametrize("n", [256, 512, 1024, 4096])
def test_names_of_long_words(n):
    words = ["".join(w) for w in thue_morse(n, "a", "b")]
    (c,) = W.chunks(pa.array([" ".join(words), words[1]]), W.PLAIN)
    name = c.names()
    assert len(set(name.tolist())) == 2 and name[1] == name[2]


@pytest.mark.parametrize("n", [600, 1024, 2048])
def test_names_of_long_windows_and_texts(n):
    sides = thue_morse(n, "x", "y")
    texts = [" ".join(side) for side in sides] + ["z " + " ".join(sides[0])]
    (c,) = W.chunks(pa.array(texts), W.PLAIN)
    names = c.names()
    window = W.window_hash(names, n)
    assert window[0] != window[n] and window[0] == window[2 * n + 1]
    first, second = c.contents(names)
    assert len(set(first.tolist())) == len(set(second.tolist())) == 3


@pytest.mark.parametrize("window", range(1, 20))
def test_windows_have_equal_names_where_they_are_equal(window):
    rng = np.random.default_rng(window)
    values = rng.integers(0, 2, 400)
    names = W.window_hash(W.mix(values.astype(np.uint64)), window)
    seen = {}
    for i in range(len(values) - window + 1):
        assert seen.setdefault(tuple(values[i : i + window]), names[i]) == names[i]
    assert len(set(seen.values())) == len(seen)
