import random

import pytest
from rankspark.llm import decontamination as D

from .conftest import ODD, alnum, babble, lower

ITEMS = "item_id bigint, text string, n_hit string"


def wanted(docs, items, window=D.WINDOW):
    patterns = {}
    for i, text in items:
        words = alnum(text)
        if words and i is not None:
            for k in range(max(1, len(words) - window + 1)):
                patterns.setdefault(tuple(words[k : k + window]), set()).add(i)
    out = []
    for i, text in docs:
        words, hit, held = alnum(text), set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(words) - n + 1):
                if own := patterns.get(tuple(words[k : k + n])):
                    hit.update(range(k, k + n))
                    held |= own
        out.append((str(i), len(words), len(hit), sorted(held), [w for k, w in enumerate(words) if k in hit]))
    return sorted(out)


def found(spark, docs, items, **options):
    rows = D.contamination(docs, spark.createDataFrame([(*x, "n") for x in items], ITEMS), **options).collect()
    out = []
    for r in rows:
        own = [w for s in r.spans for w in alnum(r.text[s.start : s.end])]
        assert all(a.end <= b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
        out.append((str(r.doc_id), r.n_words, r.n_hit, r["items"], own))
    return sorted(out)


@pytest.mark.parametrize("alphabet", ["ab", ["É1", "zwölf", "x", "Y", "y", "-", "a_b"], [f"w{i}" for i in range(40)]])
@pytest.mark.parametrize("blocks", [1, 3])
def test_against_brute_force(spark, alphabet, blocks):
    docs = babble(1, 50, 60, alphabet)
    rng = random.Random(2)
    items = [(i, " , ".join(rng.choice(docs)[1].split()[: rng.randrange(25)])) for i in range(8)]
    items += [(3, "w1 w2"), (3, "w1 w2"), (None, "a b"), (20, None), (21, "?!"), (22, "X")]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    chars = sum(len(t or "") for _, t in items)
    assert found(spark, docs_df, items, block_words=-(-chars // (6 * blocks))) == wanted(docs, items)


def test_odd_documents(spark, odd, nothing):
    items = [(1, "c d e f g h i j k l m n"), (2, "la la"), (3, "größe UND"), (3, "größe"), (4, "x"), (5, "")]
    assert found(spark, odd, items) == wanted(ODD, items)
    rows = D.contamination(odd, spark.createDataFrame([], ITEMS))
    assert set(rows.columns) == {*odd.columns, "n_hit", "items"}
    assert all(r.n_hit == 0 and r["items"] == [] and r.spans == [] for r in rows.collect())
    assert D.contamination(nothing, spark.createDataFrame([(1, "a", "n")], ITEMS)).count() == 0


def test_spans_are_characters_of_the_original(spark):
    text = "Ünï 你好 — (Hello, WORLD)  ende"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "hello world")], "item_id long, text string")
    (row,) = D.contamination(docs, items).collect()
    assert [text[s.start : s.end] for s in row.spans] == ["Hello, WORLD"]
    assert lower(text[row.spans[0].start :]).startswith("hello")


def test_spans_of_one_and_of_several_scans(spark):
    """Items one after another, and with a word between: blocks give the stretches of one scan."""
    text = "One two, three / four five; six? x seven eight nine ten"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = [(1, "one two"), (2, "three four"), (3, "five six"), (4, "seven eight"), (5, "eight nine ten"), (6, "two three")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    spans = [
        [text[s.start : s.end] for s in D.contamination(docs, frame, block_words=n).first().spans] for n in (1000, 5, 3, 1)
    ]
    assert spans == [["One two, three / four five; six", "seven eight nine ten"]] * 4
