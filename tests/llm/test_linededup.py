import random
from collections import Counter

import pytest
from rankspark.llm import linededup as L

from tests import plan

from .conftest import ODD, lower

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, threshold):
    def keys(text):
        return [lower(line).strip(SPACE) for line in (text or "").split("\n")]

    held = Counter(k for _, text in rows for k in set(keys(text)) if k)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line, k in zip(lines, keys(text), strict=True) if not k or held[k] < threshold]
        out.append(repr((doc, len(lines), len(lines) - len(kept), "\n".join(kept))))
    return sorted(out)


def found(df):
    return sorted(repr((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"])) for r in df.collect())


@pytest.mark.parametrize("threshold, batches", [(2, 4), (3, 1), (10, 7)])
def test_against_counting(spark, threshold, batches):
    rng = random.Random(threshold)
    words = ["a", "B", "b ", " c", "É", "é", "", " ", "\td\r", "d", "Z z", "z Z", "rare"]
    rows = [(rng.randrange(60), "\n".join(rng.choices(words, k=rng.randrange(6)))) for _ in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(L.drop_frequent_lines(docs, threshold, batches=batches)) == brute(rows, threshold)


def test_odd_texts_and_clashing_names(spark, odd):
    named = odd.withColumnsRenamed({"lang": "n_lines", "source": "k1", "kept": "places", "spans": "row", "n_chars": "lines"})
    out = L.drop_frequent_lines(named, threshold=2)
    assert set(out.columns) == {*named.columns, "n_lines", "n_dropped"} and out.schema["n_lines"].dataType.typeName() == "long"
    assert found(out) == brute(ODD, 2)
    assert sorted(r["lines"] for r in out.collect()) == sorted(len(t or "") for _, t in ODD)


def test_no_documents(spark, nothing):
    assert L.drop_frequent_lines(nothing).collect() == []


def test_one_line_in_all_documents_and_many_copies(spark):
    rows = [(i, f"Menu\nown {i}\nmenu \n") for i in range(300)] + [(1000 + i, "same\ncopy") for i in range(150)] + [(5, "same")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(L.drop_frequent_lines(docs)) == brute(rows, 10)


def test_batches_of_documents(spark):
    rows = [[(10 * b + i, f"all\nbatch {b}\n{'late' if b else 'x'}") for i in range(4)] for b in range(5)]
    with L.LineRuns(spark, threshold=6) as runs:
        for batch in rows:
            runs.add(spark.createDataFrame(batch, "doc_id long, text string"))
        assert [r.level for r in runs.runs] == [2, 0]  # 4 + 1 batches
        flat = [row for batch in rows for row in batch]
        docs = spark.createDataFrame(flat, "doc_id long, text string")
        assert found(L.drop_lines(docs, L.hashed_lines(docs), runs.frequent())) == brute(flat, 6)
        names = [r.name for r in runs.runs]
        # A line known to be frequent is not written again: 20 documents hold it, 8 or 12 were counted.
        assert {r["n"] for r in spark.table(names[0]).where("n >= 6").collect()} <= {8, 12}
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_runs_are_merged_where_they_lie(spark):
    with L.LineRuns(spark) as runs:
        a, b = (runs._write(spark.createDataFrame([(i, i, 1)], "h1 long, h2 long, n long"), 0) for i in (1, 2))
        both = a.rows(spark).join(b.rows(spark).withColumnRenamed("n", "m").hint("merge"), ["h1", "h2"], "full")
        assert plan.count(both, "ShuffleExchange") == 0 and plan.count(both, "SortMergeJoin") == 1
