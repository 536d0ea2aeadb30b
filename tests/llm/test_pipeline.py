"""Every stage on what the stage before has left, against brute force on whole texts."""

import corpus_pipeline as C
import pytest

from . import test_decontamination, test_quality, test_recompression, test_simhash
from .conftest import plain
from .test_packing import check
from .test_tokens import encoder, whole  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def ids(docs):
    return sorted(r.doc_id for r in docs.collect())


def test_stages(spark, encoder):  # noqa: F811
    assert [name for name, _ in C.STAGES] == [
        "quality_rules", "near_duplicates", "substring_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, left = docs.schema, {r.doc_id: r for r in docs.collect()}
    stage = dict(C.STAGES)

    def run(name, rows):
        out = C.stored(stage[name](spark, rows, FOLDER), f"test-{name}")
        assert out.schema == columns or name == "best_fit_packing"
        return out

    docs = run("quality_rules", docs)
    verdict = test_quality.verdict([(r.doc_id, r.lang, r.source, r.text) for r in left.values()])
    left = {i: r for i, r in left.items() if verdict[i][1]}
    assert ids(docs) == sorted(left)

    docs = run("near_duplicates", docs)
    component = {i: c for i, _, c in test_simhash.wanted([(r.doc_id, r.text) for r in left.values()])}
    left = {i: r.text for i, r in left.items() if component[str(i)] == str(i)}
    assert ids(docs) == sorted(left)

    docs = run("substring_dedup", docs)
    cut = test_recompression.wanted(list(left.items()))
    words = {int(i): text for i, n, gone, text in cut if gone < n or not n}
    rows = docs.collect()
    assert {r.doc_id: " ".join(plain(r.text)) for r in rows} == words
    assert all(r.n_chars == len(r.text) for r in rows if r.text != left[r.doc_id])
    assert {r.doc_id for r in rows if r.text == left[r.doc_id]} >= {int(i) for i, _, gone, _ in cut if not gone}
    left = {r.doc_id: r.text for r in rows}

    docs = run("benchmark_decontamination", docs)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hit = {int(i) for i, _, n_hit, _, _ in test_decontamination.wanted(list(left.items()), items) if n_hit}
    left = {i: t for i, t in left.items() if i not in hit}
    assert hit and ids(docs) == sorted(left)

    rows = run("best_fit_packing", docs).collect()
    order = sorted(left.items())
    check(rows, order, whole(encoder, [t for _, t in order]), 1024)


def test_run_takes_the_stages_in_turn(spark, monkeypatch):
    seen = []

    def stage(name):
        def run(spark, docs, sf_dir):
            seen.append((name, docs.count()))
            return docs.where(f"doc_id % {len(seen) + 1} = 0")

        return name, run

    monkeypatch.setattr(C, "STAGES", [stage("a"), stage("b")])
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert C.run(spark, FOLDER).where("doc_id % 6 <> 0").count() == 0
    assert seen == [("a", n), ("b", n // 2)]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents_pass_every_stage(spark, odd, nothing, empty):
    docs = nothing if empty else odd
    for name, stage in C.STAGES:
        docs = C.stored(stage(spark, docs, FOLDER), f"odd-{name}")
        if name != "best_fit_packing":
            assert set(docs.columns) == set(odd.columns)
    assert docs.count() == 0 if empty else docs.count() > 0
