import re
from collections import Counter

import pyarrow as pa
import pytest
from rankspark.llm import queries as Q, urls as U

ODD = [
    "http://Example.ORG/en/1x?q#f", "https://a.example.org/es/", "https://a.example.org/es", "x://ORG/",
    "ftp://notexample.org/es/1", "http://com/fr/1", "http://a.com/de/?x", "http://a.com#/fr/", "http://a.com?/fr/",
    "no scheme.org/", "http://", "://", "a://b://c/d", "http://h\nost/p\nath#x", "http://ÄÖ.com/fr/é", "", None, None,
    "http://example.org/en/1", "http://sub.example.org/en/100/es/", "//x.org/", "http://" + "a" * 5000 + ".org/" + "b" * 5000,
]
RULES = {"org/": True, "example.org/es/": False, "example.org/en/1": False, "com/fr/": True, "com/de/": False}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = [
        r
        for r in RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])
    ]
    return max(fits, key=len, default=None)


@pytest.fixture(scope="module")
def model(spark):
    return U.fit(U.labelled_urls(spark))


def check(rows, urls, model):
    for r in rows:
        host, path = parts(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule(host, path))
        block = model.blocks(pa.array([host]), pa.array([path]))[0] if r.rule is None else not RULES[r.rule]
        assert r.verdict == ("block" if block else "allow")


def test_odd_urls(spark, model):
    rows = [(i, u, "x", "y") for i, u in enumerate(ODD)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    found = U.judge(pages, model, Q.RULES).collect()
    assert len(found) == len(ODD)
    check(found, dict(enumerate(ODD)), model)
    assert U.judge(pages.limit(0), model, Q.RULES).count() == 0
    assert U.judge(pages, model).where("rule IS NOT NULL").count() == 0


def test_whole_table(spark, model):
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    found = Q.op5_urls(spark, folder).collect()
    assert len(found) == len(pages)
    check(found, {r.page_id: r.url for r in pages}, model)


def test_held_out_accuracy(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select(U.host().alias("host"), U.path().alias("path"))
    rows = pages.distinct().toPandas()
    truth = rows["host"].str.contains("spam-farm|cheap-pills|casino-win|ads-track|free-bets|adult-x").to_numpy()
    found = model.blocks(pa.array(rows["host"]), pa.array(rows["path"]))
    assert found[truth].mean() > 0.9
    assert found[~truth].mean() < 0.02


def test_labels_of_one_kind_or_none(spark):
    none = spark.createDataFrame([("http://a/", None)], "url string, blocked boolean")
    one = spark.createDataFrame([("http://a/", True)], "url string, blocked boolean")
    for labelled in (none, one, none.limit(0)):
        assert not U.fit(labelled).blocks(pa.array(["a"]), pa.array(["/"]))[0]


def test_a_large_labelled_table_is_refused(spark, monkeypatch):
    monkeypatch.setattr(U, "LABELLED", 10)
    with pytest.raises(ValueError, match="labelled"):
        U.fit(U.labelled_urls(spark))


def test_grams_are_of_characters():
    texts = ["новости.рф", "abcdé", "新聞", "", None, "x", "a😀b"]
    row, bucket = U.grams(pa.array(texts), 1)
    names = {}
    for i, text in enumerate(texts):
        marked = f"\x02{text}\x03" if text else ""
        own = [marked[k : k + n] for n in U.GRAMS for k in range(len(marked) - n + 1)]
        found = bucket[row == i].tolist()
        assert len(found) == len(own)
        for gram, b in zip(own, found, strict=True):
            assert names.setdefault(gram, b) == b
    assert len(set(names.values())) == len(names)
    # Of ASCII, characters and bytes agree.
    assert Counter(row.tolist())[5] == 1
