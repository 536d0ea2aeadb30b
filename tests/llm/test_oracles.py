"""Every query of the subpackage that SQL can express, against its SQL."""

import duckdb
import pytest
from rankspark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql_agree(spark, views, name):
    df = QUERIES[name](spark, FOLDER)
    wanted = views.execute(ORACLES[name])
    order = [[c[0] for c in wanted.description].index(c) for c in df.columns]
    assert sorted(df.columns) == sorted(c[0] for c in wanted.description)
    rows = sorted(tuple(repr(r[k]) for k in order) for r in wanted.fetchall())
    assert sorted(tuple(map(repr, r)) for r in df.collect()) == rows


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_every_operator_has_its_query():
    assert [q.partition("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
