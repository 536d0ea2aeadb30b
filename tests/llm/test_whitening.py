import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from rankspark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, 0, "n", "c") for i, v in rows], SCHEMA).repartition(partitions)


def brute(rows, k=W.COMPONENTS):
    """Plain eigenvectors of the covariance, in exact sums."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows])
    n, total = len(x), x.sum(axis=0)
    y = n * x - total
    centred = y / n
    _, sigma, v = np.linalg.svd(centred, full_matrices=False)
    e = sigma**2 / n
    k = min(k, int((sigma > 1e-10 * sigma[0]).sum()))
    return n, (y.astype(object) ** 2).sum(axis=1), e[:k], e[:k] / e.sum(), centred @ v[:k].T / np.sqrt(e[:k])


def check(spark, rows, good=None):
    good = rows if good is None else good
    n, deviation, e, explained, wanted = brute(good)
    found = W.whiten(frame(spark, rows)).toPandas().sort_values(["vec_id", "component"])
    k = len(e)
    assert len(found) == n * k and set(found["n"]) == {n}
    ids = np.array([i for i, _ in good])
    order = np.argsort(ids, kind="stable")
    assert (found["vec_id"].to_numpy() == np.repeat(ids[order], k)).all()
    assert found["deviation"].tolist() == np.repeat(deviation[order], k).tolist()
    ours = found["whitened"].to_numpy().reshape(n, k)
    theirs = wanted[order]
    signs = np.sign((ours * theirs).sum(axis=0))
    np.testing.assert_allclose(ours, theirs * signs, atol=1e-7)
    np.testing.assert_allclose(found["explained"].to_numpy()[:k], explained, rtol=1e-9)
    assert (found["identity_error"] < 1e-9).all() and found["identity_error"].nunique() == 1


@pytest.mark.parametrize("n, d, spread", [(300, 12, 1.0), (200, 3, 1.0), (5, 9, 1.0), (400, 10, 300.0)])
def test_against_eigenvectors(spark, n, d, spread):
    rng = np.random.default_rng(n)
    scale = spread ** np.linspace(0, 1, d)
    mixed = rng.normal(size=(n, d)) * scale @ np.linalg.qr(rng.normal(size=(d, d)))[0]
    check(spark, [(i, v) for i, v in enumerate(mixed.tolist())])


def test_nearly_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(7)
    v = rng.integers(-4000, 4000, size=(500, 5)) / 1024
    rows = np.column_stack([v, v[:, 0] + v[:, 1], np.full(500, 3.0), v[:, 2]])
    rows[0, 7] += 1 / 1024
    check(spark, [(i, v) for i, v in enumerate(rows.tolist())])


def test_invalid_vectors_are_left_out(spark):
    rng = np.random.default_rng(1)
    good = [(i, v) for i, v in enumerate(rng.normal(size=(40, 4)).tolist())]
    bad = [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [1.0, math.nan, 2.0, 3.0]), (93, [math.inf, 0.0, 0.0, 0.0]),
           (94, []), (95, [1.0, 2.0]), (96, [1e30, 0.0, 0.0, 0.0])]
    check(spark, bad[:3] + good + bad[3:], good)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)], [(None, [])]])
def test_nothing_to_whiten(spark, rows):
    found = W.whiten(frame(spark, rows))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 0


def test_repeated_rows_null_ids_and_other_types(spark):
    rows = [(None, [1.0, 2.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (4, [-2.0, 0.5])]
    found = W.whiten(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == [(0, 1), (0, 2), (2, 1), (2, 1), (2, 2), (2, 2), (4, 1), (4, 2)]
    doubles = frame(spark, rows).withColumn("embedding", F.col("embedding").cast("array<double>"))
    again = W.whiten(doubles.withColumnRenamed("vec_id", "name"), id_column="name").collect()
    key = lambda r: (r["component"], r["whitened"])
    assert [r["deviation"] for r in sorted(again, key=key)] == [r["deviation"] for r in sorted(found, key=key)]


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [float(2**31 * (i % 2)), float(i)]) for i in range(6)]
    found = W.whiten(frame(spark, rows)).collect()
    assert {r["deviation"] for r in found} == {None}
    assert all(r["identity_error"] < 1e-6 for r in found)


def test_solve_rows():
    rng = np.random.default_rng(2)
    upper = np.triu(rng.normal(size=(6, 6))) + 4 * np.eye(6)
    rows = rng.normal(size=(9, 6))
    np.testing.assert_allclose(W.solve_rows(rows, upper) @ upper, rows)
