"""Whitening of embeddings by shifted CholeskyQR.

The centred vectors are the rows of a tall matrix that no task holds.  Each Gram pass multiplies
the rows, made orthogonal so far, with themselves, in tasks, and sums the d x d products by
shuffles.  The driver factors that matrix, d x d at any number of rows, by Cholesky, at first
with a shift that makes it positive definite for certain; the next pass solves the rows
against the triangular factor.  One shifted pass brings the condition down, one or two more make
the rows orthonormal up to what the last Gram matrix says, so that the composed factors R hold
all of the covariance without its condition being squared.  The singular values of R and its
right singular vectors are those of the centred rows.

Vectors are taken as whole numbers, so that sums, means and deviations are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: A coordinate c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Coordinates whose whole number lies beyond are taken for not finite.
LARGEST = 1 << 43
#: Coordinates worked on at a time.
_BLOCK = 1 << 20
#: Gram eigenvalues of orthonormal rows, and of directions without any variance.
_ROUND, _NONE = 0.5, 1e-10
_MAX_PASSES = 6


def _valid(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole-number coordinates of a list column; first place, length and validity of each row."""
    if pa.types.is_fixed_size_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    offset = column.offsets.to_numpy()
    values = column.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore"):
        whole = np.floor(SCALE * values) + OFFSET
        bad = ~(np.abs(whole) <= LARGEST)
    before = np.concatenate([[0], np.cumsum(bad)])
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (before[offset[1:]] == before[offset[:-1]])
    return np.where(bad, 0, whole).astype(np.int64), offset[:-1], np.diff(offset), ok


def _blocks(column: pa.Array, dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of valid vectors of this length, some at a time, and their coordinates."""
    whole, first, length, ok = _valid(column)
    rows = np.flatnonzero(ok & (length == dimensions))
    step = max(1, _BLOCK // max(1, dimensions))
    for i in range(0, len(rows), step):
        some = rows[i : i + step]
        yield some, whole[first[some][:, None] + np.arange(dimensions)]


def _sums(vectors: DataFrame) -> dict[int, tuple[int, list[int], int]]:
    """For each length of valid vectors: how many, sums by dimension, largest coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray, int]] = {}
        for batch in batches:
            _, _, length, ok = _valid(batch.column(0))
            for d in np.unique(length[ok & (length > 0)]).tolist():
                for some, x in _blocks(batch.column(0), d):
                    n, total, top = found.get(d, (0, np.zeros(d, object), 0))
                    found[d] = n + len(some), total + x.sum(axis=0).astype(object), max(top, int(np.abs(x).max()))
        for d, (n, total, top) in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d] * d, pa.int32()),
                    pa.array(range(d), pa.int32()),
                    pa.array([n] * d, pa.int64()),
                    pa.array([str(t) for t in total]),
                    pa.array([top] * d, pa.int64()),
                ],
                ["d", "i", "n", "total", "top"],
            )

    parts = vectors.mapInArrow(run, "d int, i int, n long, total string, top long")
    sums = parts.groupBy("d", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.max("top").alias("top")
    )
    out: dict[int, tuple[int, list[int], int]] = {}
    for d, _, n, total, top in sums.orderBy("d", "i").collect():
        out.setdefault(d, (n, [], 0))[1].append(int(total))
        out[d] = n, out[d][1], max(out[d][2], top)
    return out


class _Centred:
    """Rows n * x - S, as exact whole numbers, and divided by n."""

    def __init__(self, n: int, total: list[int], top: int) -> None:
        # Beyond 64 bits they are Python's numbers.
        small = 2 * n * top < 1 << 62
        self.n, self.total = n, np.array(total, np.int64 if small else object)

    def exact(self, x: np.ndarray) -> np.ndarray:
        return x.astype(self.total.dtype) * self.n - self.total

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n * x - S, where a long can hold it."""
        y = self.exact(x)
        if (y.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 1 << 62:
            return (y * y).sum(axis=1).tolist()
        sums = (y.astype(object) ** 2).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in sums]


def solve_rows(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Q with Q @ upper = rows, by substitution, for all rows at once."""
    out = np.empty_like(rows.T)  # by columns, which the steps below walk through
    for j in range(len(upper)):
        out[j] = (rows[:, j] - upper[:j, j] @ out[:j]) / upper[j, j]
    return out.T


def _gram(vectors: DataFrame, dimensions: int, rows: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of products of the rows with themselves, over all vectors."""
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _blocks(batch.column(0), dimensions):
                q = rows(x)
                total += q.T @ q
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"]
        )

    parts = vectors.mapInArrow(run, "i int, j int, v double")
    sums = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((size, size))
    a, b = sums["i"].to_numpy(), sums["j"].to_numpy()
    out[a, b] = out[b, a] = sums["v"].to_numpy()
    return out


def _factors(vectors: DataFrame, centred: _Centred, dimensions: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Singular values and right singular vectors of the centred rows, and their squared norm."""
    steps: list[np.ndarray] = []

    def rows(x: np.ndarray) -> np.ndarray:
        q = centred.rows(x)
        for upper in steps:
            q = solve_rows(q, upper)
        return q

    composed, norm2 = np.eye(dimensions), 0.0
    unit = np.finfo(float).eps / 2
    for number in range(_MAX_PASSES):
        gram = _gram(vectors, dimensions, rows, dimensions)
        if not number:
            norm2 = float(np.trace(gram))
            if norm2 == 0:
                return np.zeros(0), np.zeros((0, dimensions)), 0.0
        else:
            value, vector = np.linalg.eigh(gram)
            settled = (value > _ROUND) | (value < _NONE)
            if settled.all() or number == _MAX_PASSES - 1:
                break
        # The bound of shifted CholeskyQR, with the trace for the squared norm.
        shift = 11 * (centred.n * dimensions + dimensions * (dimensions + 1)) * unit * np.trace(gram)
        upper = np.linalg.cholesky(gram + min(shift, np.trace(gram)) * np.eye(dimensions)).T
        steps.append(upper)
        composed = upper @ composed
    held = value > _NONE  # directions in which there is any variance
    root = np.sqrt(value[held])[:, None] * vector[:, held].T
    _, sigma, right = np.linalg.svd(root @ composed, full_matrices=False)
    return sigma, right, norm2


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Vectors projected on their principal components, each divided by its standard deviation.

    Returns for each vector and component: the id, ``component`` (int from 1, by falling variance),
    ``n`` (vectors in the fit), ``deviation`` (sum over dimensions of (n * x - S) squared, exact,
    where x are the whole-number coordinates and S their sums; null beyond 64 bits), ``whitened``,
    ``explained`` (share of the total variance) and ``identity_error`` (how far the covariance of
    all whitened vectors is from the identity, one value for all).

    A null vector, one with a null or non-finite coordinate (or one beyond 2**43 as a whole number)
    and one of another length than most (of equals, the longer) is left out.  Repeated rows and
    null ids count each for itself; other columns are ignored.  There are no more components than
    directions with any variance, so a single vector, or equal ones, give no rows, like an empty
    table.  The table is read once for the sums and once for each pass; store it if it is
    costly to compute.
    """
    only = vectors.select(F.col(vector_column).alias("v"))
    schema = T.StructType([T.StructField("vec_id", vectors.schema[id_column].dataType)])
    for name, kind in (
        ("component", "int"), ("n", "long"), ("deviation", "long"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ):
        schema = schema.add(name, T.DataType.fromDDL(kind))
    sums = _sums(only)
    if not sums:
        return vectors.sparkSession.createDataFrame([], schema)
    dimensions = max(sums, key=lambda d: (sums[d][0], d))
    n = sums[dimensions][0]
    centred = _Centred(*sums[dimensions])
    sigma, right, norm2 = _factors(only, centred, dimensions)
    sigma, right = sigma[:components], right[:components]
    k = len(sigma)
    # Either sign is right; the largest coordinate is made positive, the same on every run.
    largest = np.abs(right).argmax(axis=1)
    right = right * np.where(right[np.arange(k), largest] < 0, -1, 1)[:, None]
    explained = sigma**2 / norm2 if k else sigma
    weights = (right / (sigma / np.sqrt(n))[:, None]).T

    def whitened(x: np.ndarray) -> np.ndarray:
        return centred.rows(x) @ weights

    # The whitened vectors' mean is zero, as the rows are centred by exact sums.
    error = float(np.abs(_gram(only, dimensions, whitened, k) / n - np.eye(k)).max()) if k else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, x in _blocks(batch.column(1), dimensions):
                each, m = np.repeat(np.arange(len(some)), k), len(some) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(some[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(some))),
                        pa.array(np.full(m, n)),
                        pa.array(centred.deviation(x), pa.int64()).take(pa.array(each)),
                        pa.array(whitened(x).ravel()),
                        pa.array(np.tile(explained, len(some))),
                        pa.array(np.full(m, error)),
                    ],
                    schema.names,
                )

    return vectors.select(id_column, F.col(vector_column).alias("v")).mapInArrow(run, schema)
