"""Top-k, pages with a global rank, and page arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from rankspark.runtime import prepare_checkpoints

Order = Sequence[tuple[str, bool]]

# monotonically_increasing_id: partition number above the low 33 bits.
_ROW_BITS = 33


def ordering(order: Order) -> list[Column]:
    """Sort columns from (name, descending) pairs; NULLs come last either way."""
    return [
        F.desc_nulls_last(name) if descending else F.asc_nulls_last(name)
        for name, descending in order
    ]


def top_n(df: DataFrame, order: Order, n: int) -> DataFrame:
    """The first n rows of ``df`` in ``order``, which must be total; sorted."""
    _check("n", n)
    return df.orderBy(*ordering(order)).limit(n)


def page(df: DataFrame, order: Order, limit: int = 20, offset: int = 0) -> DataFrame:
    """Rows offset+1 .. offset+limit of ``df`` with their ``rank`` in the whole; sorted.

    A top-k: each task keeps offset + limit rows at most, and one task merges them.  The
    rank is numbered over the page alone.  ``deep_page`` gives the same rows where
    offset + limit is more than one task should hold.
    """
    _check("limit", limit)
    _check("offset", offset)
    keys = ordering(order)
    rows = df.orderBy(*keys).offset(offset).limit(limit)
    place = F.row_number().over(Window.orderBy(*keys)).cast("bigint")
    return rows.withColumn("rank", place + F.lit(offset).cast("bigint"))


def in_rank_order(rows: DataFrame) -> DataFrame:
    """The rows of a ``page`` by rank again after joins; one task has merged them before."""
    return rows.repartition(1).sortWithinPartitions("rank")


#: Rows among which a round of ``deep_page`` chooses its bounds, and how many bounds it takes.
_SAMPLE, _BOUNDS = 1024, 31
#: Rows besides the page that one task may sort.
FEW = 100_000


def deep_page(df: DataFrame, order: Order, limit: int, offset: int, few: int = FEW) -> DataFrame:
    """The rows of ``page``, found by distributed selection: no row but those near the page is sorted.

    Each round takes some bounds from a bounded sample of the keys, counts exactly, in one pass
    without a shuffle, how many rows stand before each of them, and goes on between the two
    bounds that enclose the page.  That cuts the rows to about a thirtieth each time.  When at
    most ``few`` rows besides the page are left, they are a ``page`` of their own.
    The rounds run when this is called.  Like ``page`` it needs a total order.
    """
    _check("limit", limit)
    _check("offset", offset)
    keys = df.select(*(name for name, _ in order))
    low = high = F.lit(True)  # conditions of the rows between the bounds
    before, rows = 0, keys.count()
    while rows > limit + few:
        inside = keys.where(low & high)
        tests = [_stands_before(keys, order, bound) for bound in _bounds(inside, order)]
        if not tests:  # equal keys: no bound tells them apart
            break
        counts = inside.agg(*(F.count_if(test).alias(f"n{i}") for i, test in enumerate(tests))).first()
        first, last, left = 0, rows, rows
        for test, n in zip(tests, counts):
            if first < n <= offset - before:
                first, low = n, ~test
            if offset - before + limit <= n < last:
                last, high = n, test
        before, rows = before + first, last - first
        if rows == left:
            break
    found = page(df.where(low & high), order, limit, offset - before)
    return found.withColumn("rank", F.col("rank") + F.lit(before).cast("bigint"))


def _bounds(keys: DataFrame, order: Order) -> list[Row]:
    """Some keys, in order, that cut the rows into parts of about one size; the same on every call."""
    sample = keys.orderBy(F.xxhash64(*keys.columns)).limit(_SAMPLE).distinct()
    found = sample.orderBy(*ordering(order)).collect()
    return found[:: max(1, len(found) // (_BOUNDS + 1))][1:]


def _stands_before(df: DataFrame, order: Order, bound: Row) -> Column:
    """Whether a row of ``df`` comes before the bound."""
    out = F.lit(False)
    for name, descending in reversed(order):
        value, column = bound[name], F.col(name)
        if value is None:  # NULLs come last
            out = column.isNotNull() | out
            continue
        kind = df.schema[name].dataType
        ntz = isinstance(kind, T.TimestampNTZType)
        literal = F.lit(value.isoformat(" ") if ntz else value).cast(kind)
        nearer = column > literal if descending else column < literal
        out = F.coalesce(nearer, F.lit(False)) | (column.eqNullSafe(literal) & out)
    return out


def global_rank(df: DataFrame, order: Order) -> DataFrame:
    """Add each row's ``rank`` (from 1) in ``order`` without a single-task sort.

    Rows are range-partitioned and sorted within their partitions; a row's rank is
    its place there plus the sizes of all earlier partitions.  The placement is
    checkpointed before it is counted, because a range partitioning samples its
    input and a second evaluation could cut elsewhere.  The broadcast side has one
    row per partition.
    """
    prepare_checkpoints(df.sparkSession)
    keys = ordering(order)
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", place)
        .checkpoint()
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    row = F.col("_place") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("rank", F.col("_start") + row + 1)
        .drop("_place", "_part", "_start")
    )


def page_info(df: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """One row: total, page, total_pages, has_prev, has_next."""
    _check("limit", limit)
    _check("offset", offset)
    current = F.lit(offset // limit + 1 if limit else 1).cast("bigint")
    pages = F.ceil(F.try_divide(F.col("total"), F.lit(limit)))
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total",
        current.alias("page"),
        pages.alias("total_pages"),
        (current > 1).alias("has_prev"),
        F.coalesce(current < pages, F.lit(False)).alias("has_next"),
    )


def page_offset(number: int, limit: int) -> int:
    """Offset of page ``number``, counted from 1."""
    if number < 1:
        raise ValueError("page numbers start at 1")
    return (number - 1) * limit


def _check(name: str, value: int) -> None:
    if value < 0:
        raise ValueError(f"{name} must not be negative")
