"""Listings of the stored tables with search, facets and paging."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F

from rankspark.functions import contains_any, search_terms
from rankspark.operators.facets import facet_filter, facet_filter_date
from rankspark.operators.paging import in_rank_order, page
from rankspark.schemas import Table

_THROUGH_ITEM = "item."


def search(df: DataFrame, table: Table, query: str, items: DataFrame | None = None) -> DataFrame:
    """Rows in which every search term occurs in one of the searched columns.

    Rows whose own columns hold all terms need no join.  The others are joined, inner, with
    the items whose title holds a term that the row lacks; titles are tested once per item.
    """
    terms = search_terms(query)
    if not terms:
        return df
    own = [F.col(name) for name in table.searched if name == _plain(name)]
    reached = [F.col(_plain(name)) for name in table.searched if name != _plain(name)]
    tests = [contains_any(own, t) for t in terms] if own else [F.lit(False) for _ in terms]
    tests = [F.coalesce(t, F.lit(False)) for t in tests]
    alone = reduce(and_, tests)
    if not reached:
        return df.filter(alone)
    hits = {f"_hit_{i}": F.coalesce(contains_any(reached, t), F.lit(False)) for i, t in enumerate(terms)}
    matching = (
        _required(items)
        .select("movie_id", *(test.alias(name) for name, test in hits.items()))
        .filter(reduce(or_, map(F.col, hits)))
        .groupBy("movie_id")
        .agg(*(F.max(name).alias(name) for name in hits))
    )
    joined = df.filter(~alone).join(matching, "movie_id")
    both = reduce(and_, (t | F.col(name) for name, t in zip(hits, tests)))
    through_item = joined.filter(both).select(*df.columns)
    return through_item if not own else df.filter(alone).unionByName(through_item)


def browse(
    df: DataFrame,
    table: Table,
    items: DataFrame | None = None,
    query: str = "",
    facets: dict[str, object] | None = None,
    dates: dict[str, tuple[str, dt.date]] | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """One page of a table in its default order: ``rank`` and the listed columns.

    Facets filter first and reach the scan.  Titles are joined to the finished page, which
    stays whole: a row without item has no title.
    """
    for column, value in (facets or {}).items():
        df = facet_filter(df, _known(column, table.facets), value)
    for column, (bucket, as_of) in (dates or {}).items():
        df = facet_filter_date(df, _known(column, table.date_facets), bucket, as_of)
    df = search(df, table, query, items)
    order = [*table.order, *((name, False) for name in table.tie_break)]
    size = table.page_size if limit is None else limit
    listed = [_plain(name) for name in table.listed]
    needed = {*listed, *(name for name, _ in order), *table.references}
    rows = page(df.select(*(c for c in df.columns if c in needed)), order, size, offset)
    if "title" in listed and "title" not in rows.columns:
        rows = with_title(rows, items)
    return in_rank_order(rows.select("rank", *listed))


def with_title(rows: DataFrame, items: DataFrame | None) -> DataFrame:
    """Add the item title, or NULL; the item table is first cut down to the items of the rows."""
    titles = _required(items).select("movie_id", "title")
    wanted = titles.join(rows.select("movie_id"), "movie_id", "left_semi")
    return rows.join(wanted, "movie_id", "left")


def _required(items: DataFrame | None) -> DataFrame:
    if items is None:
        raise ValueError("this listing needs the item table for its titles")
    return items


def _plain(name: str) -> str:
    return name.removeprefix(_THROUGH_ITEM)


def _known(column: str, allowed: tuple[str, ...]) -> str:
    if column not in allowed:
        raise ValueError(f"no facet on {column!r}; facets: {', '.join(allowed) or 'none'}")
    return column
