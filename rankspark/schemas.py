"""Table contracts: columns, types, defaults, keys and browse settings.

The contracts drive the sinks (``conform``), the rule checks in
``operators.quality`` and the listings in ``operators.browse``.  Ids and counts
are 64-bit here: one hot item can pass 2**31 ratings long before the data
reaches 100 TB.  ``conform(..., narrow=True)`` casts to the 32-bit types of an
already existing store, and fails on a value that does not fit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

ITEMS_CSV = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

RATINGS_CSV = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# CSV header name -> column name used everywhere else.
CSV_NAMES = {"movieId": "movie_id", "userId": "user_id"}


@dataclass(frozen=True)
class Col:
    name: str
    type: str
    narrow: str | None = None
    required: bool = False
    max_length: int | None = None
    default: object = None


@dataclass(frozen=True, eq=False)
class Table:
    name: str
    columns: tuple[Col, ...]
    unique: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    # Listing settings; "item.title" reaches through the item reference.
    listed: tuple[str, ...] = ()
    searched: tuple[str, ...] = ()
    facets: tuple[str, ...] = ()
    date_facets: tuple[str, ...] = ()
    # (column, descending) pairs; ``tie_break`` makes the order total.
    order: tuple[tuple[str, bool], ...] = ()
    tie_break: tuple[str, ...] = ()
    page_size: int = 100

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c.name}` {c.type}" for c in self.columns)


# Stored columns, lengths, defaults, listed and searched columns,
# orders and page sizes of the five stored tables.
ITEMS = Table(
    name="movies",
    columns=(
        Col("movie_id", "bigint", "int", required=True),
        Col("title", "string", required=True, max_length=500),
        Col("genres", "string", max_length=200),
        Col("year", "int"),
        Col("avg_rating", "double", required=True, default=0.0),
        Col("rating_count", "bigint", "int", required=True, default=0),
        Col("created_at", "timestamp", required=True),
        Col("updated_at", "timestamp", required=True),
    ),
    unique=("movie_id",),
    listed=("movie_id", "title", "genres", "year", "avg_rating", "rating_count", "created_at"),
    searched=("title", "movie_id", "genres"),
    facets=("year",),
    date_facets=("created_at",),
    order=(("avg_rating", True), ("rating_count", True)),
    tie_break=("movie_id",),
    page_size=50,
)

RATINGS = Table(
    name="ratings",
    columns=(
        Col("user_id", "bigint", "int", required=True),
        Col("movie_id", "bigint", "int", required=True),
        Col("rating", "double", required=True),
        Col("timestamp", "bigint", required=True),
        Col("created_at", "timestamp", required=True),
    ),
    unique=("user_id", "movie_id"),
    references={"movie_id": "movies"},
    listed=("user_id", "item.title", "rating", "timestamp", "created_at"),
    searched=("user_id", "item.title"),
    facets=("rating",),
    date_facets=("created_at",),
    order=(("created_at", True),),
    tie_break=("user_id", "movie_id", "rating", "timestamp"),
    page_size=100,
)

RECOMMENDATIONS = Table(
    name="recommendation_data",
    columns=(
        Col("movie_id", "bigint", "int", required=True),
        Col("recommendation_score", "double", required=True, default=0.0),
        Col("popularity_score", "double", required=True, default=0.0),
        Col("genre_match_score", "double", default=0.0),
        Col("user_id", "bigint", "int"),
        Col("created_at", "timestamp", required=True),
        Col("updated_at", "timestamp", required=True),
    ),
    references={"movie_id": "movies"},
    listed=("item.title", "recommendation_score", "popularity_score", "user_id", "created_at"),
    searched=("item.title", "user_id"),
    date_facets=("created_at",),
    order=(("recommendation_score", True),),
    tie_break=("movie_id",),
    page_size=50,
)

DATASETS = Table(
    name="raw_dataset",
    columns=(
        Col("id", "bigint", required=True),
        Col("data_file", "string", required=True, max_length=255),
        Col("upload_date", "timestamp", required=True),
        Col("processed", "boolean", required=True, default=False),
        Col("processed_date", "timestamp"),
        Col("record_count", "bigint", "int", required=True, default=0),
    ),
    unique=("id",),
    listed=("id", "data_file", "upload_date", "processed", "processed_date", "record_count"),
    searched=("data_file",),
    facets=("processed",),
    date_facets=("upload_date",),
    order=(("upload_date", True),),
    tie_break=("id",),
)

PREFERENCES = Table(
    name="user_preference",
    columns=(
        Col("user", "string", required=True),
        Col("favorite_categories", "string", max_length=500),
        Col("created_at", "timestamp", required=True),
        Col("updated_at", "timestamp", required=True),
    ),
    unique=("user",),
    listed=("user", "favorite_categories", "created_at", "updated_at"),
    searched=("user",),
    order=(("created_at", True),),
    tie_break=("user",),
)

#: What runs add up by item; kept beside the result tables, not listed anywhere.
STATISTICS = Table(
    name="item_statistics",
    columns=(
        Col("movie_id", "bigint"),
        Col("rating_sum", "double"),
        Col("rating_count", "bigint", required=True, default=0),
        Col("row_count", "bigint", required=True, default=0),
    ),
)

TABLES = {t.name: t for t in (ITEMS, RATINGS, RECOMMENDATIONS, DATASETS, PREFERENCES)}


def conform(df: DataFrame, table: Table, narrow: bool = False) -> DataFrame:
    """Project onto a contract: column order, types, insert defaults.

    A column the frame lacks is written as its default, or as a typed NULL.
    A NULL is replaced by the default only where the column may not be NULL.
    """
    present = set(df.columns)
    out = []
    for c in table.columns:
        if c.name not in present:
            value = F.lit(c.default)
        elif c.default is not None and c.required:
            value = F.coalesce(F.col(c.name), F.lit(c.default))
        else:
            value = F.col(c.name)
        value = value.cast(c.type)
        if narrow and c.narrow:
            value = _narrowed(value, c)
        out.append(value.alias(c.name))
    return df.select(*out)


def _narrowed(value: Column, c: Col) -> Column:
    """Checked cast; unlike a plain one it also fails where ANSI mode is off."""
    small = value.try_cast(c.narrow)
    failure = F.raise_error(F.concat(F.lit(f"{c.name} does not fit {c.narrow}: "), value))
    return F.when(value.isNotNull() & small.isNull(), failure.cast(c.narrow)).otherwise(small)
