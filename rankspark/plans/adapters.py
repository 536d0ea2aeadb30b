"""Item, rating, dataset and preference frames from the TPC-H-like test tables.

Parts are items with a year and genres; suppliers are items without either and
nobody rates them.  Line items are half-star ratings of parts, orders stand for
uploaded datasets and customers for user preferences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

NTZ = "timestamp_ntz"

#: Suppliers come after all parts, so that the first items are rated ones.
SUPPLIER_BASE = 1_000_000_000

# Stating the types saves a job that would read file footers before every query.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = (F.col("p_size") + 1950).cast("string")
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.concat("p_name", F.lit(" ("), year, F.lit(")")).alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )


def supplier_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as items under their own keys, which overlap with the part keys."""
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("movie_id"),
        F.col("s_name").alias("title"),
        F.lit(None).cast("string").alias("genres"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers; supplier keys start at ``SUPPLIER_BASE`` to stay distinct."""
    unrated = supplier_items(spark, sf_dir)
    return part_items(spark, sf_dir).unionByName(
        unrated.withColumn("movie_id", F.lit(SUPPLIER_BASE) + F.col("movie_id"))
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
        (day * 86400).alias("timestamp"),
        F.col("l_shipdate").alias("created_at"),
    )


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = F.col("o_orderstatus") == "F"
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("orders-"), F.col("o_orderkey"), F.lit(".csv")).alias("data_file"),
        F.col("o_orderdate").alias("upload_date"),
        processed.alias("processed"),
        F.when(processed, F.col("o_orderdate")).alias("processed_date"),
        F.floor("o_totalprice").alias("record_count"),
    )


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, dated by their first and last order, if they have any."""
    dates = (
        load(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("created_at"), F.max("o_orderdate").alias("updated_at"))
    )
    return (
        load(spark, sf_dir, "customer")
        .join(dates, "c_custkey", "left")
        .select(
            F.col("c_name").alias("user"),
            F.col("c_mktsegment").alias("favorite_categories"),
            "created_at",
            "updated_at",
        )
    )
