"""CSV scans with a fixed schema (S2) or inferred types.

``base`` is any Hadoop path or URI (S4).  Quotes inside a quoted field are
doubled, so the escape character is the quote itself.  ``enforceSchema=false``
makes a file whose header differs from the schema fail instead of binding its
columns by position.  A malformed cell becomes NULL; ``operators.quality``
counts those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rankspark.schemas import CSV_NAMES, ITEMS_CSV, RATINGS_CSV

_DIALECT = {"header": True, "escape": '"', "mode": "PERMISSIVE"}


#: Column with the line of a row that does not fit the schema.
REJECTED = "_rejected_line"


def read_items(spark: SparkSession, base: str, infer: bool = False, checked: bool = False) -> DataFrame:
    return _read(spark, f"{base.rstrip('/')}/movies.csv", ITEMS_CSV, infer, checked)


def read_ratings(spark: SparkSession, base: str, infer: bool = False, checked: bool = False) -> DataFrame:
    return _read(spark, f"{base.rstrip('/')}/ratings.csv", RATINGS_CSV, infer, checked)


def accepted(checked: DataFrame) -> DataFrame:
    """The rows of a checked scan whose lines fit the schema: types and number of columns."""
    return checked.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(checked: DataFrame) -> DataFrame:
    """The other lines of a checked scan as they stand in the file, and what could be read of them."""
    rest = [c for c in checked.columns if c != REJECTED]
    return checked.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"), *rest)


def _read(spark: SparkSession, path: str, schema: T.StructType, infer: bool, checked: bool) -> DataFrame:
    reader = spark.read.options(**_DIALECT)
    if checked:
        if infer:
            raise ValueError("a checked scan needs the fixed schema")
        reader = reader.option("columnNameOfCorruptRecord", REJECTED)
        schema = T.StructType([*schema, T.StructField(REJECTED, T.StringType())])
    if infer:
        # Costs one more pass over the file; meant for small or unknown inputs.
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.option("enforceSchema", False).schema(schema).csv(path)
    if checked:
        # A scan tests only the cells that are asked for, so the line asks for all of them.
        cells = F.xxhash64(*(c for c in df.columns if c != REJECTED))
        df = df.withColumn(REJECTED, F.when(cells <= F.lit((1 << 63) - 1), F.col(REJECTED)))
    return df.withColumnsRenamed(CSV_NAMES)
