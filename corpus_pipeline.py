"""The corpus pipeline: each stage keeps, cuts or packs what the stage before has left."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankspark.llm import decontamination, packing, quality, recompression, simhash
from rankspark.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _apart(docs: DataFrame) -> DataFrame:
    """Id and text, and all other columns in one, so that no name clashes with a result's."""
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others).alias("__others"))


def _together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    own = ("doc_id", "text")
    return rows.select(*[F.col(c if c in own else f"__others.`{c}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail a base rule or lie far from their language and source."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the least id."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages go that a smaller document holds too, and documents that have no word left.

    ``n_chars`` follows the text, where the text is cut.
    """
    cut = recompression.remove_repeats(_apart(docs))
    rest = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
    rest = rest.withColumn("__others", F.col("__others").withField("n_chars", F.coalesce(length, "__others.n_chars")))
    return _together(rest, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return _together(decontamination.contamination(_apart(docs), items).where("n_hit = 0"), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, and the sequences they are packed in."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Robust estimates, token ids and packing have no SQL form; tests/llm/test_pipeline.py holds
#: run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
