"""Connected components by alternating star contractions, over shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankspark.llm.tables import stored


def _contract(edges: DataFrame, name: str) -> DataFrame:
    """Hang the far ends ``v`` of each ``u`` below the least vertex next to ``u``.

    The minima are stored first: both sides of the join are then plain shuffles, of which
    adaptive execution can split the partition of a vertex with very many edges.
    """
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
    least = least.withColumn("m", F.least("u", "m"))
    hung = edges.join(least, "u").where(F.col("v") != F.col("m")).select("v", "m")
    own = least.where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), "m")
    return hung.union(own).select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b"))


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) of long -> (v, root): the least vertex that each vertex with an edge reaches.

    Duplicate edges, loops and either order of the ends are allowed; a null end makes no
    edge.  A vertex that has no edge but a loop is absent from the result.  Rounds grow
    with the logarithm of the longest path.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), name)
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = stored(_contract(both, name).where("a != b").distinct(), name)
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = stored(_contract(down, name).where("a != b").distinct(), name)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
