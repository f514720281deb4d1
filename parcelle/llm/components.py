"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node that ``links`` (a, b) touch; ``root`` is the
    smallest node that it reaches. Only counts come to the driver; a node's
    minimum is combined per task before the exchange, and a node with very
    many links is a skewed join key that Spark splits."""
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        large = written(large, "large_star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small_star")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
