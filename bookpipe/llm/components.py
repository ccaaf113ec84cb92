"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm.text import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger neighbours (or, in a small star, the smaller ones and the node) to the least one.

    The least neighbours are combined before the shuffle. The join back has a hub's edges under one key. Adaptive
    execution splits it if both sides are plain shuffles, which the hash as a second join column brings about.
    """
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    spread = F.xxhash64("a").alias("h")
    joined = edges.select("*", spread).join(least.select("*", spread), ["a", "h"])
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return out.filter("a != b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its least node.

    Each round is written to the shared folder. The rounds grow with the logarithm of the nodes.
    """
    edges = store(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = store(spark, _star(_star(edges, large=True), large=False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
