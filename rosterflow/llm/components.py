"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import work


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges (a, b)``; the component is its least node.

    Each round hooks the nodes of every edge to the least neighbour (of either side), and
    replaces the edges by these hooks: first towards larger neighbours, then towards
    smaller ones. Rounds end when every node points at its least node; their number grows
    with the logarithm of the longest path. A hub is one key of a minimum, which is
    combined before the shuffle, and of a join that Spark can split. Each round is
    written, so nothing but the last table is read again. Null ends, loops and repeated
    edges are ignored; no edges give no rows.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    # greatest() skips nulls, so an edge with one end is a loop
    links = work.written(pairs.where(F.col("u") != F.col("v")).distinct(), "component-links")
    before = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = larger.groupBy("u").agg(F.min("v").alias("m"))
        hooks = larger.join(down, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        links = work.written(hooks.distinct(), "component-links")
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            break
        before = state
    root = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(root.select("node", F.col("node").alias("component")))
