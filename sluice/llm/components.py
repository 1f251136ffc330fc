"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch


def components(links: DataFrame, tmp: Scratch) -> DataFrame:
    """``links(a, b)`` to ``(node, component)``: the smallest node reachable, for each node with a link.

    Each round hangs every node's larger neighbours on its smallest one
    (large star), then its smaller ones (small star), until the stars stay as
    they are; rounds grow with the logarithm of the longest chain.  A node with
    many neighbours meets them only in a minimum (combined before the shuffle)
    and a join that adaptive execution may split.  Each round's links are
    written to the shared folder.
    """
    def stars(pairs: DataFrame) -> DataFrame:
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return pairs.join(low, "u")

    edges = tmp.keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = tmp.keep(large, "large")
        small = stars(large).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = tmp.keep(small.where("u <> v").distinct(), "links")
        tmp.drop(edges, large)
        edges = after
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state:
            break
        state = seen
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
