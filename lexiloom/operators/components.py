"""Connected components by alternating large-star and small-star steps.

Kiveris et al., *Connected Components in MapReduce and Beyond* (SoCC 2014).  Each step is one
shuffle with a map-side minimum; the edge list never grows beyond its first size, and nothing but
one counter per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.session import cut_lineage


def _neighbours(edges: DataFrame) -> DataFrame:
    """Both directions of every edge."""
    return edges.select(F.explode(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")


def _minimum(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Columns ``node, component``: every node of ``edges(u, v)`` with the least node it reaches.

    Null ends and loops are left out; an isolated node has no edge and hence no row.  The rounds grow
    as the logarithm of the longest chain; if they do not end within ``max_rounds``, that is an error.
    """
    edges = edges.select("u", "v").where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    edges = cut_lineage(edges.distinct())
    last = None
    for _ in range(max_rounds):
        both = _neighbours(edges)
        # large star: neighbours above u go to the least of u's neighbourhood
        large = both.join(_minimum(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: each node's lower neighbours, and the node itself, go to the least of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        edges = small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = cut_lineage(edges)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"the components have not settled in {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
