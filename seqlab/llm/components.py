"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of an edge (columns ``a``, ``b``, any
    ordered type); the component is its smallest node.

    Each round links the larger neighbours of every node, then its smaller
    ones, to the smallest node around it; the table keeps at most one row per
    node and round-old neighbour, never pairs within a component. Rounds end
    when the edges stay the same (count and hash). Self-loops name nodes
    without links; an empty table gives an empty table.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct(), "edges")
    stamp = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now[0] == 0 or now == stamp:
            break
        stamp = now
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(small.union(least.select("u", "m")).distinct(), "edges")
    return nodes.join(e.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component"))
