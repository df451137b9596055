"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the undirected ``edges(a long, b long)``; the root is the component's smallest node.

    Alternating star contraction: every node hooks its larger neighbours to its smallest one (large star), then its smaller
    ones (small star), until nothing changes. Both steps group by node with a combined minimum and join the edges back, so
    a hub of any degree is never gathered in one place; the number of rounds grows with the logarithm of the longest chain.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, seen = staged(pairs, "edges"), None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = pairs.union(pairs.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.repartition(F.xxhash64("u")), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.repartition(F.xxhash64("u")), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        pairs = staged(small.select("e.*").where("u <> v").distinct(), "edges")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
