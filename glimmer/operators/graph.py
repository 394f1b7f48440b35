"""Connected components of graphs given as tables of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmer.operators.stencil import staged


def connected(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, node, label`` (the least node reachable) of every node in ``edges`` (``keys, a, b``: nodes of one graph for each
    value of the keys, of any type that has an order).

    Every larger neighbour of a node is linked to the node's least one, then every smaller one, in turn, until each node
    hangs on the least of its component: no node is then the larger end of one edge and the smaller of another. The number of
    rounds grows with the logarithm of the longest path, and a round is staged, so lineage does not grow. Loops and repeated
    edges do no harm; an empty table gives an empty result.
    """
    now = staged(edges.select(*keys, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        inner = now.select(*keys, F.col("v").alias("u")).distinct()
        if now.join(inner, [*keys, "u"], "left_semi").isEmpty():
            break
        both = now.unionByName(now.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, [*keys, "u"]).filter("v > u").select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        moved = large.join(low, [*keys, "u"]).filter("v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(moved.unionByName(low.select(*keys, "u", F.col("m").alias("v"))).distinct())
    return now.select(*keys, F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(*keys, F.col("v").alias("node"), F.col("v").alias("label")).distinct())
