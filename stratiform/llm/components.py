"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.tables import stored


def _with_least(links: DataFrame) -> DataFrame:
    """Every (node, other) with the smallest of the node and all its others. The minimum is taken
    before the shuffle, and the join back can be split if one node has very many others."""
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    return links.join(least, "node").withColumn("least", F.least("node", "least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return (
        _with_least(both)
        .filter("other > node")
        .select(F.col("other").alias("node"), F.col("least").alias("other"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    found = _with_least(down)
    return (
        found.select(F.col("other").alias("node"), F.col("least").alias("other"))
        .unionByName(found.select("node", F.col("least").alias("other")))
        .filter("node > other")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), in any order, repeated or not. Returns (node, root): the smallest node of the
    component, for every node that isn't its own root. Empty edges give an empty result."""
    stars = stored(edges.filter("a <> b").select(F.col("a").alias("node"), F.col("b").alias("other")).distinct(), "edges")
    while True:
        stars = stored(_small_star(_large_star(stars)), "stars")
        # done when every node hangs on one root, and no root hangs on another
        roots = stars.select(F.col("other").alias("node"), F.lit(1).alias("as_root"), F.lit(0).alias("as_node")).distinct()
        seen = stars.select("node", F.lit(0).alias("as_root"), F.lit(1).alias("as_node")).unionByName(roots)
        total = seen.groupBy("node").agg(F.sum("as_root").alias("r"), F.sum("as_node").alias("n"))
        if total.filter("n > 1 or (n > 0 and r > 0)").isEmpty():
            return stars.withColumnRenamed("other", "root")
