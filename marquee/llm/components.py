"""Connected components by alternating stars, in joins and combined aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b); root is the component's least node.

    Each round hangs all larger neighbours of a node on its least one, then all smaller ones.
    Edges never grow in number and the rounds follow the logarithm of the longest path. A hub's
    neighbours are never gathered: minima are combined before the shuffle and joined back.
    Every round is written to the shared folder; rounds end when the edges no longer change.
    """
    a, b = F.col("a"), F.col("b")
    edges = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct())
    before = None
    while True:
        mark = tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0)))")).first())
        if mark == before:
            return edges.select(a.alias("node"), b.alias("root")).union(edges.select(b, b)).distinct()
        before = mark
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        small = small.select(b.alias("a"), F.col("least").alias("b")).union(small.select("a", "least"))
        edges = stored(small.where("a <> b").distinct())
