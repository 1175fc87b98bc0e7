"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.storage import stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges(a, b)`` but the roots; a root is its component's least node.

    Large stars and small stars by turns (Kiveris et al., 2014): each node's greater neighbours, then
    its lesser ones, are joined to the least of its neighbours, until nothing changes. The number of
    rounds grows with the logarithm of the size; each is written to the shared folder.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(pairs.distinct(), "components")
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components-least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), "components-large")
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "components-least")
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stage(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "components")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
