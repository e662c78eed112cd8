"""Connected components of links between texts, without gathering them anywhere."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether every id points at one other, which itself points at none."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    onward = edges.select("a").join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    return several.union(onward).count() == 0


def components(links: DataFrame, purpose: str) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) for every id in a link.

    ``links`` has columns ``a`` and ``b``.  Alternating large and small stars: each round
    points every id's larger neighbours, then its smaller ones, at its smallest
    neighbour, until only stars are left; the number of rounds grows with the logarithm
    of the component's size.  Both steps are plain aggregates and joins, so a vertex
    with many neighbours is spread like any other key.  Rounds end in written tables.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, f"{purpose}-edges")
    while not _are_stars(edges):
        both = edges.union(edges.select("b", "a"))
        # Large star: every larger neighbour of a is linked to a's least neighbour, or a.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = written(least, f"{purpose}-least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), f"{purpose}-large")
        # Small star: a and its smaller neighbours are linked to the least of them.
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"{purpose}-least")
        small = large.join(least, "a").select(F.col("b").alias("x"), "m").union(least)
        edges = written(small.filter("x <> m").toDF("a", "b").distinct(), f"{purpose}-stars")
    return edges.toDF("id", "component").union(edges.select("b", "b").distinct())
