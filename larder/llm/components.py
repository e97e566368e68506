"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.texts import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge to another; ``root`` is its component's least node.

    ``edges`` has two columns of one type. Alternates the large-star and small-star steps of
    Kiveris et al. (2014): each node's larger neighbours, then its smaller ones, are linked to the
    least node it knows. Every step is a partial aggregate and an equi-join, so a node with very
    many neighbours is pre-aggregated; least nodes are stored before the join, without which Spark could
    not split the join partition of such a node. Ends when a pair of
    steps changes nothing, after about log2 of the longest path. Edges that hold NULL, loops
    and repeated edges mean nothing. No edges give no rows.
    """
    a, b = edges.columns
    clean = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = stored(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (state := _state(pairs)) != before:
        before = state
        pairs = stored(_small_star(_large_star(pairs)), "edges")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(pairs: DataFrame) -> tuple:
    """Tells sets of edges apart without fetching them."""
    mark = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("*"), F.bit_xor(mark), F.sum(mark.cast("decimal(38,0)"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select("v", "u"))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """``pairs`` has the larger node first."""
    least = stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = pairs.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
