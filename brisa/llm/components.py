"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import as_derived_table


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node of ``edges`` (columns a, b, numbers): the smallest node that it reaches.

    Large-star and small-star steps in turn: every node hands its larger neighbours to its smallest one, then its
    smaller ones. The number of rounds grows with the logarithm of the longest path. A node with many
    neighbours is reduced to a minimum by combiners; its edges are joined, never gathered. Each
    round is a written table. Loops are dropped; no edges give no rows.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = as_derived_table(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("least").alias("b")).distinct()
        large = as_derived_table(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = as_derived_table(small.union(least.select("a", F.col("least").alias("b"))).distinct(), "edges")
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("b", "b"))


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.sum(h.bitwiseAND(F.lit(0xFFFFF)))).first())
