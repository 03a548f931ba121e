"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.llm.tables import Shelf


def _sign(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, whatever their order."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def components(links: DataFrame, shelf: Shelf) -> DataFrame:
    """``id`` and ``component`` (its smallest id) of every id in the links ``a`` - ``b`` (long, any direction).

    Each round gives every id's larger neighbours, then its smaller ones, to the smallest id around it, until
    nothing changes; the number of rounds grows with the logarithm of the longest path. All neighbours of an id
    are never in one task: their smallest is a combined aggregate, joined back to the edges. Loops, repeated
    links and nulls are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("a is not null and b is not null and hi > lo")
    edges = shelf.put(edges.distinct(), "edges")
    before = _sign(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = shelf.put(small.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        after = _sign(edges)
        shelf.drop_older("edges")
        if after == before:
            break
        before = after
    roots = edges.select(F.col("lo").alias("id")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(roots.select("id", F.col("id").alias("component")))
