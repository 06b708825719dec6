"""Connected components by alternating large-star and small-star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> ``(node, root)`` for every node that has an edge; root is the smallest node
    of its component (its own row included).

    Each round links every node's larger neighbours to the smallest one (large star), then its smaller
    neighbours to the smallest one (small star), and writes the edges to the shared folder, so a lost executor
    costs one round.  Minima are combined before the shuffle; a node with very many neighbours is an ordinary
    skewed join, which adaptive execution splits.  Only a count and a checksum reach the driver.
    """
    oriented = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    e = materialize(oriented, "edges")
    seen = _print(e)
    while seen[0]:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(
            linked.unionAll(smallest.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges"
        )
        now = _print(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
