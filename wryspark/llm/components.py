"""Connected components by alternating large and small stars.

Both steps replace edges by edges to smaller neighbours: the large star hangs
a node's larger neighbours, the small star its smaller ones, on the smallest
node known. The edges never become more, and the rounds needed grow with the
logarithm of the longest path. Smallest neighbours are found by a partially
aggregated minimum and joined back by node and salt, so a node with very many
neighbours is not gathered in one task: its edges are dealt out to ``SALTS``
tasks, and as both sides of the join are plain shuffles, adaptive execution
can split them further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SALTS = 8


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """(u, v, m): edges with what ``least (u, m)`` says of u."""
    salted = edges.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    copies = least.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return salted.join(copies, ["u", "_salt"]).select("u", "v", "m")


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 40) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its
    smallest node. Edges with a null end and edges from a node to itself are
    left out. Every round's edges are checkpointed."""
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct().checkpoint())
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (_with_least(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, least).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components: no end after {max_rounds} rounds")
    roots = e.select("v").distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component"))))
