"""Connected components of a link table by repeated minimum hooking and contraction.

Every round is two aggregations with map-side combining and joins, so one vertex with very
many links never gathers in one task. Vertex ids should be hash-like (random order), which
makes the number of rounds logarithmic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(v, root)`` for every vertex of ``links``; null ends and self links are ignored,
    repeated links do no harm, and an empty table gives an empty result."""
    edges = written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "edges")
    total = None
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("to")), "hooks")
        if total is None:
            total = hook.select(F.col("x").alias("v"), F.col("to").alias("root"))
        else:
            total = total.join(hook, total.root == hook.x, "left").select("v", F.coalesce("to", "root").alias("root"))
        total = written(total, "roots")
        h1, h2 = hook.select(F.col("x").alias("u"), F.col("to").alias("p")), hook.select(F.col("x").alias("v"), F.col("to").alias("q"))
        edges = written(edges.join(h1, "u").join(h2, "v").select(F.col("p").alias("u"), F.col("q").alias("v")).filter("u <> v").distinct(), "edges")
    if total is None:
        return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
    return total
