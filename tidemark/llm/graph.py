"""Connected components of an edge table, without collecting it.

Alternates large-star and small-star steps: each is one minimum by key (partially
aggregated, so a node with very many neighbours is summed before it is sent) and one
join, which adaptive execution may split.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, durable


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of comparable ids to ``(node, component)``: the smallest id reachable.

    Nodes without an edge to another node are not listed.  Self-loops and repeated
    edges are ignored; nulls never link.  An empty table gives an empty table.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    # minima are written, so that the joins read them through an exchange of their own and a hub's side can be split
    before = seen(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = durable(low.select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "minima")
        large = both.join(low, both["a"] == low["n"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # large holds (neighbour, minimum) with minimum <= a < neighbour: each row points down already
        large = durable(large.distinct(), "large-star")
        low2 = durable(large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), "minima")
        pairs = large.join(low2, large["a"] == F.col("n"))
        small = pairs.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b")
        past, now = now, durable(small.distinct(), "small-star")
        discard(past, low, large, low2)
        mark = seen(now)
        if mark == before:
            break
        before = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
