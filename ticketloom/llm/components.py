"""Connected components of an undirected edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import settle_table


def _minima(pairs: DataFrame, name: str) -> DataFrame:
    """(u, v, m): each pair with the smallest of its u and all v of that u.

    Both sides of the join are written tables, so a node with very many neighbours is split over tasks.
    """
    pairs = settle_table(pairs, name)
    least = settle_table(pairs.groupBy("u").agg(F.min("v").alias("least")), name)
    return pairs.join(least, "u").withColumn("m", F.least("u", "least"))


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), where root is the smallest node reachable.

    A large star links every larger neighbour of a node to the smallest one; a small star does so with the smaller
    neighbours. Both keep the components, and the alternation ends with each node linked to its root alone, after
    about log² of the nodes rounds. An empty table gives an empty result.
    """
    edges = settle_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _minima(both, "large").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _minima(large, "small")
        small = small.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = settle_table(small.distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
