"""Connected components of an undirected edge table, by alternating stars.

Each round rewrites the edges twice (every node hangs its larger neighbours on
the smallest node it sees, then its smaller ones), which ends with every node
on its component's smallest node after a number of rounds logarithmic in
practice. Aggregates are pre-combined per task and joins have a plain key on
both sides, so a hub node is split by the skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import saved


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    pairs = _both(edges)
    return (pairs.join(_least(pairs), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(pairs)
    hung = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node that has an edge; the label is the smallest node reachable.

    ``edges`` has integer columns ``u`` and ``v``; loops and repeats are allowed.
    An empty table gives an empty result.
    """
    edges = saved(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = saved(_small_star(_large_star(edges)), "edges")
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
