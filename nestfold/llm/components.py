"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestfold.llm.common import discard, store


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of any orderable type → ``node``, ``root``: the smallest
    node that each node of an edge can reach. Nodes without edges are absent.

    Each round hangs every node's larger neighbours under its smallest one
    (large star), then its smaller neighbours and itself (small star), until
    the edges are stars. The edge list never leaves the executors and no
    node's neighbours are collected: a round is grouped minima, which combine
    on the map side, and joins of the edges with those minima, in which Spark
    splits a hot node's edges. Each round's edges are written, so a lost
    executor repeats one round at most. Null ends are dropped.
    """
    pairs = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = store(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = store(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = store(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name)
        discard(now, large)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksums of an edge list."""
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(h, 32))).first()
    return tuple(row)
