"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.staging import drop, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v.

    Large star: every node links its larger neighbours to the minimum of its
    neighbourhood (itself included). Small star: every node links its smaller
    neighbours and itself to their minimum. The minimum per node is a
    hash aggregation with a map-side part, so a hub ships one row per task;
    the join back is an equi-join that Spark may split for a hub.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return (near.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .where("u <> v").distinct())
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, a: str, b: str, label: str = "cc") -> DataFrame:
    """(node, component) for all nodes of ``edges``; component = smallest node id.

    Loops, repeated edges and nulls are ignored; no edges give an empty table.
    Each step is written to the shared folder, so lineage stays short.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    cur = stage(edges.where(x.isNotNull() & y.isNotNull() & (x != y))
                .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), label)
    seen = _digest(cur)
    while seen[0]:
        nxt = stage(_star(_star(cur, large=True), large=False), label)
        drop(cur)
        cur, now = nxt, _digest(nxt)
        if now == seen:
            break
        seen = now
    nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
