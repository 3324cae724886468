"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import discard, materialize


def _signature(edges: DataFrame) -> tuple:
    """Order-independent fingerprint of an edge set: two numbers, whatever its size."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Each round shuffles the edges, whose minimum per node is pre-aggregated, so a node with very
    many edges costs one row per task; joins back on such nodes are split by adaptive execution.
    Every round is written to shared storage. Self-loops and null ends are ignored.
    """
    e = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
    current = materialize(e.where("u is not null and v is not null and u <> v").distinct(), "edges")
    seen = _signature(current)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        after = materialize(_small_star(_large_star(current)), "edges")
        discard(current)
        sign = _signature(after)
        current = after
        if sign == seen:
            break
        seen = sign
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    # A settled edge set is a forest of stars: every edge leads from a node to its component.
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
