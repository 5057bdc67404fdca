"""Connected components of an edge table, in DataFrame operations only.

Rounds of two steps, each of which maps every vertex of a larger number to the smallest one it sees: first to the smallest
neighbour of all, itself included (large star), then within the smaller neighbours (small star). Each round's edges are
distinct and written to the shared folder, so lineage stays short. A vertex's edges are never gathered in a list; minima are
pre-aggregated, and the join back to a hot vertex can be split.

Null ends are ignored, repeated edges and loops have no effect, and an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.plans.workspace import Workspace


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """edges (u > v) after a large or small star step."""
    if larger:
        seen = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = seen.join(least, "u")
    if larger:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame, work: Workspace, name: str = "cc") -> DataFrame:
    """id and component (the smallest id reachable) of every vertex that an edge (a, b) joins to another."""
    pairs = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    held = work.table(f"{name}-0", pairs)
    was, step = None, 0
    while True:
        step += 1
        held = work.table(f"{name}-{step}", _star(_star(held, larger=True), larger=False))
        # the sum of hashes tells whether the edges are still the same
        now = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        work.drop(f"{name}-{step - 1}")
        if now == was:
            break
        was = now
    own = held.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = held.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return own.unionAll(roots)
