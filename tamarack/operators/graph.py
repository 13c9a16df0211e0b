"""Connected components by alternating large-star and small-star steps.

Work per round is linear in the edges and nothing reaches the driver but whether it is settled. A node with
very many neighbours costs no more than its edges: the minimum is aggregated map-side first, and is joined back
from a table of its own, so that a hot node's edges can be split among tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.storage import durable, release


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _large_star(now: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Larger neighbours of every node point at the smallest of the node and its neighbours; also the table of those."""
    pairs = _both(now)
    least = durable(pairs.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("low")), 2 * rows)
    found = pairs.join(least, "src").where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return found.where("src <> dst").distinct(), least


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(src, dst)`` -> ``(node, component)``; the component is its smallest node.

    Self loops and repeated edges are allowed; null ends are ignored. Nodes without an edge are absent.
    """
    edges = edges.where("src is not null and dst is not null")
    nodes = _both(edges).select(F.col("src").alias("node")).distinct()
    now = durable(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst").distinct())
    rows = now.count()  # a step makes no more than two edges of one
    for _ in range(max_rounds):
        large, least = _large_star(now, rows)
        down = durable(large, 2 * rows)
        release(now, least)
        low = durable(down.groupBy("src").agg(F.min("dst").alias("low")), 2 * rows)
        small = down.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).union(low.select("src", F.col("low").alias("dst")))
        now = durable(small.where("src <> dst").distinct(), 2 * rows)
        release(down, low)
        # Settled when every edge leads to a root: no node has two, and none that has one is pointed at.
        ends = now.select(F.col("src").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(now.select("dst", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in")).where("out > 1 or out + in > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.join(now.select(F.col("src").alias("node"), "dst"), "node", "left").select("node", F.coalesce("dst", "node").alias("component"))
