"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import dropped, staged


def _least(edges: DataFrame) -> DataFrame:
    """Each node ``u`` of directed edges with its smallest neighbour or itself."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest neighbour (or
    itself). Edges (u, v) are undirected."""
    both = edges.union(edges.select("v", "u"))
    return (
        both.join(_least(both), "u")
        .where("v > u")
        .selectExpr("v AS u", "m AS v")
        .where("u <> v")
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the smallest of them."""
    down = edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").selectExpr("v AS u", "m AS v")
    return moved.union(least.selectExpr("u", "m AS v")).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (u, v);
    ``component`` is the smallest node reachable.

    Two joins and aggregates a round, until the edges are stars; a hub's edges
    are split over tasks by the joins and pre-aggregated before they move.
    Rounds are written to the shared folder, and the one before deleted.
    """
    now = staged(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges")
    mark = _mark(now)
    while True:
        new = staged(small_star(large_star(now)), "edges")
        dropped(now)
        now, last, mark = new, mark, _mark(new)
        if mark == last:
            break
    return now.selectExpr("u AS node", "v AS component").union(now.selectExpr("v", "v").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksums of a set of edges."""
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))
    ).first()
    return tuple(row)
