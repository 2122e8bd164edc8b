"""Player <-> match graph: edges, breadth-first frontier, recent-N per player.

The collector walks an implicit bipartite graph (players play matches). Here
a hop is a set operation: frontier players -> their valid matches (semi join)
-> those matches' players (semi join) -> minus players already seen (anti
join). Semi joins never emit pairs, so a player in a huge number of matches
or a match with many players costs rows, not a cross product; AQE splits
skewed join partitions. The edge list, the valid set and each hop's result
are written to the shared checkpoint folder and read back, which cuts the
lineage of the iteration (one computation each, no recompute on a lost
executor).

``collect_to_target`` is the collector's whole loop: hops go on until enough new
valid matches are found or no player is left to look at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchmart.operators.joins import excluding, members
from matchmart.session import discard, materialize, materialized

BOT_PUUID = "BOT"


def player_match_edges(participants: DataFrame) -> DataFrame:
    """Distinct ``(match_id, puuid)`` of human participants."""
    p = F.col("puuid")
    return (
        participants.where(p.isNotNull() & (p != "") & (p != BOT_PUUID))
        .select("match_id", "puuid")
        .distinct()
    )


def expand_frontier(
    edges: DataFrame,
    valid_matches: DataFrame,
    seeds: DataFrame,
    hops: int,
    checkpoint: bool = True,
) -> DataFrame:
    """Players first reached at hop 1..``hops`` from ``seeds``.

    Only valid matches expand; a player is visited once (the seeds count as
    visited). Returns ``(hop, puuid)``.
    """
    valid_ids = valid_matches.select("match_id").distinct()
    if checkpoint:
        # Every hop reads the edge list and the valid set: materialize them
        # once in the shared checkpoint folder instead of re-deriving per hop.
        edges = materialized(edges, "frontier-edges")
        valid_ids = materialize(valid_ids, "frontier-valid")
    seen = seeds.select("puuid").distinct()
    if checkpoint:
        seen = materialize(seen, "frontier-seeds")
    frontier = seen
    out = None
    for hop in range(1, hops + 1):
        reached = members(edges, frontier, "puuid").select("match_id").distinct()
        reached = members(reached, valid_ids, "match_id")
        players = members(edges, reached, "match_id").select("puuid").distinct()
        fresh = excluding(players, seen, "puuid")
        if checkpoint:
            fresh = materialize(fresh, f"frontier-hop{hop}")
        level = fresh.select(F.lit(hop).alias("hop"), "puuid")
        out = level if out is None else out.unionByName(level)
        seen = seen.unionByName(fresh)
        frontier = fresh
    return out


def collect_to_target(
    recent: DataFrame,
    edges: DataFrame,
    valid_matches: DataFrame,
    landed: DataFrame,
    seeds: DataFrame,
    target: int,
) -> DataFrame:
    """New valid matches ``(hop, match_id)`` in the order a breadth-first walk
    from ``seeds`` finds them, ``target`` at most (R4, R5, O6).

    Hop by hop: the frontier's players offer their ``recent`` matches
    ``(puuid, match_id)``; of those not seen before the valid ones count unless
    ``landed``, and (landed or not) their players, as far as not seen, are the
    next frontier. The walk ends with the hop in which ``target`` is reached (of
    that hop the first matches in id order are taken), or when nobody is left.
    A target of 0 or no seeds give no rows. NULL ids take part in nothing.

    A hop stages two tables, the matches it saw and its players; the driver gets
    one count of each. The result is staged, all else is deleted.
    """
    spark = seeds.sparkSession
    recent = materialize(recent.select("puuid", "match_id"), "collect-recent")
    edges = materialize(edges.select("match_id", "puuid"), "collect-edges")
    valid = materialize(valid_matches.select("match_id").distinct(), "collect-valid")
    frontier = materialize(
        seeds.where(F.col("puuid").isNotNull()).select("puuid").distinct(), "collect-seeds"
    )
    kept = [recent, edges, valid, frontier]
    players, matches, found = frontier, None, []
    hop, n, waiting = 0, 0, frontier.count()
    try:
        while waiting and n < target:
            hop += 1
            offered = members(recent, frontier, "puuid").select("match_id").distinct()
            reached = members(offered, valid, "match_id")
            if matches is not None:
                reached = excluding(reached, matches, "match_id")
            reached = materialize(reached, f"collect-matches{hop}")
            kept.append(reached)
            new = materialize(excluding(reached, landed.select("match_id"), "match_id"), f"collect-new{hop}")
            kept.append(new)
            more = new.count()
            # A top-k where the target cuts the hop; nothing is cut before. (Spark
            # makes room for the whole limit, however few rows there are.)
            if n + more > target:
                new = new.orderBy("match_id").limit(target - n)
            found.append(new.select(F.lit(hop).alias("hop"), "match_id"))
            n = min(n + more, target)
            matches = reached if matches is None else matches.unionByName(reached)
            fresh = members(edges, reached, "match_id").select("puuid").distinct()
            frontier = materialize(excluding(fresh, players, "puuid"), f"collect-players{hop}")
            kept.append(frontier)
            players = players.unionByName(frontier)
            waiting = frontier.count()
        none = spark.createDataFrame([], "hop int, match_id string")
        out = none
        for rows in found:
            out = out.unionByName(rows)
        return materialize(out, "collected")
    finally:
        discard(*kept)


def seed_players(edges: DataFrame, valid_matches: DataFrame) -> DataFrame:
    """Human players of the seed match: the smallest valid match id."""
    seed = valid_matches.agg(F.min("match_id").alias("match_id"))
    return members(edges, seed, "match_id").select("puuid").distinct()


def recent_matches(
    player_matches: DataFrame,
    n: int = 20,
    time_col: str = "game_start_time",
) -> DataFrame:
    """Each player's ``n`` most recent matches, newest first, ties by id.

    ``row_number() <= n`` is planned with a partial window group limit before
    the shuffle, so a player with a huge history sends at most ``n`` rows per
    map task.
    """
    w = Window.partitionBy("puuid").orderBy(F.col(time_col).desc(), F.col("match_id").asc())
    return (
        player_matches.withColumn("recent_rank", F.row_number().over(w))
        .where(F.col("recent_rank") <= n)
        .select("puuid", "match_id", time_col, "recent_rank")
    )
