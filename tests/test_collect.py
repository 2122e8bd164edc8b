"""The collector's loop against a plain version, and the one-pass profile on hand-made texts."""

import json
import random

import pytest

from conftest import document, participant, ten
from matchmart.operators.graph import collect_to_target, recent_matches
from matchmart.plans.profile import profile_dataset


def plain(recent, players, valid, landed, seeds, target):
    seen_p, seen_m, frontier, out, hop = set(seeds), set(), set(seeds), [], 0
    while frontier and len(out) < target:
        hop += 1
        reached = {m for p in frontier for m in recent.get(p, ()) if m in valid} - seen_m
        seen_m |= reached
        out += [(hop, m) for m in sorted(reached - landed)][: target - len(out)]
        frontier = {p for m in reached for p in players[m]} - seen_p
        seen_p |= frontier
    return out


@pytest.mark.parametrize("target", [0, 1, 7, 1 << 30])
@pytest.mark.parametrize("n", [2, 6])
def test_collect_to_target(spark, target, n):
    rng = random.Random(4)
    players = {f"M_{i:03}": [f"P{rng.randrange(90)}" for _ in range(3)] for i in range(120)}
    edges = spark.createDataFrame(
        sorted({(m, p, int(m[2:])) for m, ps in players.items() for p in ps}), "match_id string, puuid string, t int"
    )
    valid = {m for m in players if rng.random() < 0.7}
    landed = {m for m in players if rng.random() < 0.3}
    ranked = recent_matches(edges, n, "t")
    recent = {}
    for r in ranked.collect():
        recent.setdefault(r["puuid"], set()).add(r["match_id"])
    ids = lambda s: spark.createDataFrame([(m,) for m in sorted(s)], "match_id string")
    seeds = spark.createDataFrame([("P1",), ("P2",), (None,)], "puuid string")
    got = collect_to_target(ranked, edges.drop("t"), ids(valid), ids(landed), seeds, target)
    want = plain(recent, players, valid, landed, {"P1", "P2"}, target)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    if target == 7:
        assert len(want) == 7


def test_collect_without_seeds(spark):
    none = spark.createDataFrame([], "match_id string, puuid string")
    got = collect_to_target(none, none, none.select("match_id"), none.select("match_id"), none.select("puuid"), 5)
    assert got.count() == 0


def lines(spark, texts):
    rows = profile_dataset(spark.createDataFrame([(t,) for t in texts], "raw_json string")).collect()
    return {(r["section"], r["key"]): (r["value"], r["text"]) for r in rows}


def test_profile_tells_json_types_apart(spark):
    bot = ten()
    bot[0] = participant(1, "BOT")
    docs = [
        document("A", ten(), duration=100),
        document("A", ten(), gameDuration="900"),  # text is no number
        document("B", ten(), duration=200.5),
        document("C", ten(), gameDuration=None, map_id="11"),  # text 11 is not map 11
        document("", bot, gameStartTimestamp="1"),
        document(None, None, version="dev"),
    ]
    got = lines(spark, [json.dumps(d) for d in docs] + ['{"metadata": {"matchId": "T"', "7", None])
    value = lambda s, k: got[s, k][0]
    basic = ("json_files", "parsed_matches", "parse_errors", "unique_match_ids", "duplicate_match_ids")
    assert [value("basic", k) for k in basic] == [9, 4, 3, 3, 1]
    assert [value("duration", k) for k in ("minimum", "maximum", "average")] == [100, 1800, 975.13]
    assert value("duration", "median") == 1000.25
    assert value("match_type", "valid_pvp_matches") == 3 and value("match_type", "bot_matches") == 1
    assert value("missing_fields", "gameDuration") == 1 and value("missing_fields", "metadata.matchId") == 2
    assert value("participants", "0") == 1 and value("participants", "10") == 5
    assert ("patch", "dev") not in got and value("patch", "16.16") == 5
    assert got["date_range", "earliest"][1] == "2023-11-14T22:13:20+00:00"


def test_profile_of_nothing(spark):
    got = lines(spark, [])
    assert got["basic", "json_files"] == (0, None) and got["duration", "median"] == (None, None)
    assert got["date_range", "latest"] == (None, None)
