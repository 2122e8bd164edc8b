"""Landing (R1-R3, R6-R8, J3-J5, S9, G4, G5) and graph."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import document, participant, ten
from matchmart.operators.graph import expand_frontier, player_match_edges, recent_matches
from matchmart.plans import landing


def matches_df(spark, rows):
    return spark.createDataFrame(
        rows, "match_id string, n_participants int, has_bot boolean, mapId int"
    )


def test_select_new_and_first_valid(spark):
    cands = landing.with_validity(
        matches_df(
            spark,
            [
                ("M1", 10, False, 11),
                ("M2", 10, False, 11),
                ("M2", 10, False, 11),  # same document offered twice
                ("M3", 10, True, 11),
                ("M4", 9, False, 11),
                ("M5", 10, False, 12),
                ("M6", 10, False, 11),
            ],
        )
    )
    landed = spark.createDataFrame([("M1",)], "match_id string")
    new = landing.select_new(cands, landed)
    assert sorted(r[0] for r in new.select("match_id").collect()) == ["M2", "M3", "M4", "M5", "M6"]
    first = [r[0] for r in landing.first_valid(new, 1).collect()]
    assert first == ["M2"]
    # running the selection on its own output finds nothing new
    assert landing.select_new(cands, cands.select("match_id")).count() == 0

    man = landing.batch_manifest(new, "2026-08-17", target=2).collect()
    assert {r["status"] for r in man} == {"completed"}
    # raw ids: every new id up to the second valid one (M6)
    assert sorted(r["match_id"] for r in man) == ["M2", "M3", "M4", "M5", "M6"]
    inc = landing.batch_manifest(new, "2026-08-17", target=5).collect()
    assert {r["status"] for r in inc} == {"incomplete"}

    summary = landing.manifest_summary(landing.batch_manifest(new, "2026-08-17", target=2)).first()
    assert summary["new_raw_matches"] == 5 and summary["new_valid_matches"] == 2


def test_plan_batch_states(spark):
    assert landing.plan_batch(None, "2026-08-17", 20).action == "start"
    mk = lambda status, target: spark.createDataFrame(
        [("2026-08-17", status, target, "M1", True)],
        "batch_date string, status string, target_new_matches int, match_id string, is_valid boolean",
    )
    assert landing.plan_batch(mk("completed", 20), "2026-08-17", 20).action == "skip"
    assert landing.plan_batch(mk("in_progress", 20), "2026-08-17", 20).action == "resume"
    assert landing.plan_batch(mk("incomplete", 20), "2026-08-17", 20).action == "resume"
    assert landing.plan_batch(mk("completed", 20), "2026-08-18", 20).action == "start"
    with pytest.raises(landing.BatchError):
        landing.plan_batch(mk("completed", 20), "2026-08-17", 30)
    with pytest.raises(ValueError):
        landing.check_batch_date("2026/08/17")
    with pytest.raises(landing.BatchError):
        landing.completed_ids(mk("incomplete", 20), "2026-08-17")
    assert landing.completed_ids(mk("completed", 20), "2026-08-17").count() == 1


def test_compaction_keeps_unknown_fields_and_reconciles(spark):
    doc = document("M1", ten())
    doc["info"]["newField"] = {"nested": [1, None, 1.5]}
    raw = spark.createDataFrame(
        [(json.dumps(doc, indent=2),), (json.dumps(document("M2", ten()), indent=2),)], "raw_json string"
    )
    manifest = spark.createDataFrame([("M1",)], "match_id string")
    out = landing.compact_batch(raw, manifest, "2026-08-17").collect()
    assert len(out) == 1
    text = out[0]["raw_json"]
    assert "\n" not in text and ", " not in text
    assert json.loads(text)["info"]["newField"] == {"nested": [1, None, 1.5]}
    rec = landing.compaction_reconciliation(
        landing.compact_batch(raw, manifest, "2026-08-17"), manifest, "2026-08-17"
    ).first()
    assert rec["status"] == "PASS" and rec["lines_written"] == 1
    missing = landing.manifest_missing(
        spark.createDataFrame([("M1",), ("M7",)], "match_id string"),
        spark.createDataFrame([("M1",)], "match_id string"),
    )
    with pytest.raises(landing.BatchError):
        landing.assert_complete(missing)


def test_frontier_three_hops_with_invalid_middle(spark):
    # p0 -> (valid V1) -> p1 -> (valid V2) -> p2 -> (INVALID X) -> p3
    edges = spark.createDataFrame(
        [
            ("V1", "p0"), ("V1", "p1"),
            ("V2", "p1"), ("V2", "p2"),
            ("X", "p2"), ("X", "p3"),
            ("V3", "p3"), ("V3", "p4"),
        ],
        "match_id string, puuid string",
    )
    valid = spark.createDataFrame([("V1",), ("V2",), ("V3",)], "match_id string")
    seeds = spark.createDataFrame([("p0",)], "puuid string")
    got = sorted((r["hop"], r["puuid"]) for r in expand_frontier(edges, valid, seeds, 3).collect())
    # Only valid matches expand, so p3/p4 are never reached
    assert got == [(1, "p1"), (2, "p2")]


def test_recent_matches_ties_and_plan(spark):
    rows = [("u1", f"M{i:02d}", 1000 + (i // 2)) for i in range(25)]
    rows += [("u2", "M99", 5)]
    df = spark.createDataFrame(rows, "puuid string, match_id string, game_start_time long")
    r = recent_matches(df, n=20)
    got = [x["match_id"] for x in r.where("puuid = 'u1'").orderBy("recent_rank").collect()]
    assert len(got) == 20
    # newest first; equal start times ordered by id
    assert got[:3] == ["M24", "M22", "M23"]
    assert r.where("puuid = 'u2'").count() == 1
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # top-n per player before the shuffle


def test_edges_exclude_bots_and_empty_ids(spark):
    parts = spark.createDataFrame(
        [("M1", "a"), ("M1", "a"), ("M1", "BOT"), ("M1", ""), ("M1", None), ("M2", "a")],
        "match_id string, puuid string",
    )
    assert sorted(tuple(r) for r in player_match_edges(parts).collect()) == [("M1", "a"), ("M2", "a")]
