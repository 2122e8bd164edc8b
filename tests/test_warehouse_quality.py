"""Layer semantics and the quality gate on small hand-made documents
(W5-W7, W14, W16, P21, Q1-Q11, J2, U1)."""

import pytest
from pyspark.sql import functions as F

from conftest import document, participant, ten
from matchmart.plans import quality
from matchmart.plans.warehouse import Layers
from matchmart.sources.frames import frames_from_documents
from matchmart.schema import DOCUMENT_SCHEMA
from pyspark.sql import types as T


def docs_df(spark, docs, ingest_date="2026-08-16"):
    schema = T.StructType(DOCUMENT_SCHEMA.fields + [T.StructField("ingest_date", T.StringType())])
    import json

    rows = [json.dumps({**d, "ingest_date": ingest_date}) for d in docs]
    return spark.read.schema(schema).json(spark.sparkContext.parallelize(rows, 1))


@pytest.fixture()
def small(spark):
    zero_deaths = [participant(i, f"A{i}", win=True, deaths=0, championId=7, championName="Zed") for i in range(1, 11)]
    null_win = ten("B")
    null_win[0] = participant(1, "B1", win=None)
    docs = [
        document("M_1", zero_deaths, version=None),  # NULL patch
        document("M_2", null_win, version="dev"),  # '' patch
        document("M_3", ten("C"), version="15.3.1"),
        document("M_4", ten("D"), version="15.3.2"),
    ]
    bot = ten("E")
    bot[0] = participant(1, "BOT")
    docs.append(document("M_5", bot, version="15.3.9"))
    early = ten("F")
    early[4] = participant(5, "F5", early=True)
    docs.append(document("M_6", early, version="15.3.9"))
    return Layers(frames_from_documents(docs_df(spark, docs)))


def test_summary_and_metrics(small):
    dws = small.dws_champion_day.collect()
    by_patch = {}
    for r in dws:
        by_patch.setdefault(r["patch_version"], []).append(r)
    # NULL and '' patches are groups of their own in DWS
    assert None in by_patch and "" in by_patch
    # bot and early-surrender matches are excluded
    assert sum(r["match_count"] for r in dws) == 40
    # A NULL win counts in match_count only
    null_patch = by_patch[""][0]
    assert null_patch["match_count"] == 10 and null_patch["win_count"] + null_patch["loss_count"] == 9
    ads = {r["patch_version"]: r for r in small.ads_champion_day_metrics.collect()}
    # Deaths total 0 -> kda = kills + assists
    assert ads[None]["kda_ratio"] == 20.0
    assert ads[None]["win_rate"] == 1.0
    dims = {r["patch_version"] for r in small.dim_patch.collect()}
    assert dims == {"15.3"}
    champs = {r["champion_id"]: r["champion_name"] for r in small.dim_champion.collect()}
    assert champs[7] == "Zed"


def test_duplicate_match_id_multiplies_players(spark, small):
    # Two documents with the same id (different ingest dates)
    d = docs_df(spark, [document("M_9", ten("Q"))], "2026-08-16").unionByName(
        docs_df(spark, [document("M_9", ten("Q"))], "2026-08-17")
    )
    lay = Layers(frames_from_documents(d))
    assert lay.dws_champion_day.agg(F.sum("match_count")).first()[0] == 40
    rep = {r["rule_id"]: r for r in quality.report(
        quality.QualityInputs(lay.dwd_match, lay.dwd_player_match, lay.dws_champion_day, lay.ads_champion_day_metrics)
    ).collect()}
    assert rep["DQ01"]["status"] == "FAIL" and rep["DQ01"]["actual_value"] == "1"
    assert rep["DQ04"]["actual_value"] == "10"
    assert rep["DQ03"]["actual_value"] == "1"  # 20 player rows for one id


def test_report_rows_and_gate(spark, small, tmp_path):
    inputs = quality.QualityInputs(
        small.dwd_match, small.dwd_player_match, small.dws_champion_day, small.ads_champion_day_metrics
    )
    rows = quality.report(inputs).collect()
    assert [r["rule_id"] for r in rows] == [f"DQ0{i}" for i in range(1, 8)]
    st = {r["rule_id"]: r["status"] for r in rows}
    assert st["DQ05"] == "FAIL"  # the NULL win (W6)
    assert st["DQ01"] == st["DQ02"] == st["DQ06"] == st["DQ07"] == "PASS"
    dq7 = [r for r in rows if r["rule_id"] == "DQ07"][0]
    assert dq7["actual_value"].startswith("DWS=") and dq7["expected_value"] == "DWS count = ADS count"
    summ = {r["status"]: r["n"] for r in quality.summary(quality.report(inputs)).collect()}
    assert summ["FAIL"] + summ["PASS"] == 7

    # Q9/Q10: history is appended before the gate raises
    spark.sql("CREATE DATABASE IF NOT EXISTS qtest")
    spark.sql(
        "CREATE TABLE IF NOT EXISTS qtest.dq_check_result (run_id STRING, rule_id STRING, rule_name STRING, "
        "status STRING, actual_value STRING, expected_value STRING, check_time TIMESTAMP, batch_date STRING) USING orc"
    )
    with pytest.raises(quality.QualityGateError):
        quality.run_checks(spark, inputs, "2026-08-17", "qtest.dq_check_result", run_id="r1")
    hist = spark.table("qtest.dq_check_result").where("run_id = 'r1'")
    assert hist.count() == 7
    assert hist.select("check_time").distinct().count() == 1
    assert hist.select("batch_date").distinct().first()[0] == "2026-08-17"


def test_rules_fold_into_one_pass_per_table(small):
    inputs = quality.QualityInputs(
        small.dwd_match, small.dwd_player_match, small.dws_champion_day, small.ads_champion_day_metrics
    )
    plan = quality.report(inputs)._jdf.queryExecution().optimizedPlan().toString()
    # no cross join for DQ07 (J2 is an aggregate over a union)
    assert "Join Cross" not in plan and "CartesianProduct" not in plan


def test_a_rule_shuffles_a_player_row_once(spark):
    """Players of a match are counted before a shuffle, not by shuffled pairs again."""
    rows = spark.range(0, 4000, 1, 2).selectExpr(
        "CASE WHEN id < 3960 THEN concat('M', id div 10) END AS match_id",
        "cast(CASE WHEN id % 50 = 1 THEN 0 WHEN id % 70 <> 3 THEN id % 10 END as int) AS participant_id",
    )
    inputs = quality.QualityInputs(dwd_player_match=rows)
    report = quality.rule_results(inputs, ["DQ03", "DQ04"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    # Two keyed shuffles, one a rule; the others gather one row a task.
    assert plan.count("Exchange hashpartitioning(match_id") == 2
    for rule in ("DQ03", "DQ04"):
        plan = quality.rule_results(inputs, [rule])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(match_id") == 1
    # The 40 rows without a match are one match; pairs with a NULL count too.
    by_match, pairs = {}, {}
    for r in rows.collect():
        by_match[r[0]] = by_match.get(r[0], 0) + 1
        pairs[tuple(r)] = pairs.get(tuple(r), 0) + 1
    expected = [sum(n != 10 for n in by_match.values()), sum(n > 1 for n in pairs.values())]
    found = {r["rule_id"]: int(r["actual_value"]) for r in report.collect()}
    assert [found["DQ03"], found["DQ04"]] == expected and expected[0] == 1 and expected[1] > 50
