"""A key holding a third of all rows: AQE splits it, results stay whole."""

import pytest
from pyspark.sql import functions as F

from matchmart.operators.joins import members
from matchmart.plans.warehouse import build_champion_day

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture()
def skew_conf(spark):
    prev = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in prev.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def player_rows(spark, n=30000):
    # one third of all player rows belong to match "HOT"
    ids = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("M"), F.col("id").cast("string")))
    return spark.range(n).select(
        ids.alias("match_id"),
        F.lit("2026-01-01").alias("dt"),
        F.lit("15.3").alias("patch_version"),
        F.lit(420).alias("queue_id"),
        (F.col("id") % 5).cast("int").alias("champion_id"),
        F.concat(F.lit("C"), (F.col("id") % 5).cast("string")).alias("champion_name"),
        (F.col("id") % 2 == 0).alias("win"),
        F.lit(1).alias("kills"),
        F.lit(2).alias("deaths"),
        F.lit(3).alias("assists"),
        F.lit(100).cast("bigint").alias("gold_earned"),
        F.lit(50).cast("bigint").alias("total_damage_dealt_to_champions"),
    )


def match_rows(spark, n=30000):
    ids = spark.range(n).where(F.col("id") % 3 != 0).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("match_id")
    )
    hot = spark.range(1).select(F.lit("HOT").alias("match_id"))
    return ids.unionByName(hot).select(
        "match_id", F.lit(0).alias("is_bot_match"), F.lit(0).alias("is_early_surrender")
    )


def test_summary_join_splits_hot_match(spark, skew_conf):
    dws = build_champion_day(player_rows(spark), match_rows(spark))
    rows = dws.collect()
    assert sum(r["match_count"] for r in rows) == 30000  # every player row counted once
    plan = dws._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_membership_semi_join_splits_hot_key(spark, skew_conf):
    df = members(player_rows(spark), match_rows(spark), "match_id")
    assert df.count() == 30000
    out = members(player_rows(spark), match_rows(spark), "match_id")
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_date_is_written_by_several_tasks(spark, skew_conf, tmp_path):
    import os

    from matchmart.plans.tables import overwrite_partitions

    spark.sql(f"CREATE DATABASE IF NOT EXISTS skewdb LOCATION '{tmp_path}/skewdb'")
    spark.sql(
        "CREATE TABLE IF NOT EXISTS skewdb.t (match_id STRING, v BIGINT, dt STRING) "
        "USING orc PARTITIONED BY (dt)"
    )
    df = spark.range(60000).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("match_id"),
        F.col("id").alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit("2026-01-01"))
        .otherwise(F.concat(F.lit("2025-"), F.lpad(((F.col("id") % 12) + 1).cast("string"), 2, "0"), F.lit("-01")))
        .alias("dt"),
    )
    overwrite_partitions(spark, df, "skewdb.t")
    assert spark.table("skewdb.t").count() == 60000
    hot = os.path.join(str(tmp_path), "skewdb", "t", "dt=2026-01-01")
    files = [f for f in os.listdir(hot) if f.endswith(".orc") or f.startswith("part-")]
    assert len(files) > 1  # the hot date was split over several write tasks
