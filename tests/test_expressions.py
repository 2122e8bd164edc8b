"""Scalar/array expression semantics."""

from pyspark.sql import functions as F

from matchmart.functions import (
    any_element,
    date_string_from_epoch_s,
    epoch_ms_to_s,
    iso_utc_from_epoch_ms,
    kda_ratio,
    patch_by_split,
    patch_version,
    safe_bigint,
    safe_int,
    timestamp_string_from_epoch_s,
    valid_match,
)


def test_patch_rules(spark):
    df = spark.createDataFrame(
        [(None,), ("dev",), ("abc.def.1",), ("16.16.804.1",), ("7",), ("",)], "v string"
    )
    rows = df.select("v", patch_version("v").alias("rx"), patch_by_split("v").alias("sp")).collect()
    got = {r["v"]: (r["rx"], r["sp"]) for r in rows}
    assert got[None] == (None, None)
    assert got["dev"] == ("", None)
    # The two rules disagree on non-numeric dotted text
    assert got["abc.def.1"] == ("", "abc.def")
    assert got["16.16.804.1"] == ("16.16", "16.16")
    assert got["7"] == ("", None)
    assert got[""] == ("", None)


def test_safe_casts_never_raise_under_ansi(spark):
    df = spark.createDataFrame([("12.7",), ("x",), (None,), ("42",)], "s string")
    rows = df.select("s", safe_bigint("s").alias("b"), safe_int("s").alias("i")).collect()
    got = {r["s"]: (r["b"], r["i"]) for r in rows}
    assert got["12.7"] == (12, 12)
    assert got["x"] == (None, None)
    assert got[None] == (None, None)
    assert got["42"] == (42, 42)


def test_epoch_conversions_are_utc_around_midnight(spark):
    midnight = 1_700_006_400_000  # 2023-11-15T00:00:00Z
    df = spark.createDataFrame([(midnight - 1,), (midnight,)], "ms long")
    s = epoch_ms_to_s("ms")
    rows = df.select(
        date_string_from_epoch_s(s).alias("dt"),
        timestamp_string_from_epoch_s(s).alias("ts"),
        iso_utc_from_epoch_ms("ms").alias("iso"),
    ).collect()
    assert rows[0]["dt"] == "2023-11-14" and rows[1]["dt"] == "2023-11-15"
    assert rows[0]["ts"] == "2023-11-14 23:59:59"
    assert rows[1]["iso"] == "2023-11-15T00:00:00+00:00"
    assert rows[0]["iso"] == "2023-11-14T23:59:59.999000+00:00"


def test_any_element_null_handling(spark):
    df = spark.createDataFrame(
        [
            ([{"puuid": None}, {"puuid": "S1"}],),
            ([{"puuid": None}],),
            ([{"puuid": "BOT"}, {"puuid": None}],),
            (None,),
            ([],),
        ],
        "p array<struct<puuid:string>>",
    )
    got = [
        r[0]
        for r in df.select(any_element("p", lambda x: x["puuid"] == "BOT")).collect()
    ]
    # Plain exists would give NULL for the first two rows
    assert got == [False, False, True, False, False]


def test_kda_guard_and_valid_match(spark):
    df = spark.createDataFrame(
        [(3, 0, 4, 10, False, 11), (3, 2, 4, 10, True, 11), (None, 1, 1, None, False, None)],
        "k long, d long, a long, n int, bot boolean, map int",
    )
    rows = df.select(
        kda_ratio("k", "d", "a").alias("kda"),
        valid_match("n", "bot", "map").alias("v"),
        valid_match("n", "bot", "map", required_map=None).alias("v_any"),
    ).collect()
    assert rows[0]["kda"] == 7.0 and rows[1]["kda"] == 3.5 and rows[2]["kda"] is None
    assert [r["v"] for r in rows] == [True, False, False]
    assert [r["v_any"] for r in rows] == [True, False, False]
