"""Large landings are quick to write and read; documents are parsed once, and for what is asked."""

from __future__ import annotations

import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import document, participant, ten
from matchmart import registry
from matchmart.plans import profile
from matchmart.plans.warehouse import build_match, build_player_match
from matchmart.schema import DOCUMENT_SCHEMA, INFO_FIELDS, document_fields
from matchmart.sources import documents as sources
from matchmart.sources.documents import corrupt_documents, document_text, land_jsonl, read_documents, read_raw_text
from matchmart.sources.frames import frames_from_documents
from matchmart.sources.tables import tables_to_documents


@pytest.fixture()
def tables_dir(spark, tmp_path):
    d = str(tmp_path / "tables")
    spark.range(200).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "1.5D AS o_totalprice",
        "timestamp'1996-03-01' + make_interval(0, 0, 0, cast(id % 90 as int)) AS o_orderdate",
        "'1-URGENT' AS o_orderpriority",
    ).write.parquet(f"{d}/orders.parquet")
    # Ten lines an order; of every second order none has the supplier of a bot.
    spark.range(2000).selectExpr(
        "id div 10 AS l_orderkey", "id % 30 AS l_partkey",
        "CASE WHEN id % 20 = 3 THEN 50 ELSE id % 49 + 1 END AS l_suppkey", "cast(id % 10 + 1 as int) AS l_linenumber",
        "1.0D AS l_quantity", "id * 3.25D AS l_extendedprice", "0.1D AS l_discount", "0.1D AS l_tax",
        "'A' AS l_returnflag", "'F' AS l_linestatus",
    ).write.parquet(f"{d}/lineitem.parquet")
    spark.range(30).selectExpr("id AS p_partkey", "concat('B', id) AS p_brand", "cast(id as int) AS p_size").write.parquet(
        f"{d}/part.parquet"
    )
    return d


def texts(rows):
    return sorted((r["raw_json"], r["ingest_date"]) for r in rows.collect())


def files(root):
    return [f for f in glob.glob(f"{root.removeprefix('file:')}/*/*") if os.path.basename(f).startswith("part-")]


def test_large_landings_are_gzip_in_bounded_files(spark, tables_dir, monkeypatch):
    monkeypatch.setattr(registry, "LARGE_LANDING", 0)
    monkeypatch.setattr(sources, "DOCS_PER_WHOLE_FILE", 30)
    for layout in ("jsonl", "raw", "dirty"):
        found = files(registry._landed(spark, tables_dir, layout))
        assert found and all(f.endswith(".gz") for f in found)
        if layout != "raw":
            assert max(len(gzip.open(f, "rt").read().splitlines()) for f in found) <= 30
    expected = texts(document_text(tables_to_documents(spark, tables_dir)))
    assert texts(read_raw_text(spark, registry.staging(spark, tables_dir))) == expected
    assert registry.q_scan_documents(spark, tables_dir).count() == len(expected)


def test_a_landing_compresses_fast(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 20000, 1, 1).selectExpr("concat(sha2(string(id), 256), repeat('a', 50)) AS raw_json", "'2026-08-16' AS ingest_date")
    size = {}
    for level in (sources.GZIP_LEVEL, "BEST_COMPRESSION"):
        monkeypatch.setattr(sources, "GZIP_LEVEL", level)
        land_jsonl(rows, str(tmp_path / level), compression="gzip")
        size[level] = sum(map(os.path.getsize, files(str(tmp_path / level))))
        assert texts(read_raw_text(spark, str(tmp_path / level))) == texts(rows)
    assert size["THREE"] > size["BEST_COMPRESSION"]


@pytest.fixture()
def odd(tmp_path):
    """Lines of documents: whole ones, without an array, a player or an id, torn and not JSON."""
    whole = [
        document("M_1", [participant(1, "S1", early=True), participant(2, "BOT", surrender=True)]),
        document("M_2", ten()),
        document("M_3", None),
        document("M_4", []),
        document("M_5", [participant(1, None)]),
        document(None, ten(), gameDuration="1800.5", map_id="11", queue_id=420.0),
        {"metadata": {"matchId": "M_7"}},
        {"info": {"gameId": "8"}},
        {},
    ]
    whole[4]["info"]["participants"].insert(0, None)
    lines = [json.dumps(d, separators=(",", ":")) for d in whole]
    lines += [lines[1][: len(lines[1]) // 2], lines[0][:-2], "no json"]
    (tmp_path / "ingest_date=2026-08-16").mkdir()
    (tmp_path / "ingest_date=2026-08-16" / "part-0.txt").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def rows(df):
    return sorted(map(str, df.collect()))


def test_documents_read_for_some_fields_give_the_same_rows(spark, odd):
    docs = read_documents(spark, odd, "jsonl")
    fields = document_fields([n for n, _ in INFO_FIELDS], registry.MATCH_PLAYERS)
    some = read_documents(spark, odd, "jsonl", fields=fields)
    whole, part = frames_from_documents(docs), frames_from_documents(some)
    assert "teams" not in str(some.schema) and "championName" not in str(some.schema)
    assert part.matches.columns == whole.matches.columns
    assert rows(part.matches) == rows(whole.matches) and rows(build_match(part)) == rows(build_match(whole))
    columns = ["match_id", "game_start_time", "is_bot_player", "is_early_surrender", "dt"]
    assert rows(build_player_match(part, columns)) == rows(build_player_match(whole).select(*columns))
    assert rows(profile.profile_basic(part.matches)) == rows(profile.profile_basic(whole.matches))
    assert rows(profile.missing_fields(part.matches)) == rows(profile.missing_fields(whole.matches))
    text = lambda d: rows(corrupt_documents(d).select("_corrupt_record", "ingest_date"))
    narrow = read_documents(spark, odd, "jsonl", fields=document_fields([], ["puuid"]))
    assert text(docs) == text(narrow) and len(text(docs)) == 3
    assert rows(frames_from_documents(narrow).participants.select("match_id", "puuid")) == rows(
        whole.participants.select("match_id", "puuid")
    )


def scans(df):
    """JSON scans of a plan and the fields they read."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan json" in line]


def test_the_parser_skips_fields_that_nobody_asks_for(spark, tables_dir):
    whole = DOCUMENT_SCHEMA["info"].dataType["participants"].dataType.elementType.names
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        for name in ("profile_basic", "profile_duration", "player_flags", "player_match_preview", "recent_matches_per_player",
                     "fanout_reconciliation", "match_basic_info", "participant_count", "player_match_edges", "corrupt_records"):
            read = scans(registry.QUERIES[name](spark, tables_dir))
            assert read and all("wardsKilled" in whole and "wardsKilled" not in line for line in read), name
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_graph_queries_parse_the_documents_once(spark, tables_dir, monkeypatch):
    """What they read several times is a table of the few fields they need."""
    read = []
    whole = registry.documents
    monkeypatch.setattr(registry, "documents", lambda *a: read.append(a[2:]) or whole(*a))
    for name in ("frontier_1hop", "frontier_to_target", "new_matches", "new_valid_batch", "manifest_missing"):
        read.clear()
        found = registry.QUERIES[name](spark, tables_dir)
        assert len(read) == 1 and not scans(found), name
        assert not any("/jsonl-" in f for f in found.inputFiles()), name
    fr = registry.graph_frames(spark, tables_dir)
    assert rows(fr.matches.select("match_id", "mapId", "n_participants", "has_bot")) == rows(
        registry.frames(spark, tables_dir).matches.select("match_id", "mapId", "n_participants", "has_bot")
    )


def test_typed_columns_are_not_cast_again(spark, odd):
    """Another lenient cast of 30 columns made the code of a row too long to be compiled."""
    frames = frames_from_documents(read_documents(spark, odd, "jsonl"))
    casts = lambda df: df._jdf.queryExecution().analyzed().toString().count("decimal(38,10)")
    for build, frame in ((build_match, frames.matches), (build_player_match, frames.participants)):
        assert casts(build(frames)) <= casts(frame) + 6  # of times, which are computed
    text = frames.participants.withColumn("kills", F.lit(" 12.7")).withColumn("gameId", F.lit("7"))
    first = build_player_match(type(frames)(frames.matches, text)).first()
    assert (first["kills"], first["game_id"]) == (12, 7)


def test_short_matches_are_parsed_once(spark, tables_dir):
    found = registry.q_short_matches(spark, tables_dir)
    assert not scans(found)
    expected = profile.short_matches(registry.frames(spark, tables_dir).matches, registry.SHORT_SECONDS)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()] and found.count() > 0


def test_lists_of_keys_are_distinct_before_they_are_exploded(spark, tables_dir):
    found = registry.q_document_keys(spark, tables_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate explode(keys")]
    assert above.count("Exchange hashpartitioning(scope") == 1 and "Union" not in above
    # No branch parses a text again for a filter.
    assert "size(" not in plan and plan.count("jsonObjectKeys") == 3
    assert found.where("scope = 'participant'").count() == len(DOCUMENT_SCHEMA["info"].dataType["participants"].dataType.elementType.names)


def test_a_dirty_copy_needs_no_staging(spark, tables_dir):
    shared = os.path.dirname(registry.dirty(spark, tables_dir)).removeprefix("file:")
    assert not os.path.exists(f"{shared}/jsonl-{registry._snapshot_tag(spark, tables_dir)}")
    expected = registry._dirtied(document_text(tables_to_documents(spark, tables_dir)))
    assert texts(read_raw_text(spark, registry.dirty(spark, tables_dir))) == texts(expected)
    assert expected.where(F.length("raw_json") > 0).count() > 200
