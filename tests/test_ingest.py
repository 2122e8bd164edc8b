"""The ingestion run: manifest states, resume, target, compaction of the raw zone."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import document, participant, ten, write_docs
from matchmart.plans import ingest, landing
from matchmart.sources.documents import compactable_text, land_raw, read_documents, read_raw_text


def candidates(spark, path, ids, date="2026-08-01", invalid=()):
    docs = []
    for i in ids:
        players = ten()
        if i in invalid:
            players[0] = participant(1, "BOT")
        docs.append(document(f"M_{i}", players))
    write_docs(str(path), date, docs)
    return read_documents(spark, str(path))


def config(tmp_path, target):
    return ingest.IngestConfig(
        "2026-08-17", str(tmp_path / "raw"), str(tmp_path / "jsonl"), str(tmp_path / "manifest"), target
    )


def ids_in(df):
    return sorted(r["match_id"] for r in df.collect())


def test_batch_is_landed_once(spark, tmp_path):
    docs = candidates(spark, tmp_path / "new", range(1, 10), invalid=(2, 5))
    cfg = config(tmp_path, 4)
    row = ingest.run_ingestion(spark, docs, cfg).first()
    assert (row["status"], row["new_raw_matches"], row["new_valid_matches"]) == ("completed", 6, 4)
    manifest = ingest.read_manifest(spark, cfg.manifest_path)
    assert ids_in(manifest) == [f"M_{i}" for i in range(1, 7)]
    assert all(r["started_at"] and r["completed_at"] >= r["started_at"] for r in manifest.collect())
    landed = read_documents(spark, cfg.raw_root)
    assert ids_in(landing.landed_ids(landed)) == [f"M_{i}" for i in range(1, 7)]
    lines = read_raw_text(spark, cfg.staging_root).collect()
    assert sorted(json.loads(r["raw_json"])["metadata"]["matchId"] for r in lines) == [f"M_{i}" for i in range(1, 7)]
    # A completed batch is left alone; another target is refused.
    again = ingest.run_ingestion(spark, docs, cfg).first()
    assert again["new_raw_matches"] == 6
    with pytest.raises(landing.BatchError):
        ingest.run_ingestion(spark, docs, config(tmp_path, 5))


def test_stored_ids_count_towards_the_target(spark, tmp_path):
    cfg = config(tmp_path, 3)
    with pytest.raises(landing.BatchError):
        ingest.run_ingestion(spark, candidates(spark, tmp_path / "one", [1, 2], invalid=(2,)), cfg)
    manifest = ingest.read_manifest(spark, cfg.manifest_path)
    assert {r["status"] for r in manifest.collect()} == {"incomplete"} and manifest.count() == 2
    row = ingest.run_ingestion(spark, candidates(spark, tmp_path / "two", range(1, 9)), cfg).first()
    assert (row["status"], row["new_valid_matches"], row["new_raw_matches"]) == ("completed", 3, 4)
    assert ids_in(ingest.read_manifest(spark, cfg.manifest_path)) == ["M_1", "M_2", "M_3", "M_4"]
    assert ids_in(landing.landed_ids(read_documents(spark, cfg.raw_root))) == ["M_1", "M_2", "M_3", "M_4"]


def test_a_run_that_stopped_half_way_goes_on(spark, tmp_path, monkeypatch):
    docs = candidates(spark, tmp_path / "new", range(1, 6))
    cfg = config(tmp_path, 3)
    monkeypatch.setattr(ingest, "land_jsonl", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest.run_ingestion(spark, docs, cfg)
    assert {r["status"] for r in ingest.read_manifest(spark, cfg.manifest_path).collect()} == {"in_progress"}
    monkeypatch.undo()
    assert ingest.run_ingestion(spark, docs, cfg).first()["status"] == "completed"
    assert read_documents(spark, cfg.raw_root).count() == 3
    assert read_raw_text(spark, cfg.staging_root).count() == 3


def test_raw_files_are_bounded_and_compactable(spark, tmp_path):
    docs = candidates(spark, tmp_path / "in", range(1, 8)).withColumn("ingest_date", F.lit("2026-08-02"))
    root = str(tmp_path / "raw")
    land_raw(docs.coalesce(1), root, docs_per_file=3)
    assert len(list((tmp_path / "raw").rglob("part-*.txt"))) in (3, 4)
    small = str(tmp_path / "small")
    land_raw(docs.coalesce(1), small, bytes_per_file=1)
    assert len(list((tmp_path / "small").rglob("part-*.txt"))) == 7
    assert ids_in(landing.landed_ids(read_documents(spark, root))) == [f"M_{i}" for i in range(1, 8)]
    got = compactable_text(spark, root).union(compactable_text(spark, str(tmp_path / "in")))
    texts = [r["raw_json"] for r in got.collect()]
    assert len(texts) == 14 and all("\n" not in t and '": ' not in t for t in texts)


def test_history_is_not_read_again(spark, tmp_path):
    """The second batch finds landed ids by the index: what landed before may be
    unreadable and is not missed."""
    cfg = config(tmp_path, 2)
    ingest.run_ingestion(spark, candidates(spark, tmp_path / "one", range(1, 4)), cfg)
    for f in (tmp_path / "raw" / "ingest_date=2026-08-17").glob("*.txt"):
        f.write_text("{broken")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    later = ingest.IngestConfig("2026-08-18", cfg.raw_root, cfg.staging_root, cfg.manifest_path, 3)
    row = ingest.run_ingestion(spark, candidates(spark, tmp_path / "two", range(1, 9)), later).first()
    assert (row["status"], row["new_valid_matches"]) == ("completed", 3)
    mine = ingest.read_manifest(spark, cfg.manifest_path).where("batch_date = '2026-08-18'")
    assert ids_in(mine) == ["M_3", "M_4", "M_5"]


def test_compaction_names_a_file_it_cannot_read(spark, tmp_path):
    docs = candidates(spark, tmp_path / "new", range(1, 4))
    cfg = config(tmp_path, 2)
    folder = tmp_path / "raw" / "ingest_date=2026-08-17"
    folder.mkdir(parents=True)
    (folder / "torn.json").write_text('[{"metadata": {"matchId": "M_77"}}, {"meta')
    with pytest.raises(landing.BatchError, match="torn.json"):
        ingest.run_ingestion(spark, docs, cfg)


def test_of_two_copies_the_one_judged_is_the_one_landed(spark, tmp_path):
    one = candidates(spark, tmp_path / "a", [1], invalid=(1,))
    two = candidates(spark, tmp_path / "b", [1])
    both = one.union(two).drop("source_file")
    cfg = config(tmp_path, 1)
    try:
        ingest.run_ingestion(spark, both, cfg)
    except landing.BatchError:
        pass
    judged = ingest.read_manifest(spark, cfg.manifest_path).first()["is_valid"]
    kept = read_documents(spark, cfg.raw_root).selectExpr("exists(info.participants, p -> p.puuid = 'BOT') AS bot").first()
    assert judged != kept["bot"]
