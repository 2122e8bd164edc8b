"""Incremental landing stream: only new files, first save wins, idempotent."""

from conftest import document, participant, ten, write_docs
from matchmart.streaming.incremental import IncrementalLanding, run_incremental_landing


def test_incremental_landing(spark, tmp_path):
    src = str(tmp_path / "drop")
    cfg = IncrementalLanding(
        source_root=src,
        landed_path=str(tmp_path / "landed"),
        manifest_path=str(tmp_path / "manifest"),
        checkpoint=str(tmp_path / "ckpt"),
    )
    bot = ten()
    bot[0] = participant(1, "BOT")
    write_docs(src, "2026-08-16", [document("M_1", ten()), document("M_2", bot)])
    run_incremental_landing(spark, cfg)
    landed = spark.read.parquet(cfg.landed_path)
    assert sorted(r[0] for r in landed.select("metadata.matchId").collect()) == ["M_1", "M_2"]

    # a second run with nothing new is a no-op
    run_incremental_landing(spark, cfg)
    assert spark.read.parquet(cfg.landed_path).count() == 2

    # next day: one new document and a re-fetch of M_1 (never overwritten)
    changed = document("M_1", ten(), duration=99)
    write_docs(src, "2026-08-17", [document("M_3", ten()), changed])
    run_incremental_landing(spark, cfg)
    landed = spark.read.parquet(cfg.landed_path)
    assert landed.count() == 3
    m1 = landed.where("metadata.matchId = 'M_1'").first()
    assert m1["info"]["gameDuration"] == "1800" and str(m1["ingest_date"]) == "2026-08-16"
    man = {r["match_id"]: r for r in spark.read.parquet(cfg.manifest_path).collect()}
    assert set(man) == {"M_1", "M_2", "M_3"}
    assert man["M_2"]["is_valid"] is False and man["M_3"]["is_valid"] is True


def test_micro_batch_replay_is_idempotent(spark, tmp_path):
    # A batch replayed after a failure (between its writes and the checkpoint
    # commit) must not land documents or manifest rows twice.
    from matchmart.sources.documents import read_documents
    from matchmart.streaming.incremental import _process

    src = str(tmp_path / "drop")
    write_docs(src, "2026-08-16", [document("M_1", ten()), document("M_2", ten())])
    cfg = IncrementalLanding(
        source_root=src,
        landed_path=str(tmp_path / "landed"),
        manifest_path=str(tmp_path / "manifest"),
        checkpoint=str(tmp_path / "ckpt"),
    )
    batch = read_documents(spark, src)
    run = _process(cfg)
    run(batch, 0)
    run(batch, 0)  # replay of the same batch id
    assert spark.read.parquet(cfg.landed_path).count() == 2
    assert spark.read.parquet(cfg.manifest_path).count() == 2


def test_every_document_is_accounted_for(spark, tmp_path):
    src = str(tmp_path / "drop")
    cfg = IncrementalLanding(
        source_root=src,
        landed_path=str(tmp_path / "landed"),
        manifest_path=str(tmp_path / "manifest"),
        checkpoint=str(tmp_path / "ckpt"),
    )
    nameless, blank = document("M_9", ten()), document("M_8", ten())
    nameless["metadata"]["matchId"] = None
    blank["metadata"]["matchId"] = ""
    docs = [document("M_1", ten()), document("M_1", ten(), duration=99), nameless, blank, blank]
    write_docs(src, "2026-08-16", docs, names=[f"d{i}.json" for i in range(5)])
    (tmp_path / "drop" / "ingest_date=2026-08-16" / "broken.json").write_text("{not json")
    run_incremental_landing(spark, cfg)
    row = spark.read.parquet(f"{cfg.accounting_path}/*").first()
    assert (row["documents"], row["landed"], row["duplicates"], row["quarantined"]) == (6, 1, 1, 4)
    aside = spark.read.parquet(cfg.quarantine_path)
    assert aside.count() == 4 and aside.select("source_file").distinct().count() == 4
    assert spark.read.parquet(cfg.landed_path).first()["info"]["gameDuration"] == "1800"


def test_landed_documents_are_not_read_again(spark, tmp_path):
    """Later batches ask the index; a spoilt landed file doesn't matter, and a
    re-fetched document counts as a duplicate."""
    src = str(tmp_path / "drop")
    cfg = IncrementalLanding(
        source_root=src,
        landed_path=str(tmp_path / "landed"),
        manifest_path=str(tmp_path / "manifest"),
        checkpoint=str(tmp_path / "ckpt"),
    )
    write_docs(src, "2026-08-16", [document("M_1", ten()), document("M_2", ten())])
    run_incremental_landing(spark, cfg)
    for f in (tmp_path / "landed").rglob("*.parquet"):
        f.write_bytes(b"spoilt")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    write_docs(src, "2026-08-17", [document("M_3", ten()), document("M_1", ten())])
    run_incremental_landing(spark, cfg)
    assert [r["match_id"] for r in spark.read.parquet(cfg.manifest_path).where("batch_id = 1").collect()] == ["M_3"]
    row = spark.read.parquet(f"{cfg.accounting_path}/batch=1").first()
    assert (row["documents"], row["landed"], row["duplicates"], row["quarantined"]) == (2, 1, 1, 0)
    # Only the last batch's staged copy is left.
    assert [p.name for p in (tmp_path / "ckpt" / "staged").iterdir() if not p.name.startswith(".")] == ["batch=1"]


def test_a_lost_document_is_no_duplicate(spark, tmp_path):
    import pytest
    from matchmart.sources.documents import read_documents
    from matchmart.streaming import incremental

    src = str(tmp_path / "drop")
    write_docs(src, "2026-08-16", [document("M_1", ten()), document("M_2", ten())])
    cfg = IncrementalLanding(src, str(tmp_path / "landed"), str(tmp_path / "manifest"), str(tmp_path / "ckpt"))
    batch = read_documents(spark, src)
    incremental._process(cfg)(batch, 0)
    lost = next(f for f in (tmp_path / "landed").rglob("*.parquet"))
    lost.unlink()
    with pytest.raises(RuntimeError, match="of 2 documents 0 landed, 0 are duplicates"):
        incremental._account(spark, cfg, batch, 0)
