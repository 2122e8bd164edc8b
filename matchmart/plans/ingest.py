"""One day's collection, end to end.

``run_ingestion`` composes the landing steps (``plans.landing``) around a
persisted manifest: plan, select, record, land raw, compact, land JSONL, check,
complete. Each step can be repeated: a run that stops anywhere is resumed by
the next, whose stored ids count towards the target.

Which candidates are new is asked of the index of landed ids
(``operators.idindex``), so history is not parsed again: a run reads the index
buckets of its candidates and the raw partition of its own batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmart.operators.idindex import IdIndex
from matchmart.plans import landing
from matchmart.schema import METADATA_SCHEMA
from matchmart.session import discard, materialize, path_exists
from matchmart.sources.documents import (
    compactable_text,
    earliest_per_id,
    land_jsonl,
    land_raw,
    read_documents,
    read_raw_text,
)
from matchmart.sources.frames import frames_from_documents

MANIFEST_SCHEMA = (
    "status string, target_new_matches int, match_id string, is_valid boolean, "
    "started_at timestamp, updated_at timestamp, completed_at timestamp, batch_date string"
)


#: All that is read of a landed document to know its id.
_ID_ONLY = T.StructType([T.StructField("metadata", T.StructType([METADATA_SCHEMA["matchId"]]))])


@dataclass
class IngestConfig:
    batch_date: str
    raw_root: str
    staging_root: str
    manifest_path: str
    target: int = landing.DEFAULT_TARGET

    @property
    def index(self) -> IdIndex:
        return IdIndex(self.raw_root.rstrip("/") + "_ids")


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The persisted manifest, one row per (batch, id); None before the first batch."""
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path) if path_exists(spark, path) else None


def _record(rows: DataFrame, cfg: IngestConfig, status: str, started: Column, completed: Column) -> None:
    """Replace the batch's partition of the manifest."""
    out = rows.select(
        F.lit(status).alias("status"),
        F.lit(cfg.target).alias("target_new_matches"),
        "match_id",
        "is_valid",
        started.cast("timestamp").alias("started_at"),
        F.current_timestamp().alias("updated_at"),
        completed.cast("timestamp").alias("completed_at"),
        F.lit(cfg.batch_date).alias("batch_date"),
    )
    # Staged first: the rows may come from the partition they replace.
    staged = materialize(out, "manifest")
    try:
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_date").parquet(
            cfg.manifest_path
        )
    finally:
        discard(staged)


def run_ingestion(spark: SparkSession, candidates: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Land the batch of ``cfg.batch_date`` from candidate documents (``metadata``,
    ``info``, ``ingest_date``); returns its one-row ``manifest_summary``.

    A completed batch is left alone. Otherwise the ids stored for the batch stay
    and count, and the first new valid documents in id order are added until
    ``cfg.target`` is met, with the invalid ones before the last of them. Raises
    ``BatchError``, after all that was found is landed and recorded as
    ``incomplete``, where the target isn't reached.
    """
    landing.check_batch_date(cfg.batch_date)
    manifest = read_manifest(spark, cfg.manifest_path)
    plan = landing.plan_batch(manifest, cfg.batch_date, cfg.target)
    in_batch = F.col("batch_date") == cfg.batch_date
    if plan.action == "skip":
        return landing.manifest_summary(manifest.where(in_batch))
    stored = (
        materialize(manifest.where(in_batch).select("match_id", "is_valid", "started_at"), "stored")
        if plan.action == "resume"
        else spark.createDataFrame([], "match_id string, is_valid boolean, started_at timestamp")
    )
    begun = stored.agg(F.min("started_at").alias("at"), F.count_if("is_valid").alias("n")).first()
    started = F.lit(begun["at"]) if begun["at"] else F.current_timestamp()

    if not cfg.index.exists(spark) and path_exists(spark, cfg.raw_root):
        # A raw zone from before there was an index: its ids are read once.
        cfg.index.add(landing.landed_ids(read_documents(spark, cfg.raw_root, fields=_ID_ONLY)), "before")
    # One document per id, the same one here and where it lands.
    candidates = earliest_per_id(candidates.withColumn("match_id", F.col("metadata.matchId")))
    landed = cfg.index.landed(candidates)
    known = stored.select("match_id").union(landed)
    found = landing.with_validity(frames_from_documents(candidates).matches)
    new = materialize(
        landing.select_new(found, known).select("match_id", "is_valid", "ingest_date"), "new-matches"
    )
    needed = max(cfg.target - begun["n"], 0)
    last = landing.first_valid(new, needed).agg(F.max("match_id").alias("id"), F.count(F.lit(1)).alias("n")).first()
    reached = last["n"] >= needed
    added = new if not reached else new.where(F.col("match_id") <= F.lit(last["id"]))
    ids = materialize(
        stored.select("match_id", "is_valid").union(added.select("match_id", "is_valid")), "batch-ids"
    )
    try:
        # What is about to land is recorded before it lands: in the manifest, from
        # which a resumed run lands it, and in the index, so that no other batch does.
        _record(ids, cfg, landing.IN_PROGRESS, started, F.lit(None))
        cfg.index.add(ids, cfg.batch_date)
        _land(spark, candidates, ids, cfg)
        status = landing.COMPLETED if reached else landing.INCOMPLETE
        _record(ids, cfg, status, started, F.current_timestamp() if reached else F.lit(None))
    finally:
        discard(new, ids, landed, *([stored] if plan.action == "resume" else []))
    summary = landing.manifest_summary(read_manifest(spark, cfg.manifest_path).where(in_batch))
    if not reached:
        row = summary.first()
        raise landing.BatchError(
            f"batch {cfg.batch_date} has {row['new_valid_matches']} valid matches and wants {cfg.target}"
        )
    return summary


def _land(spark: SparkSession, candidates: DataFrame, ids: DataFrame, cfg: IngestConfig) -> None:
    """Land the batch's documents (``candidates``: one per id) raw, then compact;
    check both against the ids."""
    in_batch = F.col("ingest_date") == cfg.batch_date
    docs = landing.manifest_members(candidates, ids)
    own = lambda: read_documents(spark, cfg.raw_root, ingest_dates=[cfg.batch_date], fields=_ID_ONLY)
    if path_exists(spark, f"{cfg.raw_root}/ingest_date={cfg.batch_date}"):
        # A run that stopped half way may have landed some.
        docs = docs.join(landing.landed_ids(own()), "match_id", "left_anti")
    docs = docs.drop("match_id", "ingest_date").withColumn("ingest_date", F.lit(cfg.batch_date))
    land_raw(docs, cfg.raw_root, mode="append")
    landing.assert_no_file_id_mismatch(own())
    landing.assert_complete(landing.manifest_missing(ids, landing.landed_ids(own())))

    raw = compactable_text(spark, cfg.raw_root).where(in_batch)
    landing.assert_readable(raw)
    land_jsonl(landing.compact_batch(raw, ids, cfg.batch_date), cfg.staging_root)
    written = read_raw_text(spark, cfg.staging_root).where(in_batch)
    row = landing.compaction_reconciliation(written, ids, cfg.batch_date).first()
    if row["status"] != "PASS":
        raise landing.BatchError(
            f"batch {cfg.batch_date}: {row['lines_written']} lines written for {row['manifest_ids']} ids"
        )
