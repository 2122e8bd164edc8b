"""Incremental landing with Structured Streaming (R1, R7, R8 as a stream).

The collector's "skip what was already fetched" is what a file-source stream
gives for free: the source's checkpoint records which files were processed,
so each run with ``trigger(availableNow=True)`` reads only files that arrived
since the last run, then stops. Each micro-batch:

1. keeps one document per id (the earliest ingest date, then file, then text; a
   re-fetched document is the same document) and drops ids that the index of
   landed ids holds (first save wins; ``operators.idindex``: only the touched
   buckets are read, never the landed documents);
2. adds the new ids to the index, then writes their documents, documents without
   an id (corrupt files, NULL or '' ids) and one manifest row per new id (batch,
   id, validity), each as this batch's own partition;
3. writes one accounting row, and fails unless every document of the batch was
   landed, repeats another of the batch, was landed before, or was set aside,
   each of them counted on its own.

What is new is decided once, in a staged copy that a replayed batch finds; all
else replaces the batch's own partitions. So a batch replayed after a failure
(an executor or the driver lost between a write and the checkpoint commit)
leaves the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.functions.exprs import valid_match
from matchmart.operators.idindex import IdIndex
from matchmart.session import delete_path, discard, path_exists
from matchmart.sources.documents import RAW_TEXT_SCHEMA, READ_SCHEMA, earliest_per_id, parse_files
from matchmart.sources.frames import frames_from_documents


@dataclass
class IncrementalLanding:
    source_root: str  # raw zone (or a drop folder) of JSON documents
    landed_path: str  # Parquet table of landed documents
    manifest_path: str  # Parquet table (batch_date, match_id, is_valid, batch_id)
    checkpoint: str  # stream checkpoint (shared storage)
    layout: str = "raw"  # "raw" (whole files) or "jsonl"
    max_files_per_trigger: int | None = None

    @property
    def quarantine_path(self) -> str:
        return self.landed_path.rstrip("/") + "_quarantine"

    @property
    def accounting_path(self) -> str:
        return self.landed_path.rstrip("/") + "_accounting"

    @property
    def index(self) -> IdIndex:
        return IdIndex(self.landed_path.rstrip("/") + "_ids")

    def stage(self, batch_id: int) -> str:
        return f"{self.checkpoint.rstrip('/')}/staged/batch={batch_id}"


def _own_partition(rows: DataFrame, path: str, *columns: str) -> None:
    """Write rows as partitions that a replay of the batch replaces."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def _process(cfg: IncrementalLanding):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index, stage = cfg.index, cfg.stage(batch_id)
        # The batch before is committed: nothing replays it.
        delete_path(spark, cfg.stage(batch_id - 1))
        if not index.exists(spark) and path_exists(spark, cfg.landed_path):
            # A table landed before there was an index: its ids are read once.
            index.add(spark.read.parquet(cfg.landed_path).select(F.col("metadata.matchId").alias("match_id")), "before")

        named = batch.withColumn("match_id", F.col("metadata.matchId")).where("match_id <> ''")
        if not path_exists(spark, stage + "/new/_SUCCESS"):
            landed = index.landed(named)
            landed.write.mode("overwrite").parquet(stage + "/landed")
            fresh = earliest_per_id(named).join(landed, "match_id", "left_anti")
            fresh.drop("source_file").write.mode("overwrite").parquet(stage + "/new")
            discard(landed)
        new = spark.read.parquet(stage + "/new").withColumn("batch_id", F.lit(batch_id))

        # Ids before documents: whoever finds a document landed finds its id.
        index.add(new, f"{batch_id}")
        _own_partition(new.drop("match_id"), cfg.landed_path, "ingest_date", "batch_id")
        aside = batch.where("coalesce(metadata.matchId, '') = ''").withColumn("batch_id", F.lit(batch_id))
        _own_partition(aside, cfg.quarantine_path, "batch_id")
        rows = frames_from_documents(new.drop("match_id")).matches.select(
            F.col("ingest_date").alias("batch_date"),
            "match_id",
            valid_match("n_participants", "has_bot", "mapId").alias("is_valid"),
            F.lit(batch_id).alias("batch_id"),
        )
        _own_partition(rows, cfg.manifest_path, "batch_id")
        _account(spark, cfg, batch, batch_id)

    return run


def _written(spark: SparkSession, path: str, batch_id: int) -> int:
    """Rows of the batch's partitions of a table, read back."""
    if not path_exists(spark, path):
        return 0
    # A batch without rows leaves a table without files.
    rows = spark.read.schema("batch_id int").parquet(path)
    return rows.where(F.col("batch_id") == batch_id).count()


def _account(spark: SparkSession, cfg: IncrementalLanding, batch: DataFrame, batch_id: int) -> None:
    """One row a batch: documents in, landed, duplicates, quarantined. Duplicates
    are those that repeat an id of the batch and those whose id was landed
    before; they are counted in the batch and in the index, not by subtraction."""
    ident = F.coalesce("metadata.matchId", F.lit(""))
    seen = batch.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ident != "").alias("named"),
        F.count_distinct(F.when(ident != "", ident)).alias("ids"),
    ).first()
    before = spark.read.schema("match_id string").parquet(cfg.stage(batch_id) + "/landed").count()
    landed = _written(spark, cfg.landed_path, batch_id)
    aside = _written(spark, cfg.quarantine_path, batch_id)
    duplicates = seen["named"] - seen["ids"] + before
    if landed + duplicates + aside != seen["n"]:
        raise RuntimeError(
            f"batch {batch_id}: of {seen['n']} documents {landed} landed, {duplicates} are duplicates "
            f"and {aside} were set aside"
        )
    row = [(batch_id, seen["n"], landed, duplicates, aside)]
    columns = "batch_id long, documents long, landed long, duplicates long, quarantined long"
    spark.createDataFrame(row, columns).coalesce(1).write.mode("overwrite").parquet(
        f"{cfg.accounting_path}/batch={batch_id}"
    )


def run_incremental_landing(spark: SparkSession, cfg: IncrementalLanding) -> None:
    """Process every file that arrived since the last run, then stop."""
    raw = cfg.layout == "raw"
    reader = spark.readStream.schema(RAW_TEXT_SCHEMA if raw else READ_SCHEMA)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    files = reader.text(cfg.source_root, wholetext=True) if raw else reader.json(cfg.source_root)
    files = files.withColumn("source_file", F.col("_metadata.file_path"))
    stream = parse_files(files) if raw else files
    q = (
        stream.writeStream.foreachBatch(_process(cfg))
        .option("checkpointLocation", cfg.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
