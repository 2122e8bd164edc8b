"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the adapter in
``matchmart.sources.tables``), or files Spark lands from them, and runs over
them whole. Landed files live under the session's shared checkpoint location
and are written once per input snapshot.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmart.functions.exprs import (
    date_string_from_epoch_s,
    epoch_ms_to_s,
    flag,
    human_ids,
    patch_by_split,
    patch_version,
    timestamp_string_from_epoch_s,
    typed,
    valid_match,
)
from matchmart.operators.graph import (
    collect_to_target,
    expand_frontier,
    player_match_edges,
    recent_matches,
    seed_players,
)
from matchmart.operators.idindex import IdIndex
from matchmart.plans import landing, profile, quality, tables, versions
from matchmart.plans.daily import STAGE_LOG_SCHEMA, StageLog
from matchmart.plans.warehouse import (
    Layers,
    build_champion_day,
    build_champion_day_metrics,
    build_dim_champion,
    build_dim_patch,
    build_dim_queue,
    build_match,
    build_match_from_text,
    build_player_match,
    slice_metrics,
)
from matchmart.schema import (
    CORRUPT_COLUMN,
    DOCUMENT_SCHEMA,
    INFO_FIELDS,
    INFO_SCHEMA,
    LAYER_DDL,
    METADATA_SCHEMA,
    PARTICIPANT_FIELDS,
    PARTICIPANT_SCHEMA,
    PLAYER_COLUMNS,
    TEAM_SCHEMA,
    document_fields,
    lenient,
)
from matchmart.session import (
    apply_defaults,
    delete_path,
    file_states,
    materialize,
    path_exists,
    publish_folder,
    scratch_dir,
    shared_path,
)
from matchmart.sources.documents import (
    compactable_text,
    corrupt_documents,
    document_text,
    ingest_date_from_path,
    land_jsonl,
    land_raw,
    read_documents,
    read_raw_text,
)
from matchmart.sources.frames import MatchFrames, frames_from_documents
from matchmart.sources.tables import bucketed_documents, packed

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Scenario of the landing/graph keys (fixed test parameters).
LANDED_DATE = "2026-08-16"  # documents already in the raw zone
BATCH_DATE = "2026-08-17"  # the batch being collected
BATCH_TARGET = 20  # new valid matches per batch (collector default)
RECENT_PER_PLAYER = 20  # candidates per player (collector default)
COLLECT_RECENT = 200  # candidates per player of the collector's loop here (its matches are rarely valid)
COLLECT_TARGET = 3  # new valid matches after which the loop stops
CUT_TARGET = 3  # a batch target below what the batch offers
LAYER_TABLES = ["dwd_match", "dwd_player_match", "dws_champion_day", "ads_champion_day_metrics"]
DATABASE = "matchmart"
OVERWRITTEN_YEAR = "1996"  # the part of the table that the overwrite keys write again
PREVIEW_ROWS = 30  # rows shown by the preview
SLICE = {"queue_id": 420, "date_from": "1996-01-01", "date_to": "1997-12-31"}
SHORT_SECONDS = 300


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


# --- inputs -----------------------------------------------------------------


#: Participants' fields that a match's own row is made of.
MATCH_PLAYERS = ["puuid", "gameEndedInEarlySurrender", "gameEndedInSurrender"]
#: What tells players' matches, their times and whether they are valid.
_GRAPH = document_fields(["mapId", "gameStartTimestamp"], ["puuid"])


def frames(spark: SparkSession, sf_dir: str) -> MatchFrames:
    """The flat form of the landed JSON documents; matches are read without what
    only participants' rows are made of."""
    fields = document_fields([n for n, _ in INFO_FIELDS], MATCH_PLAYERS)
    matches = frames_from_documents(documents(spark, sf_dir, fields)).matches
    return MatchFrames(matches, frames_from_documents(documents(spark, sf_dir)).participants)


def graph_frames(spark: SparkSession, sf_dir: str) -> MatchFrames:
    """The same of the ``_GRAPH`` fields alone, for queries that read them several
    times: the JSON is parsed once, into a Parquet table."""
    docs = documents(spark, sf_dir, _GRAPH).select("metadata", "info", "ingest_date")
    return frames_from_documents(materialize(docs, "graph-documents"))


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers from the documents, each built from the one below."""
    return Layers(frames(spark, sf_dir))


def _player_match(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """``dwd_player_match`` from the documents, for some of its columns: only their
    participants' fields are read."""
    players = ["puuid", "gameEndedInEarlySurrender", *[f for out, f, _ in PLAYER_COLUMNS if out in columns]]
    docs = documents(spark, sf_dir, document_fields([n for n, _ in INFO_FIELDS], list(dict.fromkeys(players))))
    return build_player_match(frames_from_documents(docs), columns)


def stored_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The layers as stored tables."""
    return {n: stored_layer(spark, sf_dir, n) for n in LAYER_TABLES}


def stored_layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One layer as a stored table, for what reads it: built from the stored ones
    below, once per input snapshot. Layers that nobody asks for aren't stored."""
    return spark.read.parquet(f"{_landed(spark, sf_dir, name)}/rows")


def _store_layer(spark: SparkSession, sf_dir: str, name: str, root: str) -> None:
    """A layer and the log of its stage; rows are counted as they are written."""
    below = lambda layer: stored_layer(spark, sf_dir, layer)
    if name == "dws_champion_day":
        rows = build_champion_day(below("dwd_player_match"), below("dwd_match"))
    elif name == "ads_champion_day_metrics":
        rows = build_champion_day_metrics(below("dws_champion_day"))
    else:
        rows = getattr(layers(spark, sf_dir), name)
    log = StageLog()
    log.run(name, lambda watch: watch(rows).write.options(**packed(rows)).parquet(f"{root}/rows"))
    spark.createDataFrame(log.rows, STAGE_LOG_SCHEMA).coalesce(1).write.parquet(f"{root}/stage_log")


def catalog(spark: SparkSession, sf_dir: str) -> str:
    """A database of this session for the tables of an input snapshot; its name."""
    name = f"{DATABASE}_{_snapshot_tag(spark, sf_dir)}"
    with _LANDING_LOCK:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_dir(spark, name)}'")
    return name


def catalog_layers(spark: SparkSession, sf_dir: str) -> str:
    """The same with the stored layers as tables."""
    name = catalog(spark, sf_dir)
    for table in LAYER_TABLES:
        root = _landed(spark, sf_dir, table)
        with _LANDING_LOCK:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name}.{table} USING parquet LOCATION '{root}/rows'")
    return name


def _own_table(spark: SparkSession, database: str, columns: str, partition: str | None = None) -> str:
    """A new empty table for one call of a write-then-read key; its name."""
    name = f"{database}.t_{uuid.uuid4().hex}"
    by = f" PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING orc{by} LOCATION '{scratch_dir(spark)}'")
    return name


def documents(spark: SparkSession, sf_dir: str, fields: T.StructType = DOCUMENT_SCHEMA) -> DataFrame:
    """Landed documents, or their ``fields``, parsed from the JSONL staging copy
    (compact, so it parses faster than the pretty multi-line raw zone; the raw-zone
    scan keys read that one)."""
    return read_documents(spark, staging(spark, sf_dir), "jsonl", fields=fields)


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ODS raw-text rows ``(raw_json, ingest_date)`` over JSONL staging."""
    return read_raw_text(spark, staging(spark, sf_dir))


LANDING_VERSION = "5"  # bump when the landed layout or document mapping changes

#: JSON takes some 30 times the space of the tables it is made of. bzip2 gives back a
#: factor of 14 and its files can be split, which few files need; its CPU time is 20 times
#: that of a fast gzip (a factor of 6), so beyond ``LARGE_LANDING`` bytes of line items,
#: where buckets make enough files, copies are gzip.
LANDED_CODEC, LARGE_CODEC = "bzip2", "gzip"
LARGE_LANDING = 1 << 20


def _landed_codec(spark: SparkSession, sf_dir: str) -> str:
    states = file_states(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return LANDED_CODEC if sum(size for _, size, _ in states) < LARGE_LANDING else LARGE_CODEC


def _snapshot_tag(spark: SparkSession, sf_dir: str) -> str:
    """Tag of the input tables (every file's name, size and time) and the landing
    layout version, naming the landed copy."""
    states = [file_states(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("orders", "lineitem", "part")]
    return hashlib.sha1(f"{LANDING_VERSION}:{states}".encode()).hexdigest()[:16]


_LANDING_LOCK = threading.RLock()


def _landed(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """Land the documents (or store their layers) once per input snapshot; return
    the root path. A copy is written under a name of its own and published by
    one rename, so readers and other applications only ever see whole ones."""
    root = shared_path(spark, f"{layout}-{_snapshot_tag(spark, sf_dir)}")
    with _LANDING_LOCK:  # queries run from several threads land once
        if not path_exists(spark, root):
            apply_defaults(spark)
            own, codec = f"{root}-{uuid.uuid4().hex}", _landed_codec(spark, sf_dir)
            if layout in LAYER_TABLES:
                _store_layer(spark, sf_dir, layout, own)
            elif layout == "dirty" and path_exists(spark, shared_path(spark, f"jsonl-{_snapshot_tag(spark, sf_dir)}")):
                land_jsonl(_dirtied(raw_text(spark, sf_dir)), own, compression=codec)
            else:
                with bucketed_documents(spark, sf_dir) as docs:
                    if layout == "raw":
                        land_raw(docs, own, compression=codec)
                    else:
                        # A dirty copy needs the texts, not that they are staged.
                        text = document_text(docs)
                        land_jsonl(_dirtied(text) if layout == "dirty" else text, own, compression=codec)
            publish_folder(spark, own, root)
    return root


def raw_zone(spark: SparkSession, sf_dir: str) -> str:
    return _landed(spark, sf_dir, "raw")


def staging(spark: SparkSession, sf_dir: str) -> str:
    return _landed(spark, sf_dir, "jsonl")


def _dirtied(raw: DataFrame) -> DataFrame:
    """Texts of documents as a careless source would send them: of the documents
    whose number is divisible by 41 only the first half arrives, by 43 the id is
    null, by 47 they come twice; by the number's remainder by 3 the duration is
    text, has a half second more, or is as it was."""
    k = F.regexp_extract("raw_json", r'"gameId":(\d+)', 1).cast("long")
    text = F.when(k % 43 == 0, F.regexp_replace("raw_json", r'"matchId":"[^"]*"', '"matchId":null')).otherwise(
        F.col("raw_json")
    )
    duration = r'"gameDuration":(\d+)'
    text = (
        F.when(k % 3 == 0, F.regexp_replace(text, duration, '"gameDuration":"$1"'))
        .when(k % 3 == 1, F.regexp_replace(text, duration, '"gameDuration":$1.5'))
        .otherwise(text)
    )
    rows = raw.select(text.alias("t"), k.alias("k"), "ingest_date")
    rows = rows.select(
        F.expr("CASE WHEN k % 41 = 0 THEN substr(t, 1, length(t) div 2) ELSE t END").alias("raw_json"),
        F.expr("explode(sequence(1, CASE WHEN k % 47 = 0 THEN 2 ELSE 1 END))").alias("copy"),
        "ingest_date",
    )
    return rows.drop("copy")


def dirty(spark: SparkSession, sf_dir: str) -> str:
    return _landed(spark, sf_dir, "dirty")


def quality_inputs(spark: SparkSession, sf_dir: str, rule_ids=tuple(quality.RULE_NAMES)) -> quality.QualityInputs:
    """The stored layers that ``rule_ids`` read."""
    return quality.QualityInputs(**{n: stored_layer(spark, sf_dir, n) for n in quality.layers_read(rule_ids)})


_KIND = dict(PARTICIPANT_FIELDS)


def _player(field: str, column: str = "p"):
    """A participant's field, cast from its text."""
    return typed(f"{column}.{field}", _KIND[field])


# --- scans / sources --------------------------------------------------------


METADATA_ONLY = [T.StructField("metadata", T.StructType([METADATA_SCHEMA["matchId"]]))]

#: What the scan keys take from a document.
_SCANNED = T.StructType(
    [
        *METADATA_ONLY,
        T.StructField(
            "info",
            T.StructType(
                [
                    INFO_SCHEMA["gameId"],
                    INFO_SCHEMA["gameVersion"],
                    T.StructField("participants", T.ArrayType(T.StructType([PARTICIPANT_SCHEMA["participantId"]]))),
                ]
            ),
        ),
    ]
)


def _scan_projection(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("metadata.matchId").alias("match_id"),
        "ingest_date",
        typed("info.gameId", T.LongType()).alias("game_id"),
        F.col("info.gameVersion").alias("game_version"),
        F.size("info.participants").alias("participant_count"),
    )


@query("scan_documents")
def q_scan_documents(spark, sf_dir):
    """Every ingest date of the raw zone."""
    return _scan_projection(read_documents(spark, raw_zone(spark, sf_dir), "raw", fields=_SCANNED))


@query("scan_one_ingest_date")
def q_scan_one_ingest_date(spark, sf_dir):
    """S3: one partition; the others are pruned."""
    docs = read_documents(spark, raw_zone(spark, sf_dir), "raw", ingest_dates=[LANDED_DATE], fields=_SCANNED)
    return _scan_projection(docs)


@query("source_ingest_date")
def q_source_ingest_date(spark, sf_dir):
    """Ingest date recovered from each document's file path."""
    docs = read_documents(spark, raw_zone(spark, sf_dir), "raw", fields=T.StructType(_SCANNED.fields[:1]))
    return docs.select(
        F.col("metadata.matchId").alias("match_id"),
        ingest_date_from_path("source_file").alias("source_ingest_date"),
    )


@query("ods_raw")
def q_ods_raw(spark, sf_dir):
    """Raw-text table over JSONL staging; literal flags on compact text."""
    raw = read_raw_text(spark, staging(spark, sf_dir))
    return raw.select(
        F.get_json_object("raw_json", "$.metadata.matchId").alias("match_id"),
        "ingest_date",
        flag(F.instr("raw_json", '"puuid":"BOT"') > 0).alias("is_bot_match"),
        flag(F.instr("raw_json", '"gameEndedInEarlySurrender":true') > 0).alias(
            "is_early_surrender"
        ),
    )


@query("layer_row_counts")
def q_layer_row_counts(spark, sf_dir):
    """S6, A1, PF4: row count of each of the four layers, read from the catalog."""
    database = catalog_layers(spark, sf_dir)
    counts = tables.row_counts(spark, [f"{database}.{t}" for t in LAYER_TABLES])
    return counts.select(F.substring_index("layer", ".", -1).alias("layer"), "cnt")


# --- tables: written, then read from the catalog ------------------------------


@query("stage_log")
def q_stage_log(spark, sf_dir):
    """Rows that each stage of building the layers wrote, and their total."""
    log = StageLog()
    for name in LAYER_TABLES:  # one row each
        log.rows += map(tuple, spark.read.parquet(f"{_landed(spark, sf_dir, name)}/stage_log").collect())
    return log.to_df(spark).select("stage", "rows", "status")


def _by_year(spark, sf_dir):
    """Matches by year: the table that the overwrite keys write."""
    rows = stored_layer(spark, sf_dir, "dwd_match")
    return rows.select("match_id", "game_id", F.substring("dt", 1, 4).alias("dt"))


@query("overwrite_by_date")
def q_overwrite_by_date(spark, sf_dir):
    """A table written whole, then overwritten by half of one year's
    matches. Dynamic mode keeps the years that have vanished, static drops them."""
    database = catalog(spark, sf_dir)
    rows = _by_year(spark, sf_dir)
    again = rows.where((F.col("dt") == OVERWRITTEN_YEAR) & (F.col("game_id") % 2 == 0))
    out = None
    for mode in ("dynamic", "static"):
        table = _own_table(spark, database, "match_id STRING, game_id BIGINT, dt STRING", "dt")
        tables.overwrite_partitions(spark, rows, table)
        tables.overwrite_partitions(spark, again, table, full_refresh=mode == "static")
        kept = spark.table(table).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("game_id").alias("ids"))
        kept = kept.select(F.lit(mode).alias("mode"), "dt", "n", "ids")
        out = kept if out is None else out.unionByName(kept)
    return out


@query("swapped_partitions")
def q_swapped_partitions(spark, sf_dir):
    """K1, K2 for tables with readers: the same two overwrites as versions that the
    catalog is switched to. ``before`` was planned in between, is run after the
    last one, and still sees the whole first version."""
    database = catalog(spark, sf_dir)
    rows = _by_year(spark, sf_dir)
    again = rows.where((F.col("dt") == OVERWRITTEN_YEAR) & (F.col("game_id") % 2 == 0))
    out = None
    for mode in ("dynamic", "static"):
        table = _own_table(spark, database, "match_id STRING, game_id BIGINT, dt STRING", "dt")
        versions.swap_partitions(spark, rows, table)
        before = versions.swap_summary(spark, table, "game_id")
        before._jdf.queryExecution().executedPlan()
        versions.swap_partitions(spark, again, table, full_refresh=mode == "static")
        # Run as it was planned (within another query it would be planned anew);
        # one row a partition.
        before = spark.createDataFrame(before.collect(), before.schema)
        after = versions.swap_summary(spark, table, "game_id")
        for name, seen in (("before", before), ("after", after)):
            seen = seen.select(F.lit(mode).alias("mode"), F.lit(name).alias("planned"), "dt", "n", "ids")
            out = seen if out is None else out.unionByName(seen)
    return out


@query("overwrite_then_append")
def q_overwrite_then_append(spark, sf_dir):
    """K3, K4: an unpartitioned table is overwritten whole, then appended to by
    position."""
    table = _own_table(spark, catalog(spark, sf_dir), "match_id STRING, game_id BIGINT, dt STRING")
    rows = _by_year(spark, sf_dir)
    tables.overwrite_table(spark, rows, table)
    tables.overwrite_table(spark, rows.where(F.col("dt") == OVERWRITTEN_YEAR), table)
    tables.append(spark, rows.where(F.col("game_id") % 3 == 0), table)
    return spark.table(table).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("game_id").alias("ids"))


@query("registered_partitions")
def q_registered_partitions(spark, sf_dir):
    """K5, K6: partitions written beside the catalog; the batch's own are
    registered, and the table shows those."""
    database = catalog(spark, sf_dir)
    root = scratch_dir(spark)
    rows = stored_layer(spark, sf_dir, "dwd_match").select("match_id", F.col("source_ingest_date").alias("ingest_date"))
    rows.write.partitionBy("ingest_date").parquet(root)
    table = f"{database}.t_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} (match_id STRING, ingest_date STRING) USING parquet "
        f"PARTITIONED BY (ingest_date) LOCATION '{root}'"
    )
    tables.add_partitions(spark, table, "ingest_date", [BATCH_DATE])
    return spark.table(table).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))


@query("dq_history")
def q_dq_history(spark, sf_dir):
    """Two runs of the rules appended to the history table; the
    gate stops each after its rows are written."""
    database = catalog(spark, sf_dir)
    table = _own_table(spark, database, LAYER_DDL["dq_check_result"][0])
    stopped = 0
    for day in (LANDED_DATE, BATCH_DATE):
        try:
            quality.run_checks(spark, quality_inputs(spark, sf_dir), day, table, run_id=f"run of {day}")
        except quality.QualityGateError:
            stopped += 1
    return spark.table(table).select(
        "run_id", "rule_id", "status", "actual_value", "batch_date",
        F.col("check_time").isNotNull().alias("timed"), F.lit(stopped).alias("runs_stopped"),
    )


# --- projections / expressions ---------------------------------------------


@query("player_match_preview")
def q_player_match_preview(spark, sf_dir):
    """K10, P14, P19, O5, PF3: the 11-column preview, first rows in a total order."""
    cols = [
        "match_id",
        "participant_id",
        "champion_name",
        "team_position",
        "kills",
        "deaths",
        "assists",
        "gold_earned",
        "win",
        "is_bot_player",
        "dt",
    ]
    p = _player_match(spark, sf_dir, cols)
    return p.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(PREVIEW_ROWS)


@query("json_path_extract")
def q_json_path_extract(spark, sf_dir):
    """dwd_match from raw JSON text by JSON path (the HiveQL build)."""
    return build_match_from_text(raw_text(spark, sf_dir))


@query("epoch_to_dt")
def q_epoch_to_dt(spark, sf_dir):
    """Epoch ms -> seconds, timestamp text and date text (UTC)."""
    m = frames(spark, sf_dir).matches
    s = epoch_ms_to_s("gameStartTimestamp")
    return m.select(
        "match_id",
        s.alias("start_s"),
        timestamp_string_from_epoch_s(s).alias("game_start_time"),
        timestamp_string_from_epoch_s(epoch_ms_to_s("gameEndTimestamp")).alias("game_end_time"),
        date_string_from_epoch_s(s).alias("dt"),
    )


@query("patch_version")
def q_patch_version(spark, sf_dir):
    m = frames(spark, sf_dir).matches
    return m.select(
        "match_id",
        F.col("gameVersion").alias("game_version"),
        patch_version("gameVersion").alias("patch_version"),
    )


@query("patch_by_split")
def q_patch_by_split(spark, sf_dir):
    m = frames(spark, sf_dir).matches
    return m.select(
        "match_id",
        F.col("gameVersion").alias("game_version"),
        patch_by_split("gameVersion").alias("patch"),
    )


@query("is_bot_match")
def q_is_bot_match(spark, sf_dir):
    """Any participant is a bot (structural, on nested documents)."""
    m = frames(spark, sf_dir).matches
    return m.select("match_id", flag(F.col("has_bot")).alias("is_bot_match"))


@query("is_early_surrender")
def q_is_early_surrender(spark, sf_dir):
    m = frames(spark, sf_dir).matches
    return m.select("match_id", flag(F.col("has_early_surrender")).alias("is_early_surrender"))


@query("player_flags")
def q_player_flags(spark, sf_dir):
    return _player_match(spark, sf_dir, ["match_id", "participant_id", "is_bot_player", "is_early_surrender"])


@query("participant_count")
def q_participant_count(spark, sf_dir):
    """``size(info.participants)`` (NULL for a missing array)."""
    docs = documents(spark, sf_dir, document_fields([], ["participantId"]))
    return docs.select(
        F.col("metadata.matchId").alias("match_id"),
        F.size("info.participants").alias("participant_count"),
    )


@query("explode_participants")
def q_explode_participants(spark, sf_dir):
    """One row per array element; empty/missing arrays produce none."""
    docs = documents(spark, sf_dir, document_fields([], ["participantId", "puuid", "championId"]))
    e = docs.select(
        F.col("metadata.matchId").alias("match_id"),
        F.explode("info.participants").alias("player"),
    )
    return e.select(
        "match_id",
        _player("participantId", "player").alias("participant_id"),
        _player("puuid", "player").alias("puuid"),
        _player("championId", "player").alias("champion_id"),
    )


@query("kda_ratio")
def q_kda_ratio(spark, sf_dir):
    a = build_champion_day_metrics(stored_layer(spark, sf_dir, "dws_champion_day"))
    return a.select("dt", "patch_version", "queue_id", "champion_id", "kda_ratio")


@query("human_players")
def q_human_players(spark, sf_dir):
    """Non-empty, non-bot participant ids of each document."""
    docs = documents(spark, sf_dir, document_fields([], ["puuid"]))
    return docs.select(
        F.col("metadata.matchId").alias("match_id"),
        F.explode(human_ids("info.participants")).alias("puuid"),
    )


@query("document_keys")
def q_document_keys(spark, sf_dir):
    """Distinct object keys per level (document, info, participant)."""
    # Three branches over the raw text (a single pass with transform/flatten lambdas
    # measured slower). Lists of keys are made distinct before they are exploded.
    raw = raw_text(spark, sf_dir)
    top = raw.select(F.lit("document").alias("scope"), F.json_object_keys("raw_json").alias("keys"))
    info = raw.select(
        F.lit("info").alias("scope"),
        F.json_object_keys(F.get_json_object("raw_json", "$.info")).alias("keys"),
    )
    parts = raw.select(
        F.explode(
            F.from_json(F.get_json_object("raw_json", "$.info.participants"), "array<string>")
        ).alias("p")
    ).select(F.lit("participant").alias("scope"), F.json_object_keys("p").alias("keys"))
    lists = top.unionByName(info).unionByName(parts).distinct()
    # (A plain explode infers a filter of its lists, which would parse every text thrice.)
    keys = lists.select("scope", F.explode_outer("keys").alias("key")).where(F.col("key").isNotNull())
    return keys.distinct().orderBy("scope", "key")


@query("match_basic_info")
def q_match_basic_info(spark, sf_dir):
    return profile.match_basic_info(frames(spark, sf_dir).matches)


@query("participant_identity")
def q_participant_identity(spark, sf_dir):
    """Champion, K/D/A, win and identity of every participant."""
    players = ["participantId", "puuid", "riotIdGameName", "riotIdTagline", "teamId"]
    players += ["championId", "championName", "kills", "deaths", "assists", "win"]
    docs = documents(spark, sf_dir, document_fields([], players))
    e = docs.select(
        F.col("metadata.matchId").alias("match_id"),
        F.explode("info.participants").alias("p"),
    )
    return e.select(
        "match_id",
        _player("participantId").alias("participant_id"),
        _player("puuid").alias("puuid"),
        _player("riotIdGameName").alias("riot_id_game_name"),
        _player("riotIdTagline").alias("riot_id_tagline"),
        _player("teamId").alias("team_id"),
        _player("championId").alias("champion_id"),
        _player("championName").alias("champion_name"),
        _player("kills").alias("kills"),
        _player("deaths").alias("deaths"),
        _player("assists").alias("assists"),
        _player("win").alias("win"),
    )


@query("team_rows")
def q_team_rows(spark, sf_dir):
    teams = T.StructType([*METADATA_ONLY, T.StructField("info", T.StructType([INFO_SCHEMA["teams"]]))])
    docs = documents(spark, sf_dir, teams)
    e = docs.select(F.col("metadata.matchId").alias("match_id"), F.explode("info.teams").alias("t"))
    return e.select("match_id", *[
        typed(f"t.{f.name}", f.dataType).alias(n) for f, n in zip(TEAM_SCHEMA.fields, ("team_id", "win"))
    ])


# --- warehouse layers -------------------------------------------------------


@query("dwd_match")
def q_dwd_match(spark, sf_dir):
    return layers(spark, sf_dir).dwd_match


@query("dwd_match_mixed_types")
def q_dwd_match_mixed_types(spark, sf_dir):
    """D1 on documents whose numbers arrive as text or as decimals: equal to D1."""
    raw = raw_text(spark, sf_dir)
    number = r'"(gameId|gameStartTimestamp|gameEndTimestamp|gameDuration|queueId|mapId)":([0-9]+)'
    third = F.pmod(F.xxhash64("raw_json"), F.lit(3))
    mixed = (
        F.when(third == 0, F.regexp_replace("raw_json", number, '"$1":"$2"'))
        .when(third == 1, F.regexp_replace("raw_json", number, '"$1":$2.0'))
        .otherwise(F.col("raw_json"))
    )
    fields = document_fields([n for n, _ in INFO_FIELDS], MATCH_PLAYERS)
    docs = raw.select(F.from_json(mixed, lenient(fields)).alias("d"), "ingest_date")
    return build_match(frames_from_documents(docs.select("d.*", "ingest_date")))


@query("dwd_player_match")
def q_dwd_player_match(spark, sf_dir):
    return layers(spark, sf_dir).dwd_player_match


@query("dim_champion")
def q_dim_champion(spark, sf_dir):
    return build_dim_champion(stored_layer(spark, sf_dir, "dwd_player_match"))


@query("dim_queue")
def q_dim_queue(spark, sf_dir):
    return build_dim_queue(stored_layer(spark, sf_dir, "dwd_match"))


@query("dim_patch")
def q_dim_patch(spark, sf_dir):
    return build_dim_patch(stored_layer(spark, sf_dir, "dwd_match"))


@query("dws_champion_day")
def q_dws(spark, sf_dir):
    return build_champion_day(
        stored_layer(spark, sf_dir, "dwd_player_match"), stored_layer(spark, sf_dir, "dwd_match")
    )


@query("ads_champion_day_metrics")
def q_ads(spark, sf_dir):
    return build_champion_day_metrics(stored_layer(spark, sf_dir, "dws_champion_day"))


@query("ads_slice")
def q_ads_slice(spark, sf_dir):
    """dashboard slice (queue and date range)."""
    return slice_metrics(stored_layer(spark, sf_dir, "ads_champion_day_metrics"), **SLICE)


# --- quality ----------------------------------------------------------------


def _rule(rule_id: str) -> QueryFn:
    def run(spark, sf_dir):
        return quality.rule_results(quality_inputs(spark, sf_dir, [rule_id]), [rule_id])

    return run


for _rid in quality.RULE_NAMES:
    query(_rid.lower())(_rule(_rid))


@query("dq_report")
def q_dq_report(spark, sf_dir):
    return quality.report(quality_inputs(spark, sf_dir))


@query("dq_summary")
def q_dq_summary(spark, sf_dir):
    return quality.summary(quality.report(quality_inputs(spark, sf_dir)))


@query("fanout_reconciliation")
def q_fanout(spark, sf_dir):
    """Rows after explode = sum of array sizes."""
    docs = documents(spark, sf_dir, document_fields([], ["puuid"]))
    none = F.lit(None).cast("int")
    sized = docs.select(F.lit(1).alias("doc"), F.size("info.participants").alias("n"), none.alias("rows"))
    exploded = docs.select(F.explode("info.participants.puuid")).select(
        none.alias("doc"), none.alias("n"), F.lit(1).alias("rows")
    )
    agg = sized.unionByName(exploded).agg(
        F.count("doc").alias("documents"),
        F.sum("n").cast("bigint").alias("expected_players"),
        F.sum("rows").cast("bigint").alias("exploded_players"),
    )
    return agg.withColumn(
        "status",
        F.when(F.col("expected_players") == F.col("exploded_players"), "PASS").otherwise("FAIL"),
    )


@query("expected_player_count")
def q_expected_player_count(spark, sf_dir):
    """Sum of participant array sizes (NULL sizes ignored)."""
    docs = documents(spark, sf_dir, document_fields([], ["participantId"]))
    return docs.agg(F.sum(F.size("info.participants")).cast("bigint").alias("expected_count"))


# --- filters ----------------------------------------------------------------


@query("valid_matches")
def q_valid_matches(spark, sf_dir):
    m = frames(spark, sf_dir).matches
    return m.where(valid_match("n_participants", "has_bot", "mapId")).select("match_id")


@query("valid_matches_any_map")
def q_valid_matches_any_map(spark, sf_dir):
    m = frames(spark, sf_dir).matches
    return m.where(valid_match("n_participants", "has_bot", "mapId", required_map=None)).select(
        "match_id"
    )


# --- profile ----------------------------------------------------------------


def _profile_input(spark, sf_dir):
    """One row per landed document."""
    return frames(spark, sf_dir).matches


@query("profile_basic")
def q_profile_basic(spark, sf_dir):
    return profile.profile_basic(_profile_input(spark, sf_dir))


@query("freq_mode")
def q_freq_mode(spark, sf_dir):
    return profile.freq_mode(_profile_input(spark, sf_dir))


@query("freq_queue")
def q_freq_queue(spark, sf_dir):
    return profile.freq_queue(_profile_input(spark, sf_dir))


@query("freq_map")
def q_freq_map(spark, sf_dir):
    return profile.freq_map(_profile_input(spark, sf_dir))


@query("freq_patch")
def q_freq_patch(spark, sf_dir):
    return profile.freq_patch(_profile_input(spark, sf_dir))


@query("freq_participants")
def q_freq_participants(spark, sf_dir):
    return profile.freq_participants(_profile_input(spark, sf_dir))


@query("profile_duration")
def q_profile_duration(spark, sf_dir):
    return profile.profile_duration(_profile_input(spark, sf_dir))


@query("profile_date_range")
def q_profile_date_range(spark, sf_dir):
    return profile.profile_date_range(_profile_input(spark, sf_dir))


@query("missing_fields")
def q_missing_fields(spark, sf_dir):
    return profile.missing_fields(_profile_input(spark, sf_dir))


@query("short_matches")
def q_short_matches(spark, sf_dir):
    return profile.short_matches(
        _profile_input(spark, sf_dir), SHORT_SECONDS, lambda rows: materialize(rows, "short-matches")
    )


@query("profile_dataset")
def q_profile_dataset(spark, sf_dir):
    """PF1: all counters and tables in one pass over the JSON text."""
    return profile.profile_dataset(raw_text(spark, sf_dir))


@query("profile_dataset_dirty")
def q_profile_dataset_dirty(spark, sf_dir):
    """PF1, A13, A17, P31: the same over texts with torn, nameless and repeated
    documents, and with durations that are text or have decimals."""
    return profile.profile_dataset(read_raw_text(spark, dirty(spark, sf_dir)))


@query("corrupt_records")
def q_corrupt_records(spark, sf_dir):
    """Torn documents keep their text, so that their id can be recovered."""
    docs = read_documents(spark, dirty(spark, sf_dir), "jsonl", fields=document_fields([], ["puuid"]))
    return corrupt_documents(docs).select(
        F.regexp_extract(CORRUPT_COLUMN, r'"matchId":"([^"]*)"', 1).alias("rescued_id"),
        "ingest_date",
        ingest_date_from_path("source_file").alias("source_ingest_date"),
    )


# --- landing ----------------------------------------------------------------


def _landing_state(spark, sf_dir):
    """Landed ids (the earlier batch) and the candidates of this batch: every
    match reachable from a human player."""
    fr = graph_frames(spark, sf_dir)
    landed = fr.matches.where(F.col("ingest_date") == LANDED_DATE).select("match_id")
    reachable = player_match_edges(fr.participants).select("match_id")
    candidates = landing.with_validity(
        fr.matches.join(reachable.distinct(), "match_id", "left_semi")
    )
    return fr, landed, candidates


@query("new_matches")
def q_new_matches(spark, sf_dir):
    """Candidate ids not landed yet, one row per id."""
    _, landed, candidates = _landing_state(spark, sf_dir)
    return landing.select_new(candidates, landed).select("match_id")


@query("new_valid_batch")
def q_new_valid_batch(spark, sf_dir):
    """The first ``BATCH_TARGET`` new valid matches."""
    _, landed, candidates = _landing_state(spark, sf_dir)
    new = landing.select_new(candidates, landed)
    return landing.first_valid(new, BATCH_TARGET).select("match_id")


@query("new_valid_batch_cut")
def q_new_valid_batch_cut(spark, sf_dir):
    """A target that is reached, so that the limit cuts."""
    _, landed, candidates = _landing_state(spark, sf_dir)
    return landing.first_valid(landing.select_new(candidates, landed), CUT_TARGET).select("match_id")


@query("new_matches_by_index")
def q_new_matches_by_index(spark, sf_dir):
    """The same as ``new_matches``, by the stored index of landed ids:
    written from the earlier batch, then asked for this one's candidates."""
    _, landed, candidates = _landing_state(spark, sf_dir)
    index = IdIndex(scratch_dir(spark, f"index-{uuid.uuid4().hex}"))
    index.add(landed, LANDED_DATE)
    found = index.landed(candidates)
    delete_path(spark, index.root)
    return landing.select_new(candidates, found).select("match_id")


def _manifest(spark, sf_dir, target=BATCH_TARGET):
    fr, landed, candidates = _landing_state(spark, sf_dir)
    # Read for the batch's last id, then as its rows: ids alone are kept, so that
    # the documents are parsed once for both.
    new = materialize(landing.select_new(candidates, landed).select("match_id", "is_valid"), "new-ids")
    return fr, landing.batch_manifest(new, BATCH_DATE, target)


@query("batch_manifest")
def q_batch_manifest(spark, sf_dir):
    """One row per (batch, id) with status and target."""
    return _manifest(spark, sf_dir)[1]


@query("manifest_members")
def q_manifest_members(spark, sf_dir):
    """Documents belonging to the batch."""
    fr, manifest = _manifest(spark, sf_dir)
    return landing.manifest_members(fr.matches, manifest).select("match_id", "ingest_date")


@query("manifest_missing")
def q_manifest_missing(spark, sf_dir):
    """Manifest ids with no landed document in the batch partition."""
    fr, manifest = _manifest(spark, sf_dir)
    in_batch = fr.matches.where(F.col("ingest_date") == BATCH_DATE).select("match_id")
    return landing.manifest_missing(manifest, in_batch)


@query("compact_jsonl")
def q_compact_jsonl(spark, sf_dir):
    """Compact the batch's documents from the pretty raw zone to JSONL,
    write, read back and reconcile the line count with the manifest."""
    fr, manifest = _manifest(spark, sf_dir)
    raw = compactable_text(spark, raw_zone(spark, sf_dir)).where(F.col("ingest_date") == BATCH_DATE)
    compacted = landing.compact_batch(raw, manifest, BATCH_DATE)
    out = shared_path(spark, f"compact-{_snapshot_tag(spark, sf_dir)}-{BATCH_DATE}")
    land_jsonl(compacted, out)
    written = read_raw_text(spark, out).where(F.col("ingest_date") == BATCH_DATE)
    return landing.compaction_reconciliation(written, manifest.select("match_id"), BATCH_DATE)


@query("missing_from_torn")
def q_missing_from_torn(spark, sf_dir):
    """Manifest ids without a landed document where some arrive torn or
    nameless."""
    _, manifest = _manifest(spark, sf_dir)
    fields = document_fields([], ["puuid"])
    torn = read_documents(spark, dirty(spark, sf_dir), "jsonl", ingest_dates=[BATCH_DATE], fields=fields)
    return landing.manifest_missing(manifest, landing.landed_ids(torn))


@query("compact_torn_jsonl")
def q_compact_torn_jsonl(spark, sf_dir):
    """The reconciliation of a compaction that lost and doubled documents."""
    _, manifest = _manifest(spark, sf_dir)
    raw = read_raw_text(spark, dirty(spark, sf_dir)).where(F.col("ingest_date") == BATCH_DATE)
    raw = raw.where(F.try_parse_json("raw_json").isNotNull())
    out = scratch_dir(spark, f"compact-{uuid.uuid4().hex}")
    land_jsonl(landing.compact_batch(raw, manifest, BATCH_DATE), out)
    written = read_raw_text(spark, out).where(F.col("ingest_date") == BATCH_DATE)
    return landing.compaction_reconciliation(written, manifest.select("match_id"), BATCH_DATE)


# --- graph ------------------------------------------------------------------


def _graph(spark, sf_dir):
    fr = graph_frames(spark, sf_dir)
    edges = materialize(player_match_edges(fr.participants), "graph-edges")
    valid = fr.matches.where(valid_match("n_participants", "has_bot", "mapId")).select("match_id")
    return fr, edges, valid


@query("player_match_edges")
def q_player_match_edges(spark, sf_dir):
    docs = documents(spark, sf_dir, _GRAPH)
    return player_match_edges(frames_from_documents(docs).participants)


@query("frontier_1hop")
def q_frontier_1hop(spark, sf_dir):
    _, edges, valid = _graph(spark, sf_dir)
    return expand_frontier(edges, valid, seed_players(edges, valid), hops=1)


@query("frontier_2hop")
def q_frontier_2hop(spark, sf_dir):
    _, edges, valid = _graph(spark, sf_dir)
    return expand_frontier(edges, valid, seed_players(edges, valid), hops=2)


@query("recent_matches_per_player")
def q_recent_matches(spark, sf_dir):
    """Each human player's most recent matches (start time desc, id)."""
    p = _player_match(spark, sf_dir, ["puuid", "match_id", "game_start_time"])
    return _recent(p, RECENT_PER_PLAYER)


def _recent(p, n):
    human = p.where(F.col("puuid").isNotNull() & (F.col("puuid") != "") & (F.col("puuid") != "BOT"))
    pm = human.select("puuid", "match_id", "game_start_time").distinct()
    return recent_matches(pm, n, "game_start_time")


def _collect(spark, sf_dir, target):
    """The collector's loop from the players of the first valid landed match."""
    fr, edges, valid = _graph(spark, sf_dir)
    landed = fr.matches.where(F.col("ingest_date") == LANDED_DATE).select("match_id")
    seeds = seed_players(edges, valid.join(landed, "match_id", "left_semi"))
    played = build_player_match(fr, ["puuid", "match_id", "game_start_time"])
    return collect_to_target(_recent(played, COLLECT_RECENT), edges, valid, landed, seeds, target)


@query("frontier_to_target")
def q_frontier_to_target(spark, sf_dir):
    """Hops until ``COLLECT_TARGET`` new valid matches; the target cuts
    into the last hop."""
    return _collect(spark, sf_dir, COLLECT_TARGET)


@query("frontier_to_exhaustion")
def q_frontier_to_exhaustion(spark, sf_dir):
    """A target that is never reached: hops until no player is left."""
    return _collect(spark, sf_dir, 1 << 30)
