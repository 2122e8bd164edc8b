"""Schemas: the raw match document and the warehouse layers.

The document schema is fixed (not inferred) so the column set does not depend
on which documents happen to be in a batch, and so a corrupt file shows up in
``_corrupt_record`` instead of changing the schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw document
# ---------------------------------------------------------------------------

# Participant fields: (document field, Spark type). These are the
# field names of the upstream match document and must stay spelled as here.
PARTICIPANT_FIELDS: list[tuple[str, T.DataType]] = [
    ("participantId", T.IntegerType()),
    ("puuid", T.StringType()),
    ("riotIdGameName", T.StringType()),
    ("riotIdTagline", T.StringType()),
    ("teamId", T.IntegerType()),
    ("championId", T.IntegerType()),
    ("championName", T.StringType()),
    ("champLevel", T.IntegerType()),
    ("teamPosition", T.StringType()),
    ("individualPosition", T.StringType()),
    ("kills", T.IntegerType()),
    ("deaths", T.IntegerType()),
    ("assists", T.IntegerType()),
    ("goldEarned", T.LongType()),
    ("totalDamageDealtToChampions", T.LongType()),
    ("totalDamageTaken", T.LongType()),
    ("totalMinionsKilled", T.IntegerType()),
    ("neutralMinionsKilled", T.IntegerType()),
    ("visionScore", T.IntegerType()),
    ("wardsPlaced", T.IntegerType()),
    ("wardsKilled", T.IntegerType()),
    ("item0", T.IntegerType()),
    ("item1", T.IntegerType()),
    ("item2", T.IntegerType()),
    ("item3", T.IntegerType()),
    ("item4", T.IntegerType()),
    ("item5", T.IntegerType()),
    ("item6", T.IntegerType()),
    ("win", T.BooleanType()),
    ("gameEndedInEarlySurrender", T.BooleanType()),
    ("gameEndedInSurrender", T.BooleanType()),
]

PARTICIPANT_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in PARTICIPANT_FIELDS]
)

TEAM_SCHEMA = T.StructType(
    [
        T.StructField("teamId", T.IntegerType(), True),
        T.StructField("win", T.BooleanType(), True),
    ]
)

# Match-level fields under ``info`` (besides the two arrays). Fixed values, as above.
INFO_FIELDS: list[tuple[str, T.DataType]] = [
    ("gameId", T.LongType()),
    ("platformId", T.StringType()),
    ("gameCreation", T.LongType()),
    ("gameStartTimestamp", T.LongType()),
    ("gameEndTimestamp", T.LongType()),
    ("gameDuration", T.IntegerType()),
    ("gameMode", T.StringType()),
    ("gameType", T.StringType()),
    ("gameVersion", T.StringType()),
    ("mapId", T.IntegerType()),
    ("queueId", T.IntegerType()),
]

# Fields the profiler requires on every document (fixed list, in this order).
REQUIRED_MATCH_FIELDS = [
    "gameStartTimestamp",
    "gameEndTimestamp",
    "gameDuration",
    "gameMode",
    "gameType",
    "gameVersion",
    "mapId",
    "platformId",
    "queueId",
]

INFO_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in INFO_FIELDS]
    + [
        T.StructField("participants", T.ArrayType(PARTICIPANT_SCHEMA, True), True),
        T.StructField("teams", T.ArrayType(TEAM_SCHEMA, True), True),
    ]
)

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("matchId", T.StringType(), True),
        T.StructField("participants", T.ArrayType(T.StringType(), True), True),
    ]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("metadata", METADATA_SCHEMA, True),
        T.StructField("info", INFO_SCHEMA, True),
    ]
)



def document_fields(info: list[str], players: list[str]) -> T.StructType:
    """The part of ``DOCUMENT_SCHEMA`` with the id, ``info``'s match fields and
    ``players``' fields of the participants."""
    participants = T.ArrayType(T.StructType([PARTICIPANT_SCHEMA[n] for n in players]))
    fields = [*[INFO_SCHEMA[n] for n in info], T.StructField("participants", participants)]
    return T.StructType(
        [
            T.StructField("metadata", T.StructType([METADATA_SCHEMA["matchId"]])),
            T.StructField("info", T.StructType(fields)),
        ]
    )


CORRUPT_COLUMN = "_corrupt_record"


def lenient(kind: T.DataType) -> T.DataType:
    """The same type with STRING leaves. Documents are read so: a number or a
    boolean that arrives as text, or a whole number as a decimal, keeps its
    value and is cast where it is used, instead of becoming NULL at the scan."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, lenient(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(lenient(kind.elementType), True)
    return T.StringType()


# Read schema: the document with STRING leaves plus the corrupt-record column.
MATCH_SCHEMA = T.StructType(
    lenient(DOCUMENT_SCHEMA).fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# ---------------------------------------------------------------------------
# Flat working form (see matchmart.sources.frames)
# ---------------------------------------------------------------------------

# One row per document. ``n_participants`` is NULL when the document carries
# no participants array (size(NULL) is NULL under ANSI).
MATCH_FRAME_COLUMNS = [
    "match_id",
    "ingest_date",
    *[n for n, _ in INFO_FIELDS],
    "n_participants",
    "has_bot",
    "has_early_surrender",
    "has_surrender",
    "is_corrupt",
]

# Header fields copied onto each participant row.
PARTICIPANT_HEADER_COLUMNS = [
    "match_id",
    "ingest_date",
    "gameId",
    "platformId",
    "gameStartTimestamp",
    "gameMode",
    "queueId",
    "gameVersion",
]

# ---------------------------------------------------------------------------
# Warehouse layers
# ---------------------------------------------------------------------------

# Player row: (output column, participant field, type). Fixed mapping.
PLAYER_COLUMNS: list[tuple[str, str, T.DataType]] = [
    ("participant_id", "participantId", T.IntegerType()),
    ("puuid", "puuid", T.StringType()),
    ("team_id", "teamId", T.IntegerType()),
    ("champion_id", "championId", T.IntegerType()),
    ("champion_name", "championName", T.StringType()),
    ("team_position", "teamPosition", T.StringType()),
    ("individual_position", "individualPosition", T.StringType()),
    ("champ_level", "champLevel", T.IntegerType()),
    ("kills", "kills", T.IntegerType()),
    ("deaths", "deaths", T.IntegerType()),
    ("assists", "assists", T.IntegerType()),
    ("gold_earned", "goldEarned", T.LongType()),
    ("total_damage_dealt_to_champions", "totalDamageDealtToChampions", T.LongType()),
    ("total_damage_taken", "totalDamageTaken", T.LongType()),
    ("total_minions_killed", "totalMinionsKilled", T.IntegerType()),
    ("neutral_minions_killed", "neutralMinionsKilled", T.IntegerType()),
    ("vision_score", "visionScore", T.IntegerType()),
    ("wards_placed", "wardsPlaced", T.IntegerType()),
    ("wards_killed", "wardsKilled", T.IntegerType()),
    ("item_0", "item0", T.IntegerType()),
    ("item_1", "item1", T.IntegerType()),
    ("item_2", "item2", T.IntegerType()),
    ("item_3", "item3", T.IntegerType()),
    ("item_4", "item4", T.IntegerType()),
    ("item_5", "item5", T.IntegerType()),
    ("item_6", "item6", T.IntegerType()),
    ("win", "win", T.BooleanType()),
]

DQ_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("rule_id", T.StringType(), False),
        T.StructField("rule_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("actual_value", T.StringType(), True),
        T.StructField("expected_value", T.StringType(), True),
        T.StructField("check_time", T.TimestampType(), False),
        T.StructField("batch_date", T.StringType(), False),
    ]
)

# Table DDL (Spark SQL, ORC, partitioned by dt where the reference does so).
_SQL_TYPES = {"IntegerType()": "INT", "LongType()": "BIGINT", "StringType()": "STRING", "BooleanType()": "BOOLEAN"}

DWD_PLAYER_MATCH_DDL = ", ".join(
    [
        "match_id STRING",
        "game_id BIGINT",
        "platform_id STRING",
        "game_start_time TIMESTAMP",
        "game_mode STRING",
        "queue_id INT",
        "patch_version STRING",
    ]
    + [f"{out} {_SQL_TYPES[repr(t)]}" for out, _, t in PLAYER_COLUMNS]
    + ["is_bot_player INT", "is_early_surrender INT", "source_ingest_date STRING", "dt STRING"]
)

# Table columns, in table order.
LAYER_DDL = {
    "dwd_player_match": (DWD_PLAYER_MATCH_DDL, "dt"),
    "dwd_match": (
        "match_id STRING, game_id BIGINT, platform_id STRING, game_start_time STRING, "
        "game_end_time STRING, game_duration INT, game_mode STRING, game_type STRING, "
        "queue_id INT, map_id INT, game_version STRING, patch_version STRING, "
        "is_bot_match INT, is_early_surrender INT, source_ingest_date STRING, dt STRING",
        "dt",
    ),
    "dim_champion": (
        "champion_id INT, champion_name STRING, first_seen_dt STRING, last_seen_dt STRING",
        None,
    ),
    "dim_queue": (
        "queue_id INT, game_mode STRING, first_seen_dt STRING, last_seen_dt STRING",
        None,
    ),
    "dim_patch": ("patch_version STRING, first_seen_dt STRING, last_seen_dt STRING", None),
    "dws_champion_day": (
        "patch_version STRING, queue_id INT, champion_id INT, champion_name STRING, "
        "match_count BIGINT, win_count BIGINT, loss_count BIGINT, total_kills BIGINT, "
        "total_deaths BIGINT, total_assists BIGINT, total_gold BIGINT, total_damage BIGINT, "
        "dt STRING",
        "dt",
    ),
    "ads_champion_day_metrics": (
        "patch_version STRING, queue_id INT, champion_id INT, champion_name STRING, "
        "match_count BIGINT, win_count BIGINT, win_rate DOUBLE, avg_kills DOUBLE, "
        "avg_deaths DOUBLE, avg_assists DOUBLE, kda_ratio DOUBLE, avg_gold DOUBLE, "
        "avg_damage DOUBLE, dt STRING",
        "dt",
    ),
    "dq_check_result": (
        "run_id STRING, rule_id STRING, rule_name STRING, status STRING, "
        "actual_value STRING, expected_value STRING, check_time TIMESTAMP, batch_date STRING",
        None,
    ),
}
