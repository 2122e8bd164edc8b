"""Independent DuckDB SQL for every registered query.

Written from the flat driver tables with the fixture mapping (FIXTURES.md §2),
not from our JSON or our Spark code, so a mistake in either shows up as a
mismatch. Integer sums are cast to BIGINT (DuckDB sums to HUGEINT) and every
time conversion is in UTC (naive TIMESTAMP arithmetic).
"""

from __future__ import annotations

# Common table expressions: o (order header), la (line rollup per order),
# m (dwd_match), p (dwd_player_match), dws, ads.
_PRELUDE = r"""
o AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
         epoch_ms(o_orderdate) + (o_orderkey % 86400) * 1000 AS start_ms,
         CAST(120 + o_orderkey % 2400 AS INTEGER) AS duration,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderkey % 89 = 0 THEN 'dev'
              ELSE CAST(year(o_orderdate) - 1980 AS VARCHAR) || '.' ||
                   CAST(month(o_orderdate) AS VARCHAR) || '.' ||
                   CAST(o_orderkey % 900 AS VARCHAR) END AS version,
         CASE WHEN o_orderkey % 2 = 0 THEN '2026-08-16' ELSE '2026-08-17' END AS ingest_date,
         CASE WHEN o_orderpriority < '3' THEN 420 ELSE 450 END AS queue_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN 11 ELSE 12 END AS map_id
  FROM orders
),
la AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n,
         bool_or(l_suppkey % 50 = 0) AS any_bot,
         bool_or(l_linenumber = 1) AS any_first,
         bool_or(l_linestatus = 'F') AS any_f
  FROM lineitem GROUP BY l_orderkey
),
mx AS (
  SELECT o.*, la.n AS n_participants,
         coalesce(la.any_bot, false) AS has_bot,
         coalesce(o.o_orderstatus = 'P' AND la.any_first, false) AS has_early,
         coalesce(o.o_orderstatus = 'F' AND la.any_f, false) AS has_surrender,
         'M' || CAST(k AS VARCHAR) AS match_id,
         regexp_extract(version, '^([0-9]+\.[0-9]+)', 1) AS patch_version,
         strftime(make_timestamp((start_ms // 1000) * 1000000), '%Y-%m-%d') AS dt
  FROM o LEFT JOIN la ON o.k = la.l_orderkey
),
m AS (
  SELECT match_id,
         k AS game_id,
         'P' || CAST(o_custkey % 4 AS VARCHAR) AS platform_id,
         strftime(make_timestamp((start_ms // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS game_start_time,
         strftime(make_timestamp(((start_ms + duration * 1000) // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS game_end_time,
         duration AS game_duration,
         o_orderpriority AS game_mode,
         o_orderstatus AS game_type,
         queue_id,
         map_id,
         version AS game_version,
         patch_version,
         CASE WHEN has_bot THEN 1 ELSE 0 END AS is_bot_match,
         CASE WHEN has_early THEN 1 ELSE 0 END AS is_early_surrender,
         ingest_date AS source_ingest_date,
         dt
  FROM mx
),
p AS (
  SELECT mx.match_id,
         mx.k AS game_id,
         'P' || CAST(mx.o_custkey % 4 AS VARCHAR) AS platform_id,
         make_timestamp((mx.start_ms // 1000) * 1000000) AS game_start_time,
         mx.o_orderpriority AS game_mode,
         mx.queue_id,
         mx.patch_version,
         l.l_linenumber AS participant_id,
         CASE WHEN l.l_suppkey % 50 = 0 THEN 'BOT' ELSE 'S' || CAST(l.l_suppkey AS VARCHAR) END AS puuid,
         CASE WHEN l.l_linenumber % 2 = 1 THEN 100 ELSE 200 END AS team_id,
         CAST(pt.p_size % 6 AS INTEGER) AS champion_id,
         pt.p_brand AS champion_name,
         l.l_returnflag AS team_position,
         l.l_linestatus AS individual_position,
         CAST(l.l_linenumber + 1 AS INTEGER) AS champ_level,
         CAST(trunc(l.l_quantity) AS INTEGER) AS kills,
         CAST(round(l.l_discount * 100) AS INTEGER) AS deaths,
         CAST(round(l.l_tax * 100) AS INTEGER) AS assists,
         CAST(floor(l.l_extendedprice) AS BIGINT) AS gold_earned,
         CAST(floor(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT) AS total_damage_dealt_to_champions,
         CAST(pt.p_size * 100 AS BIGINT) AS total_damage_taken,
         CAST(l.l_partkey % 300 AS INTEGER) AS total_minions_killed,
         CAST(l.l_partkey % 60 AS INTEGER) AS neutral_minions_killed,
         CAST(l.l_suppkey % 80 AS INTEGER) AS vision_score,
         CAST(l.l_linenumber AS INTEGER) AS wards_placed,
         CAST(l.l_linenumber % 3 AS INTEGER) AS wards_killed,
         CAST(l.l_partkey % 7000 + 0 AS INTEGER) AS item_0,
         CAST(l.l_partkey % 7000 + 1 AS INTEGER) AS item_1,
         CAST(l.l_partkey % 7000 + 2 AS INTEGER) AS item_2,
         CAST(l.l_partkey % 7000 + 3 AS INTEGER) AS item_3,
         CAST(l.l_partkey % 7000 + 4 AS INTEGER) AS item_4,
         CAST(l.l_partkey % 7000 + 5 AS INTEGER) AS item_5,
         CAST(l.l_partkey % 7000 + 6 AS INTEGER) AS item_6,
         CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 7 THEN NULL
              ELSE l.l_returnflag = 'A' END AS win,
         CASE WHEN l.l_suppkey % 50 = 0 THEN 1 ELSE 0 END AS is_bot_player,
         CASE WHEN mx.o_orderstatus = 'P' AND l.l_linenumber = 1 THEN 1 ELSE 0 END AS is_early_surrender,
         mx.ingest_date AS source_ingest_date,
         mx.dt,
         -- extra document fields (not part of dwd_player_match)
         l.l_suppkey AS _supp,
         mx.o_orderstatus = 'F' AND l.l_linestatus = 'F' AS _surrender,
         mx.start_ms AS _start_ms
  FROM lineitem l
  JOIN mx ON l.l_orderkey = mx.k
  LEFT JOIN part pt ON l.l_partkey = pt.p_partkey
),
dws AS (
  SELECT p.patch_version, p.queue_id, p.champion_id,
         max(p.champion_name) AS champion_name,
         CAST(count(*) AS BIGINT) AS match_count,
         CAST(sum(CASE WHEN p.win = true THEN 1 ELSE 0 END) AS BIGINT) AS win_count,
         CAST(sum(CASE WHEN p.win = false THEN 1 ELSE 0 END) AS BIGINT) AS loss_count,
         CAST(sum(p.kills) AS BIGINT) AS total_kills,
         CAST(sum(p.deaths) AS BIGINT) AS total_deaths,
         CAST(sum(p.assists) AS BIGINT) AS total_assists,
         CAST(sum(p.gold_earned) AS BIGINT) AS total_gold,
         CAST(sum(p.total_damage_dealt_to_champions) AS BIGINT) AS total_damage,
         p.dt
  FROM p JOIN m ON p.match_id = m.match_id
  WHERE m.is_bot_match = 0 AND m.is_early_surrender = 0
  GROUP BY p.dt, p.patch_version, p.queue_id, p.champion_id
),
ads AS (
  SELECT patch_version, queue_id, champion_id, champion_name, match_count, win_count,
         CAST(win_count AS DOUBLE) / match_count AS win_rate,
         CAST(total_kills AS DOUBLE) / match_count AS avg_kills,
         CAST(total_deaths AS DOUBLE) / match_count AS avg_deaths,
         CAST(total_assists AS DOUBLE) / match_count AS avg_assists,
         CASE WHEN total_deaths = 0 THEN CAST(total_kills + total_assists AS DOUBLE)
              ELSE CAST(total_kills + total_assists AS DOUBLE) / total_deaths END AS kda_ratio,
         CAST(total_gold AS DOUBLE) / match_count AS avg_gold,
         CAST(total_damage AS DOUBLE) / match_count AS avg_damage,
         dt
  FROM dws WHERE match_count > 0
)
"""

_P_COLUMNS = """match_id, game_id, platform_id, game_start_time, game_mode, queue_id,
patch_version, participant_id, puuid, team_id, champion_id, champion_name, team_position,
individual_position, champ_level, kills, deaths, assists, gold_earned,
total_damage_dealt_to_champions, total_damage_taken, total_minions_killed,
neutral_minions_killed, vision_score, wards_placed, wards_killed, item_0, item_1, item_2,
item_3, item_4, item_5, item_6, win, is_bot_player, is_early_surrender,
source_ingest_date, dt"""


def _with(body: str) -> str:
    return "WITH " + _PRELUDE.strip() + "\n" + body.strip()


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = _with(body)


# --- warehouse layers -------------------------------------------------------

oracle("dwd_match", "SELECT * FROM m")
oracle("dwd_match_mixed_types", "SELECT * FROM m")
oracle("dwd_player_match", f"SELECT {_P_COLUMNS} FROM p")
oracle(
    "dim_champion",
    """SELECT champion_id, max(champion_name) AS champion_name,
              min(dt) AS first_seen_dt, max(dt) AS last_seen_dt
       FROM p WHERE champion_id IS NOT NULL GROUP BY champion_id""",
)
oracle(
    "dim_queue",
    """SELECT queue_id, max(game_mode) AS game_mode,
              min(dt) AS first_seen_dt, max(dt) AS last_seen_dt
       FROM m WHERE queue_id IS NOT NULL GROUP BY queue_id""",
)
oracle(
    "dim_patch",
    """SELECT patch_version, min(dt) AS first_seen_dt, max(dt) AS last_seen_dt
       FROM m WHERE patch_version IS NOT NULL AND patch_version <> ''
       GROUP BY patch_version""",
)
oracle("dws_champion_day", "SELECT * FROM dws")
oracle("ads_champion_day_metrics", "SELECT * FROM ads")

# --- scans / sources --------------------------------------------------------

_SCAN = """SELECT match_id, ingest_date, k AS game_id, version AS game_version,
       n_participants AS participant_count FROM mx"""
oracle("scan_documents", _SCAN)
oracle("scan_one_ingest_date", _SCAN + " WHERE ingest_date = '2026-08-16'")
oracle("source_ingest_date", "SELECT match_id, ingest_date AS source_ingest_date FROM mx")
oracle(
    "ods_raw",
    """SELECT match_id, ingest_date,
              CASE WHEN has_bot THEN 1 ELSE 0 END AS is_bot_match,
              CASE WHEN has_early THEN 1 ELSE 0 END AS is_early_surrender
       FROM mx""",
)
oracle(
    "layer_row_counts",
    """SELECT 'dwd_match' AS layer, count(*) AS cnt FROM m
       UNION ALL SELECT 'dwd_player_match', count(*) FROM p
       UNION ALL SELECT 'dws_champion_day', count(*) FROM dws
       UNION ALL SELECT 'ads_champion_day_metrics', count(*) FROM ads""",
)

_STAGES = ["dwd_match", "dwd_player_match", "dws_champion_day", "ads_champion_day_metrics"]
_ROWS = " UNION ALL ".join(
    f"SELECT '{n}' AS stage, count(*) AS rows FROM {t}" for n, t in zip(_STAGES, ("m", "p", "dws", "ads"))
)
oracle(
    "stage_log",
    f"SELECT stage, rows, 'OK' AS status FROM ({_ROWS}) UNION ALL SELECT 'total', sum(rows)::BIGINT, 'OK' FROM ({_ROWS})",
)
oracle(
    "overwrite_by_date",
    """SELECT 'dynamic' AS mode, substr(dt, 1, 4) AS dt, count(*) AS n, sum(game_id)::BIGINT AS ids FROM m
       WHERE substr(dt, 1, 4) <> '1996' OR game_id % 2 = 0 GROUP BY 2
       UNION ALL
       SELECT 'static', '1996', count(*), sum(game_id)::BIGINT FROM m WHERE substr(dt, 1, 4) = '1996' AND game_id % 2 = 0""",
)
_HALF_YEAR = "substr(dt, 1, 4) = '1996' AND game_id % 2 = 0"
oracle(
    "swapped_partitions",
    " UNION ALL ".join(
        f"""SELECT '{mode}' AS mode, '{planned}' AS planned, substr(dt, 1, 4) AS dt, count(*) AS n, sum(game_id)::BIGINT AS ids
            FROM m WHERE {cond} GROUP BY 3"""
        for mode, planned, cond in (
            ("dynamic", "before", "true"),
            ("dynamic", "after", f"substr(dt, 1, 4) <> '1996' OR ({_HALF_YEAR})"),
            ("static", "before", "true"),
            ("static", "after", _HALF_YEAR),
        )
    ),
)
oracle(
    "overwrite_then_append",
    """SELECT dt, count(*) AS n, sum(game_id)::BIGINT AS ids FROM (
         SELECT substr(dt, 1, 4) AS dt, game_id FROM m WHERE substr(dt, 1, 4) = '1996'
         UNION ALL SELECT substr(dt, 1, 4), game_id FROM m WHERE game_id % 3 = 0) GROUP BY dt""",
)
oracle(
    "registered_partitions",
    "SELECT source_ingest_date AS ingest_date, count(*) AS n FROM m WHERE source_ingest_date = '2026-08-17' GROUP BY 1",
)

# --- projections / expressions ---------------------------------------------

_PREVIEW = [
    "match_id", "participant_id", "champion_name", "team_position", "kills", "deaths",
    "assists", "gold_earned", "win", "is_bot_player", "dt",
]
oracle(
    "player_match_preview",
    f"SELECT {', '.join(_PREVIEW)} FROM p ORDER BY "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in _PREVIEW)
    + " LIMIT 30",
)
oracle("json_path_extract", "SELECT * FROM m")
oracle(
    "epoch_to_dt",
    """SELECT mx.match_id, mx.start_ms // 1000 AS start_s, m.game_start_time, m.game_end_time, m.dt
       FROM mx JOIN m ON mx.match_id = m.match_id""",
)
oracle("patch_version", "SELECT match_id, version AS game_version, patch_version FROM mx")
oracle(
    "patch_by_split",
    """SELECT match_id, version AS game_version,
              CASE WHEN version IS NOT NULL AND version <> ''
                        AND len(string_split(version, '.')) >= 2
                   THEN split_part(version, '.', 1) || '.' || split_part(version, '.', 2)
              END AS patch
       FROM mx""",
)
oracle("is_bot_match", "SELECT match_id, CASE WHEN has_bot THEN 1 ELSE 0 END AS is_bot_match FROM mx")
oracle(
    "is_early_surrender",
    "SELECT match_id, CASE WHEN has_early THEN 1 ELSE 0 END AS is_early_surrender FROM mx",
)
oracle("player_flags", "SELECT match_id, participant_id, is_bot_player, is_early_surrender FROM p")
oracle("participant_count", "SELECT match_id, n_participants AS participant_count FROM mx")
oracle("explode_participants", "SELECT match_id, participant_id, puuid, champion_id FROM p")
oracle("kda_ratio", "SELECT dt, patch_version, queue_id, champion_id, kda_ratio FROM ads")
oracle("human_players", "SELECT match_id, puuid FROM p WHERE puuid IS NOT NULL AND puuid <> '' AND puuid <> 'BOT'")


# Fixed values, stated here apart from the code under test: the fields that a
# document, a participant and a profile have.
_INFO_KEYS = (
    "gameId platformId gameCreation gameStartTimestamp gameEndTimestamp gameDuration "
    "gameMode gameType gameVersion mapId queueId"
).split()
_PARTICIPANT_KEYS = (
    "participantId puuid riotIdGameName riotIdTagline teamId championId championName champLevel "
    "teamPosition individualPosition kills deaths assists goldEarned totalDamageDealtToChampions "
    "totalDamageTaken totalMinionsKilled neutralMinionsKilled visionScore wardsPlaced wardsKilled "
    "item0 item1 item2 item3 item4 item5 item6 win gameEndedInEarlySurrender gameEndedInSurrender"
).split()
_REQUIRED_KEYS = (
    "gameStartTimestamp gameEndTimestamp gameDuration gameMode gameType gameVersion mapId platformId queueId"
).split()


def _document_keys_sql() -> str:
    rows = [("document", "metadata", "true"), ("document", "info", "true")]
    for name in _INFO_KEYS:
        cond = "EXISTS (SELECT 1 FROM mx WHERE version IS NOT NULL)" if name == "gameVersion" else "true"
        rows.append(("info", name, cond))
    rows.append(("info", "participants", "EXISTS (SELECT 1 FROM mx WHERE n_participants IS NOT NULL)"))
    rows.append(("info", "teams", "true"))
    for name in _PARTICIPANT_KEYS:
        rows.append(("participant", name, "EXISTS (SELECT 1 FROM p)"))
    parts = [f"SELECT '{s}' AS scope, '{k}' AS key WHERE {c}" for s, k, c in rows]
    return " UNION ALL ".join(parts)


oracle("document_keys", _document_keys_sql())
oracle(
    "match_basic_info",
    """SELECT match_id, k AS game_id, start_ms AS game_creation, start_ms AS game_start_timestamp,
              start_ms + duration * 1000 AS game_end_timestamp, duration AS game_duration,
              o_orderpriority AS game_mode, o_orderstatus AS game_type, version AS game_version,
              map_id, 'P' || CAST(o_custkey % 4 AS VARCHAR) AS platform_id, queue_id,
              n_participants AS participant_count
       FROM mx""",
)
oracle(
    "participant_identity",
    """SELECT match_id, participant_id, puuid, 'player' || CAST(_supp AS VARCHAR) AS riot_id_game_name,
              'EUW' AS riot_id_tagline, team_id, champion_id, champion_name, kills, deaths, assists, win
       FROM p""",
)
oracle(
    "team_rows",
    """SELECT match_id, 100 AS team_id, k % 2 = 0 AS win FROM mx
       UNION ALL SELECT match_id, 200 AS team_id, k % 2 = 1 AS win FROM mx""",
)
oracle(
    "ads_slice",
    "SELECT * FROM ads WHERE queue_id = 420 AND dt >= '1996-01-01' AND dt <= '1997-12-31'",
)

# --- quality ----------------------------------------------------------------


def _zero_rule(rid: str, name: str, count_sql: str) -> str:
    return (
        f"SELECT '{rid}' AS rule_id, '{name}' AS rule_name, "
        "CASE WHEN c = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
        "CAST(c AS VARCHAR) AS actual_value, '0' AS expected_value "
        f"FROM ({count_sql}) t"
    )


_DQ = {
    "dq01": _zero_rule(
        "DQ01", "match_id uniqueness",
        "SELECT count(*) AS c FROM (SELECT match_id FROM m GROUP BY match_id HAVING count(*) > 1)",
    ),
    "dq02": _zero_rule("DQ02", "match_id not null", "SELECT count(*) AS c FROM m WHERE match_id IS NULL"),
    "dq03": _zero_rule(
        "DQ03", "10 players per match",
        "SELECT count(*) AS c FROM (SELECT match_id FROM p GROUP BY match_id HAVING count(*) <> 10)",
    ),
    "dq04": _zero_rule(
        "DQ04", "player-match uniqueness",
        "SELECT count(*) AS c FROM (SELECT match_id, participant_id FROM p "
        "GROUP BY match_id, participant_id HAVING count(*) > 1)",
    ),
    "dq05": _zero_rule(
        "DQ05", "match = win + loss",
        "SELECT count(*) AS c FROM dws WHERE match_count <> win_count + loss_count",
    ),
    "dq06": _zero_rule(
        "DQ06", "win_rate range",
        "SELECT count(*) AS c FROM ads WHERE win_rate IS NULL OR win_rate < 0 OR win_rate > 1",
    ),
    "dq07": """SELECT 'DQ07' AS rule_id, 'DWS/ADS reconciliation' AS rule_name,
                      CASE WHEN d.n = a.n THEN 'PASS' ELSE 'FAIL' END AS status,
                      'DWS=' || CAST(d.n AS VARCHAR) || ', ADS=' || CAST(a.n AS VARCHAR) AS actual_value,
                      'DWS count = ADS count' AS expected_value
               FROM (SELECT count(*) AS n FROM dws) d, (SELECT count(*) AS n FROM ads) a""",
}
for _k, _sql in _DQ.items():
    oracle(_k, _sql)
_REPORT = " UNION ALL ".join(f"({s})" for s in _DQ.values())
oracle("dq_report", _REPORT + " ORDER BY rule_id")
oracle(
    "dq_history",
    f"""SELECT 'run of ' || d AS run_id, rule_id, status, actual_value, d AS batch_date, true AS timed,
              (SELECT 2 * max(CASE WHEN status = 'PASS' THEN 0 ELSE 1 END) FROM ({_REPORT}) r)::INT AS runs_stopped
       FROM ({_REPORT}) r, (VALUES ('2026-08-16'), ('2026-08-17')) v(d)""",
)
oracle("dq_summary", f"SELECT status, count(*) AS n FROM ({_REPORT}) r GROUP BY status")
oracle(
    "fanout_reconciliation",
    """SELECT count(*) AS documents,
              CAST(sum(n_participants) AS BIGINT) AS expected_players,
              (SELECT count(*) FROM lineitem) AS exploded_players,
              CASE WHEN sum(n_participants) = (SELECT count(*) FROM lineitem) THEN 'PASS' ELSE 'FAIL' END AS status
       FROM mx""",
)
oracle("expected_player_count", "SELECT CAST(sum(n_participants) AS BIGINT) AS expected_count FROM mx")

# --- filters ----------------------------------------------------------------

_VALID = "coalesce(n_participants, 0) = 10 AND NOT has_bot AND map_id = 11"
oracle("valid_matches", f"SELECT match_id FROM mx WHERE {_VALID}")
oracle("valid_matches_any_map", "SELECT match_id FROM mx WHERE coalesce(n_participants, 0) = 10 AND NOT has_bot")

# --- profile ----------------------------------------------------------------

oracle(
    "profile_basic",
    f"""SELECT count(*) AS json_files,
               CAST(count(*) FILTER (WHERE match_id IS NOT NULL AND match_id <> '') AS BIGINT) AS parsed_matches,
               CAST(0 AS BIGINT) AS parse_errors,
               CAST(count(DISTINCT match_id) AS BIGINT) AS unique_match_ids,
               CAST(count(*) FILTER (WHERE match_id IS NOT NULL AND match_id <> '') - count(DISTINCT match_id) AS BIGINT)
                   AS duplicate_match_ids,
               CAST(count(*) FILTER (WHERE {_VALID}) AS BIGINT) AS valid_pvp_matches,
               CAST(count(*) FILTER (WHERE has_bot) AS BIGINT) AS bot_matches
        FROM mx""",
)
oracle("freq_mode", "SELECT o_orderpriority AS game_mode, count(*) AS n FROM mx GROUP BY 1 ORDER BY n DESC, 1")
oracle("freq_queue", "SELECT queue_id, count(*) AS n FROM mx GROUP BY 1 ORDER BY n DESC, 1")
oracle("freq_map", "SELECT map_id, count(*) AS n FROM mx GROUP BY 1 ORDER BY n DESC, 1")
oracle(
    "freq_patch",
    """SELECT split_part(version, '.', 1) || '.' || split_part(version, '.', 2) AS patch, count(*) AS n
       FROM mx WHERE version IS NOT NULL AND version <> '' AND len(string_split(version, '.')) >= 2
       GROUP BY 1 ORDER BY n DESC, 1""",
)
oracle(
    "freq_participants",
    "SELECT coalesce(n_participants, 0) AS participants, count(*) AS n FROM mx GROUP BY 1 ORDER BY 1",
)
oracle(
    "profile_duration",
    """SELECT CAST(min(duration) AS BIGINT) AS min_duration, CAST(max(duration) AS BIGINT) AS max_duration,
              round(avg(CAST(duration AS DOUBLE)), 2) AS avg_duration,
              round(median(CAST(duration AS DOUBLE)), 2) AS median_duration
       FROM mx WHERE duration IS NOT NULL""",
)


def _iso(ms: str) -> str:
    return (
        f"strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN {ms} % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(({ms} % 1000) * 1000 AS VARCHAR), 6, '0') END"
        " || '+00:00'"
    )


oracle(
    "profile_date_range",
    f"""SELECT earliest_ms, latest_ms, {_iso('earliest_ms')} AS earliest_utc, {_iso('latest_ms')} AS latest_utc
        FROM (SELECT min(start_ms) AS earliest_ms, max(start_ms) AS latest_ms FROM mx)""",
)


def _missing_sql() -> str:
    expr = {
        "gameStartTimestamp": "start_ms",
        "gameEndTimestamp": "start_ms + duration * 1000",
        "gameDuration": "duration",
        "gameMode": "o_orderpriority",
        "gameType": "o_orderstatus",
        "gameVersion": "version",
        "mapId": "map_id",
        "platformId": "o_custkey % 4",
        "queueId": "queue_id",
    }
    parts = [
        "SELECT 'metadata.matchId' AS field, count(*) FILTER (WHERE match_id IS NULL OR match_id = '') AS missing_count FROM mx"
    ]
    for f in _REQUIRED_KEYS:
        parts.append(f"SELECT '{f}', count(*) FILTER (WHERE ({expr[f]}) IS NULL) FROM mx")
    return (
        "SELECT field, missing_count FROM (" + " UNION ALL ".join(parts) + ") t "
        "WHERE missing_count > 0 ORDER BY missing_count DESC, field"
    )


oracle("missing_fields", _missing_sql())
oracle(
    "short_matches",
    """SELECT match_id, coalesce(duration, 0) AS duration, o_orderpriority AS game_mode, queue_id, map_id,
              has_bot, coalesce(n_participants, 0) AS participants,
              has_surrender AS game_ended_in_surrender, has_early AS game_ended_in_early_surrender
       FROM mx WHERE coalesce(duration, 0) < 300 ORDER BY duration, match_id""",
)


def _profile_sql(rows: str) -> str:
    """The whole profile of ``rows``: columns of mx, with torn (not JSON), match_id
    and dur (a duration that is a JSON number) as the texts have them."""
    starts = {
        "gameStartTimestamp": "start_ms", "gameEndTimestamp": "start_ms", "gameDuration": "duration",
        "gameMode": "o_orderpriority", "gameType": "o_orderstatus", "gameVersion": "version",
        "mapId": "map_id", "platformId": "o_custkey", "queueId": "queue_id", "metadata.matchId": "match_id",
    }
    tables = {
        "participants": "coalesce(n_participants, 0)", "game_mode": "o_orderpriority",
        "queue_id": "queue_id", "map_id": "map_id",
    }
    count = lambda cond: f"count(*) FILTER (WHERE {cond})"
    scalars = [
        ("basic", "json_files", "count(*) + (SELECT count(*) FROM d WHERE torn)", "NULL"),
        ("basic", "parsed_matches", count("match_id IS NOT NULL"), "NULL"),
        ("basic", "parse_errors", "0 * count(*) + (SELECT count(*) FROM d WHERE torn)", "NULL"),
        ("basic", "unique_match_ids", "count(DISTINCT match_id)", "NULL"),
        ("basic", "duplicate_match_ids", "count(match_id) - count(DISTINCT match_id)", "NULL"),
        ("match_type", "valid_pvp_matches", count(_VALID), "NULL"),
        ("match_type", "bot_matches", count("has_bot"), "NULL"),
        ("duration", "minimum", "min(dur)", "NULL"),
        ("duration", "maximum", "max(dur)", "NULL"),
        ("duration", "average", "round(avg(dur), 2)", "NULL"),
        ("duration", "median", "round(median(dur), 2)", "NULL"),
        ("date_range", "earliest", "min(start_ms)", _iso("min(start_ms)")),
        ("date_range", "latest", "max(start_ms)", _iso("max(start_ms)")),
        *[("missing_fields", f, count(f"{c} IS NULL"), "NULL") for f, c in starts.items()],
    ]
    parts = [f"SELECT '{s}' AS section, '{k}' AS key, ({v})::DOUBLE AS value, ({t})::VARCHAR AS text FROM ok" for s, k, v, t in scalars]
    parts += [f"SELECT '{s}', ({e})::VARCHAR, count(*)::DOUBLE, NULL FROM ok GROUP BY ({e})" for s, e in tables.items()]
    parts.append(
        "SELECT 'patch', split_part(version, '.', 1) || '.' || split_part(version, '.', 2), count(*)::DOUBLE, NULL "
        "FROM ok WHERE len(string_split(version, '.')) >= 2 GROUP BY 2"
    )
    return _with(
        f"SELECT * FROM (WITH d AS ({rows}), ok AS (SELECT * FROM d WHERE NOT torn) {' UNION ALL '.join(parts)}) "
        "WHERE section <> 'missing_fields' OR value > 0 ORDER BY section, key"
    )


_DIRTY = """SELECT mx.* REPLACE (CASE WHEN k % 43 = 0 THEN NULL ELSE match_id END AS match_id), k % 41 = 0 AS torn,
  CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN duration + 0.5::DOUBLE ELSE duration END AS dur
  FROM mx, range(CASE WHEN k % 47 = 0 THEN 2 ELSE 1 END)"""
ORACLE["profile_dataset"] = _profile_sql("SELECT *, false AS torn, duration::DOUBLE AS dur FROM mx")
ORACLE["profile_dataset_dirty"] = _profile_sql(_DIRTY)
oracle(
    "corrupt_records",
    """SELECT CASE WHEN k % 43 = 0 THEN '' ELSE match_id END AS rescued_id, ingest_date, ingest_date AS source_ingest_date
       FROM mx, range(CASE WHEN k % 47 = 0 THEN 2 ELSE 1 END) WHERE k % 41 = 0""",
)

# --- landing ----------------------------------------------------------------

_NEW = f"""nw AS (
  SELECT match_id, ({_VALID}) AS is_valid FROM mx
  WHERE match_id IN (SELECT match_id FROM p WHERE puuid IS NOT NULL AND puuid <> '' AND puuid <> 'BOT')
    AND match_id NOT IN (SELECT match_id FROM mx WHERE ingest_date = '2026-08-16')
),
fv AS (SELECT match_id FROM nw WHERE is_valid ORDER BY match_id LIMIT 20),
bd AS (SELECT max(match_id) AS bnd, count(*) AS n FROM fv),
mf AS (
  SELECT '2026-08-17' AS batch_date,
         CASE WHEN bd.n >= 20 THEN 'completed' ELSE 'incomplete' END AS status,
         20 AS target_new_matches, nw.match_id, nw.is_valid
  FROM nw, bd WHERE bd.n < 20 OR nw.match_id <= bd.bnd
)"""


def _with_new(body: str) -> str:
    return "WITH " + _PRELUDE.strip() + ",\n" + _NEW + "\n" + body.strip()


ORACLE["new_matches"] = _with_new("SELECT match_id FROM nw")
ORACLE["new_matches_by_index"] = _with_new("SELECT match_id FROM nw")
ORACLE["new_valid_batch_cut"] = _with_new("SELECT match_id FROM nw WHERE is_valid ORDER BY match_id LIMIT 3")
ORACLE["new_valid_batch"] = _with_new("SELECT match_id FROM fv")
ORACLE["batch_manifest"] = _with_new("SELECT * FROM mf")
ORACLE["manifest_members"] = _with_new(
    "SELECT match_id, ingest_date FROM mx WHERE match_id IN (SELECT match_id FROM mf)"
)
ORACLE["manifest_missing"] = _with_new(
    "SELECT DISTINCT match_id FROM mf WHERE match_id NOT IN "
    "(SELECT match_id FROM mx WHERE ingest_date = '2026-08-17')"
)
ORACLE["compact_jsonl"] = _with_new(
    """SELECT '2026-08-17' AS batch_date, (SELECT count(*) FROM mf) AS manifest_ids, count(*) AS lines_written,
              count(*) FILTER (WHERE mx.has_bot) AS bot_matches_literal,
              count(*) FILTER (WHERE mx.has_early) AS early_surrender_matches_literal,
              CASE WHEN (SELECT count(*) FROM mf) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status
       FROM mx WHERE ingest_date = '2026-08-17' AND match_id IN (SELECT match_id FROM mf)"""
)
ORACLE["compact_torn_jsonl"] = _with_new(
    """SELECT '2026-08-17' AS batch_date, (SELECT count(*) FROM mf) AS manifest_ids, count(*) AS lines_written,
              count(*) FILTER (WHERE mx.has_bot) AS bot_matches_literal,
              count(*) FILTER (WHERE mx.has_early) AS early_surrender_matches_literal,
              CASE WHEN (SELECT count(*) FROM mf) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status
       FROM mx, range(CASE WHEN k % 47 = 0 THEN 2 ELSE 1 END)
       WHERE ingest_date = '2026-08-17' AND k % 41 <> 0 AND k % 43 <> 0 AND match_id IN (SELECT match_id FROM mf)"""
)
ORACLE["missing_from_torn"] = _with_new(
    "SELECT DISTINCT match_id FROM mf WHERE match_id NOT IN "
    "(SELECT match_id FROM mx WHERE ingest_date = '2026-08-17' AND k % 41 <> 0 AND k % 43 <> 0)"
)

# --- graph ------------------------------------------------------------------

_GRAPH = f"""e AS (SELECT DISTINCT match_id, puuid FROM p WHERE puuid IS NOT NULL AND puuid <> '' AND puuid <> 'BOT'),
v AS (SELECT match_id FROM mx WHERE {_VALID}),
s0 AS (SELECT DISTINCT puuid FROM e WHERE match_id = (SELECT min(match_id) FROM v)),
h1m AS (SELECT DISTINCT match_id FROM e WHERE puuid IN (SELECT puuid FROM s0) AND match_id IN (SELECT match_id FROM v)),
h1 AS (SELECT DISTINCT puuid FROM e WHERE match_id IN (SELECT match_id FROM h1m) AND puuid NOT IN (SELECT puuid FROM s0)),
h2m AS (SELECT DISTINCT match_id FROM e WHERE puuid IN (SELECT puuid FROM h1) AND match_id IN (SELECT match_id FROM v)),
h2 AS (SELECT DISTINCT puuid FROM e WHERE match_id IN (SELECT match_id FROM h2m)
         AND puuid NOT IN (SELECT puuid FROM s0) AND puuid NOT IN (SELECT puuid FROM h1))"""


def _with_graph(body: str) -> str:
    return "WITH " + _PRELUDE.strip() + ",\n" + _GRAPH + "\n" + body.strip()


def _collect_sql(limit: str) -> str:
    """The collector's loop: a match's hop is the least hop of a player who has it
    among the recent ones. A walk of 24 steps is longer than any shortest one here."""
    return (
        "WITH RECURSIVE " + _PRELUDE.strip() + f""",
e AS (SELECT DISTINCT match_id, puuid FROM p WHERE puuid IS NOT NULL AND puuid <> '' AND puuid <> 'BOT'),
v AS (SELECT match_id FROM mx WHERE {_VALID}),
landed AS (SELECT match_id FROM mx WHERE ingest_date = '2026-08-16'),
r AS (SELECT puuid, match_id FROM (
        SELECT puuid, match_id, row_number() OVER (PARTITION BY puuid ORDER BY game_start_time DESC, match_id) AS i
        FROM (SELECT DISTINCT puuid, match_id, game_start_time FROM p WHERE puuid <> 'BOT')) WHERE i <= 200),
reach AS (SELECT DISTINCT r.puuid, r.match_id, e.puuid AS other FROM r JOIN v USING (match_id) JOIN e USING (match_id)),
walk AS (
  SELECT 1 AS hop, puuid FROM e WHERE match_id = (SELECT min(match_id) FROM v WHERE match_id IN (SELECT match_id FROM landed))
  UNION
  SELECT hop + 1, other FROM walk JOIN reach USING (puuid) WHERE hop < 24),
first AS (SELECT puuid, min(hop) AS hop FROM walk GROUP BY puuid)
SELECT min(hop) AS hop, match_id FROM first JOIN reach USING (puuid)
WHERE match_id NOT IN (SELECT match_id FROM landed) GROUP BY match_id ORDER BY 1, 2 {limit}"""
    )


ORACLE["frontier_to_target"] = _collect_sql("LIMIT 3")
ORACLE["frontier_to_exhaustion"] = _collect_sql("")


ORACLE["player_match_edges"] = _with_graph("SELECT match_id, puuid FROM e")
ORACLE["frontier_1hop"] = _with_graph("SELECT 1 AS hop, puuid FROM h1")
ORACLE["frontier_2hop"] = _with_graph(
    "SELECT 1 AS hop, puuid FROM h1 UNION ALL SELECT 2 AS hop, puuid FROM h2"
)
oracle(
    "recent_matches_per_player",
    """SELECT puuid, match_id, game_start_time, CAST(recent_rank AS INTEGER) AS recent_rank FROM (
         SELECT puuid, match_id, game_start_time,
                row_number() OVER (PARTITION BY puuid ORDER BY game_start_time DESC, match_id ASC) AS recent_rank
         FROM (SELECT DISTINCT puuid, match_id, game_start_time FROM p
               WHERE puuid IS NOT NULL AND puuid <> '' AND puuid <> 'BOT') d
       ) r WHERE recent_rank <= 20""",
)
