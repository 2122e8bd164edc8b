"""Scalar and array expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patch pattern ("major.minor" prefix of the game version) and the
# bot marker used as a participant id.
PATCH_PATTERN = r"^([0-9]+\.[0-9]+)"
BOT_PUUID = "BOT"
VALID_PARTICIPANTS = 10
VALID_MAP_ID = 11


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- casts ------------------------------------------------------------------


def safe_bigint(x: Column | str) -> Column:
    """Text/number -> BIGINT that yields NULL instead of failing.

    Integral text casts directly; decimal text such as ``"12.7"`` goes through
    DECIMAL and is truncated, as a lenient cast would.
    """
    c = _c(x)
    return F.coalesce(
        c.try_cast("bigint"),
        c.try_cast("decimal(38,10)").try_cast("bigint"),
    )


def safe_int(x: Column | str) -> Column:
    c = _c(x)
    return F.coalesce(
        c.try_cast("int"),
        c.try_cast("decimal(38,10)").try_cast("int"),
    )


def safe_boolean(x: Column | str) -> Column:
    return _c(x).try_cast("boolean")


def typed(x: Column | str, kind: T.DataType) -> Column:
    """A document leaf (text, or already typed) as ``kind``; what can't be that
    is NULL."""
    if isinstance(kind, T.LongType):
        return safe_bigint(x)
    if isinstance(kind, T.IntegerType):
        return safe_int(x)
    if isinstance(kind, T.BooleanType):
        return safe_boolean(x)
    return _c(x).cast(kind)


# --- time -------------------------------------------------------------------


def epoch_ms_to_s(ms: Column | str) -> Column:
    """Epoch milliseconds -> whole seconds (integer division, P4)."""
    return F.call_function("div", safe_bigint(ms), F.lit(1000).cast("bigint"))


def timestamp_string_from_epoch_s(s: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text in the session time zone (P5)."""
    return F.from_unixtime(_c(s))


def date_string_from_epoch_s(s: Column | str) -> Column:
    """``yyyy-MM-dd`` partition text."""
    return F.from_unixtime(_c(s), "yyyy-MM-dd")


def timestamp_from_epoch_s(s: Column | str) -> Column:
    """TIMESTAMP at second precision (P5 + P7)."""
    return F.timestamp_seconds(_c(s))


def iso_utc_from_epoch_ms(ms: Column | str) -> Column:
    """ISO-8601 text with a ``+00:00`` offset, microseconds only when non-zero,
    as Python's ``datetime.isoformat`` prints an aware UTC time (P28)."""
    ts = F.timestamp_millis(_c(ms).try_cast("bigint"))
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None)).otherwise(
        F.concat(
            whole,
            F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
            F.lit("+00:00"),
        )
    )


# --- versions ---------------------------------------------------------------


def patch_version(version: Column | str) -> Column:
    """``major.minor`` prefix; ``''`` when the text does not start with one,
    NULL for NULL (P9)."""
    return F.regexp_extract(_c(version), PATCH_PATTERN, 1)


def patch_by_split(version: Column | str) -> Column:
    """First two dot-separated parts when there are at least two, else NULL.
    Empty version counts as missing (P10, profile only)."""
    v = _c(version)
    parts = F.split(v, r"\.")
    return F.when(
        v.isNotNull() & (v != "") & (F.size(parts) >= 2),
        F.concat_ws(".", F.slice(parts, 1, 2)),
    )


# --- arrays -----------------------------------------------------------------


def any_element(arr: Column | str, pred: Callable[[Column], Column]) -> Column:
    """True when any element satisfies ``pred``; a NULL/absent array or only
    NULL predicate results count as false (W4)."""
    return F.coalesce(F.exists(_c(arr), pred), F.lit(False))


def human_ids(participants: Column | str) -> Column:
    """Non-empty, non-bot participant ids of a document, in document order."""
    ids = F.transform(_c(participants), lambda p: p["puuid"])
    return F.filter(ids, lambda u: u.isNotNull() & (u != "") & (u != F.lit(BOT_PUUID)))


def valid_match(
    n_participants: Column | str,
    has_bot: Column | str,
    map_id: Column | str,
    required_map: int | None = VALID_MAP_ID,
    required_players: int = VALID_PARTICIPANTS,
) -> Column:
    """Valid PvP match (F8); ``required_map=None`` gives the weaker F9 rule.

    A missing participants array counts as zero players.
    """
    cond = (F.coalesce(_c(n_participants), F.lit(0)) == required_players) & ~_c(has_bot)
    if required_map is not None:
        cond = cond & F.coalesce(_c(map_id) == required_map, F.lit(False))
    return cond


# --- flags and ratios -------------------------------------------------------


def flag(cond: Column) -> Column:
    """Boolean -> 1/0 integer flag; NULL counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def per_match(total: Column | str, match_count: Column | str) -> Column:
    """Double average over a positive match count (P20)."""
    return _c(total).cast("double") / _c(match_count)


def kda_ratio(kills: Column | str, deaths: Column | str, assists: Column | str) -> Column:
    """(kills + assists) / deaths, or kills + assists when deaths is 0.

    The guard matters: division by zero raises under ANSI.
    """
    ka = (_c(kills) + _c(assists)).cast("double")
    return F.when(_c(deaths) == 0, ka).otherwise(ka / _c(deaths))
