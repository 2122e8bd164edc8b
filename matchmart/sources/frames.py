"""The flat working form of a set of match documents.

``MatchFrames`` holds two DataFrames:

* ``matches``: one row per document, the ``info`` scalars plus document-level
  facts over the participants array (count, any bot, any early surrender, any
  surrender);
* ``participants``: one row per participant with the header fields the
  player table needs.

From nested documents both are narrow projections (``size``/``exists`` and
``explode`` need no shuffle). From flat source tables they are joins plus a
partially aggregated rollup. No builder downstream ever regroups participants
into arrays, so a huge match cannot end up as one row in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.functions.exprs import any_element, safe_boolean, typed
from matchmart.schema import (
    CORRUPT_COLUMN,
    INFO_FIELDS,
    PARTICIPANT_FIELDS,
    PARTICIPANT_HEADER_COLUMNS,
)


#: Facts about a document's players: what any of them has, and the field it is taken from.
_ANY_PLAYER = {
    "has_bot": ("puuid", lambda p: p["puuid"] == "BOT"),
    "has_early_surrender": ("gameEndedInEarlySurrender", lambda p: safe_boolean(p["gameEndedInEarlySurrender"])),
    "has_surrender": ("gameEndedInSurrender", lambda p: safe_boolean(p["gameEndedInSurrender"])),
}


@dataclass(frozen=True)
class MatchFrames:
    matches: DataFrame
    participants: DataFrame


def frames_from_documents(docs: DataFrame) -> MatchFrames:
    """Split nested documents (``metadata``, ``info``, ``ingest_date``) whose
    leaves are text or typed; every leaf is cast leniently to its type here.

    Narrow: no exchange is added. ``explode`` drops documents whose
    participants array is NULL or empty, as the reference does (W9). Documents
    that were read for some of their fields give frames without the other columns.
    """
    parts = F.col("info.participants")
    kind = docs.schema["info"].dataType
    info = [(n, t) for n, t in INFO_FIELDS if n in kind.names]
    played = kind["participants"].dataType.elementType.names
    # A parse error is a file that is not JSON at all: nothing parsed. (A type
    # mismatch inside valid JSON also sets the corrupt column, but keeps the
    # fields that did parse; that document counts as read.) Referencing the
    # parsed columns also keeps them in the scan's read schema.
    corrupt = (
        F.col(CORRUPT_COLUMN).isNotNull() & F.col("metadata").isNull() & F.col("info").isNull()
        if CORRUPT_COLUMN in docs.columns
        else F.lit(False)
    )
    matches = docs.select(
        F.col("metadata.matchId").alias("match_id"),
        F.col("ingest_date").cast("string").alias("ingest_date"),
        *[typed(f"info.{n}", t).alias(n) for n, t in info],
        F.size(parts).alias("n_participants"),
        *[any_element(parts, fact).alias(name) for name, (field, fact) in _ANY_PLAYER.items() if field in played],
        corrupt.alias("is_corrupt"),
    )
    header = {
        "match_id": F.col("metadata.matchId"),
        "ingest_date": F.col("ingest_date").cast("string"),
        **{n: typed(f"info.{n}", t) for n, t in info if n in PARTICIPANT_HEADER_COLUMNS},
    }
    exploded = docs.select(
        *[c.alias(n) for n, c in header.items()],
        F.explode(parts).alias("p"),
    )
    participants = exploded.select(
        *[n for n in PARTICIPANT_HEADER_COLUMNS if n in header],
        *[typed(f"p.{n}", t).alias(n) for n, t in PARTICIPANT_FIELDS if n in played],
    )
    return MatchFrames(matches, participants)
