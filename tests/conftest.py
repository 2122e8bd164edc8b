from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from matchmart.session import get_session

    base = tempfile.mkdtemp(prefix="matchmart-test-")
    extra = {
        "spark.sql.warehouse.dir": os.path.join(base, "warehouse"),
        "spark.driver.memory": "4g",
    }
    s = get_session("local[4]", app_name="matchmart-tests", shuffle_partitions=4, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint location (a cluster names a shared one).
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", os.path.join(base, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)


def participant(pid, puuid="S1", win=True, **kw):
    p = {
        "participantId": pid,
        "puuid": puuid,
        "riotIdGameName": f"n{pid}",
        "riotIdTagline": "T",
        "teamId": 100 if pid % 2 else 200,
        "championId": kw.pop("championId", 1),
        "championName": kw.pop("championName", "Ahri"),
        "champLevel": 10,
        "teamPosition": "MID",
        "individualPosition": "MID",
        "kills": kw.pop("kills", 1),
        "deaths": kw.pop("deaths", 1),
        "assists": kw.pop("assists", 1),
        "goldEarned": 1000,
        "totalDamageDealtToChampions": 500,
        "totalDamageTaken": 400,
        "totalMinionsKilled": 10,
        "neutralMinionsKilled": 2,
        "visionScore": 5,
        "wardsPlaced": 3,
        "wardsKilled": 1,
        "win": win,
        "gameEndedInEarlySurrender": kw.pop("early", False),
        "gameEndedInSurrender": kw.pop("surrender", False),
    }
    for i in range(7):
        p[f"item{i}"] = i
    p.update(kw)
    return p


def document(match_id, participants=None, start_ms=1_700_000_000_000, duration=1800, version="16.16.804.1", map_id=11, queue_id=420, **info_kw):
    info = {
        "gameId": int(match_id.split("_")[-1]) if match_id and match_id.split("_")[-1].isdigit() else 1,
        "platformId": "EUW1",
        "gameCreation": start_ms,
        "gameStartTimestamp": start_ms,
        "gameEndTimestamp": start_ms + (duration if duration is not ... else 0) * 1000,
        "gameDuration": duration,
        "gameMode": "CLASSIC",
        "gameType": "MATCHED_GAME",
        "gameVersion": version,
        "mapId": map_id,
        "queueId": queue_id,
        "teams": [{"teamId": 100, "win": True}, {"teamId": 200, "win": False}],
    }
    if participants is not None:
        info["participants"] = participants
    info.update(info_kw)
    for k in [k for k, v in info.items() if v is ...]:
        del info[k]
    meta = {"matchId": match_id}
    if participants:
        meta["participants"] = [p.get("puuid") for p in participants]
    return {"metadata": meta, "info": info}


def write_docs(root, ingest_date, docs, pretty=True, names=None):
    """One file per document, named ``<id>.json`` (or ``names``)."""
    d = os.path.join(root, f"ingest_date={ingest_date}")
    os.makedirs(d, exist_ok=True)
    for i, doc in enumerate(docs):
        name = names[i] if names else f"{doc['metadata'].get('matchId') or 'doc' + str(i)}.json"
        with open(os.path.join(d, name), "w") as f:
            if isinstance(doc, str):
                f.write(doc)
            else:
                json.dump(doc, f, indent=2 if pretty else None, separators=None if pretty else (",", ":"))
    return root


def ten(prefix="S", **kw):
    return [participant(i, f"{prefix}{i}", win=(i % 2 == 1), **kw) for i in range(1, 11)]
