"""Comparisons across components of a bucket: tiles against a plain version, and a
bucket of many look-alikes."""

import random

import brute
import numpy as np

from matchmart.llm import near_dedup


def plain_pairs(rows):
    out = set()
    for band, x, c, n, p in rows:
        for band2, y, d, m, q in rows:
            if band == band2 and x < y and c != d and 175 * int(np.minimum(p, q).sum()) >= 75 * (n + m):
                out.add((x, y))
    return out


def test_tiles_find_every_possible_pair(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for band in range(4):
        base = rng.integers(0, 6, near_dedup.PROFILE).astype("<i4")
        for x in range([1, 2, 40, 90][band]):
            p = np.maximum(base + rng.integers(-1, 2, near_dedup.PROFILE) * (rng.random(near_dedup.PROFILE) < rng.random()), 0)
            rows.append((band, x, int(rng.integers(0, 5)), int(p.sum()), p.astype("<i4")))
    frame = spark.createDataFrame(
        [(b, x, c, n, bytearray(p.tobytes())) for b, x, c, n, p in rows], "band long, x long, c long, n long, profile binary"
    )
    want = plain_pairs(rows)
    assert 50 < len(want) < 4000
    for piece, tile in ((2048, 512), (7, 3)):
        monkeypatch.setattr(near_dedup, "PIECE", piece)
        monkeypatch.setattr(near_dedup, "TILE", tile)
        got = near_dedup.possible_pairs(frame).collect()
        assert sorted((r["x"], r["y"]) for r in got) == sorted(want)


def test_many_look_alikes(spark):
    """300 variations of one text, most under the threshold to each other."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(0, 11)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_dedup(docs).collect()}
    assert got == brute.near_groups(rows)
