"""Operators 11 to 13 against plain versions, on awkward and on empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from matchmart.llm import fingerprints, resampling, spelling
from matchmart.llm import words as W

ROWS = brute.awkward()
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "docs")
    spark.createDataFrame(ROWS, brute.SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


# --- 11 resampling -----------------------------------------------------------------


def plain_resample(rows, target, buckets, min_words, percent):
    ids = [(r[0], [zlib.crc32(w.encode()) % buckets for w in WORD.findall(lowered(r[1]))]) for r in rows]
    s, t = Counter(b for _, bs in ids for b in bs), Counter(zlib.crc32(w.encode()) % buckets for x in target for w in WORD.findall(lowered(x)))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (t_all) / ((s[b] + 1) * (s_all)))) for b in range(buckets)
            for t_all, s_all in [(float(sum(s.values()) + buckets), float(sum(t.values()) + buckets))]]
    out = []
    for i, bs in ids:
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        out.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = percent * len(fit) // 100
    ranks = Counter((*r, k + 1) for k, r in enumerate(fit[:drawn]))
    ranks.update((*r, None) for r in fit[drawn:])
    ranks.update((*r, None) for r in out if r[1] < min_words)
    return ranks


@pytest.mark.parametrize("min_words, percent, buckets", [(20, 10, 10_000), (1, 73, 7), (0, 100, 100)])
def test_resampling(spark, docs, min_words, percent, buckets):
    target = ["the a été 12", None, "", "w1 w2 foo"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = resampling.resample(docs, frame, buckets, min_words=min_words, percent=percent).collect()
    want = plain_resample(ROWS, target, buckets, min_words, percent)
    assert Counter(tuple(r) for r in got) == want


def test_resampling_empty(spark, empty, docs):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(empty, none).count() == 0
    rows = resampling.resample(docs, none, min_words=10**9).collect()
    assert len(rows) == len(ROWS) and all(r["rank"] is None for r in rows)


@pytest.mark.parametrize("ids", ["small", "wide", "null"])
def test_radix_ranks(spark, monkeypatch, ids):
    """Few distinct scores, so that ids decide; ids that need all 64 bits; nulls."""
    monkeypatch.setattr(resampling, "DIGIT", 3)
    rng = random.Random(1)
    value = {"small": lambda: rng.randrange(500), "wide": lambda: rng.randrange(-(1 << 63), 1 << 63), "null": lambda: rng.choice([None, 7, 1 << 40])}[ids]
    rows = [(value(), rng.choice([-5, 0, 3, 1 << 33]), i) for i in range(400)]
    path_rows = spark.createDataFrame(rows, "doc_id long, score long, i long").repartition(6)
    from matchmart.llm.common import staged

    got = sorted(resampling.ranked_by_score(staged(path_rows, "test")).collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in got] == list(range(400))
    key = lambda r: (-r[1], r[0] is None, r[0] or 0)
    assert [(r["score"], r["doc_id"]) for r in got] == [(s, d) for d, s, _ in sorted(rows, key=key)]


# --- 12 fingerprints ---------------------------------------------------------------


def test_fingerprints(spark, docs):
    got = fingerprints.fingerprints(docs).collect()
    assert len(got) == len(ROWS)
    rows = spark.createDataFrame(ROWS, brute.SCHEMA).select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    order = sorted(((r["doc_id"], r["t"], r["h"]) for r in rows.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))
    want = Counter()
    for (i, text, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, last = (fingerprints.fingerprint(t.encode()) for t in (text, edited, after))
        want[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(own), str(other),
             round(fingerprints.likeness(own, other), 9), round(fingerprints.likeness(own, last), 9)] += 1
    assert Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got) == want


def test_fingerprints_of_few_rows(spark, empty):
    assert fingerprints.fingerprints(empty).count() == 0
    one = fingerprints.fingerprints(spark.createDataFrame([(4, "ab\ncd")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert one[0]["edited_sha256"] == hashlib.sha256(b"ab\nab").hexdigest()
    same = spark.createDataFrame([(1, "a. b.\nc")] * 30 + [(None, None)], "doc_id long, text string")
    rows = fingerprints.fingerprints(same).collect()
    assert len(rows) == 31 and len({r["fingerprint"] for r in rows}) == 2


def test_fingerprint_is_a_multiset_hash():
    rng = random.Random(2)
    texts = [t for _, t, *_ in ROWS if t]
    assert len({str(fingerprints.fingerprint(t.encode())) for t in texts}) == len({tuple(sorted(t.split("\n"))) for t in texts})
    for t in texts:
        lines = t.split("\n")
        rng.shuffle(lines)
        whole = fingerprints.fingerprint(t.encode())
        assert str(fingerprints.fingerprint("\n".join(lines).encode())) == str(whole)
        gone = fingerprints.paragraphs([lines[0].encode()])
        rest = fingerprints.paragraphs([x.encode() for x in lines[1:]])
        assert str(whole - gone) == str(rest) and str(rest + gone) == str(whole)


def test_edits_update_fingerprints(monkeypatch):
    rng = random.Random(3)
    for _ in range(300):
        text, tail = ("".join(rng.choice("ab.\n é") for _ in range(rng.randrange(40))) for _ in range(2))
        cut = rng.randrange(len(text) + 1)
        kept = text[:cut].encode()
        got = fingerprints.replaced_tail(text.encode(), fingerprints.fingerprint(text.encode()), len(kept), tail.encode())
        assert str(got) == str(fingerprints.fingerprint(kept + tail.encode()))


def test_likeness_follows_what_is_shared():
    rng = random.Random(4)
    say = lambda n: [f"sentence {rng.random()}." for _ in range(n)]
    for share in (0.0, 0.3, 0.5, 0.9, 1.0):
        common, n = say(int(200 * share)), 200 - int(200 * share)
        a, b = (fingerprints.fingerprint(" ".join(common + say(n)).encode()) for _ in range(2))
        assert abs(fingerprints.likeness(a, b) - share) < 0.25
    wide = fingerprints.fingerprint(("x.\n" * 70_000).encode())
    assert str(wide).split(".")[1] == "4" and fingerprints.likeness(wide, wide) == 1.0


# --- 13 spelling -------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    out = {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 2 * n else None
        out[w] = (form, n, len(close), counts[form] if form else None)
    root = {}
    for w in counts:
        r = w
        while out[r][0]:
            r = out[r][0]
        root[w] = r
    return sorted((w, f, root[w], n, k, m) for w, (f, n, k, m) in out.items())


def plain_words(rows, every, min_length, min_count):
    counts = Counter()
    for r in rows:
        for run in RUN.findall(r[1] or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'null' if r[0] is None else r[0]}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


@pytest.mark.parametrize("every, min_length, min_count", [(97, 5, 3), (3, 1, 1)])
def test_spelling_variants(spark, every, min_length, min_count):
    rng = random.Random(6)
    stems = ["hello", "world", "étéà", "Straße", "a×b", "École", "x" * 40, "x" * 41, "abab", "ababab"]
    say = lambda: "".join(rng.choice(stems) + rng.choice([" ", "-", "7", "一", "\n", "", "Ā"]) for _ in range(60))
    rows = [(i - 9, say()) for i in range(40)] + [(None, say()), (3, None), (4, ""), (5, "y" * 5000 + " " + "y" * 4999)] + [(7, "hello hello")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("z")).withColumn("n", F.lit(1))
    got = spelling.spelling_variants(frame, min_length, min_count, every).collect()
    want = plain_groups(plain_words(rows, every, min_length, min_count))
    assert sorted(map(tuple, got)) == want and any(w[1] for w in want)


def test_spelling_empty(empty):
    assert spelling.spelling_variants(empty).count() == 0


@pytest.mark.parametrize("piece, tile", [(2048, 1 << 22), (3, 64)])
def test_near_words_of_few_letters(spark, monkeypatch, piece, tile):
    """Words over two letters: most are near, many in the same blocks, which are
    cut into pieces."""
    monkeypatch.setattr(spelling, "TILE", tile)
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(150)})
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = [(r["word"], r["near"]) for r in spelling.near_pairs(frame, piece).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if near(a, b))


def test_chains_of_forms(spark):
    """Forms lead over many steps to one root."""
    words = {"a" * (5 + i): 1 << i for i in range(20)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, spelling.group_variants(frame).collect())) == plain_groups(words)


def test_checksums_of_joined_texts():
    rng = random.Random(8)
    fronts = [bytes(rng.randrange(256) for _ in range(rng.randrange(9))) for _ in range(200)]
    backs = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 7, 300]))) for _ in range(200)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    got = spelling._joined_crc(crc(fronts), crc(backs), np.array([len(b) for b in backs]))
    assert (got == crc([a + b for a, b in zip(fronts, backs)])).all()


def test_pieces_of_long_texts(monkeypatch):
    import pyarrow as pa

    text = "".join(random.Random(9).choice(["ab", "é", " ", "1", "一", "x" * 50]) for _ in range(2000))
    whole = RUN.findall(text)
    monkeypatch.setattr(W, "SLICE", 100)
    got = []
    for _, _, buf, offsets in spelling._pieces(pa.array([text])):
        name, found = W.distinct_words(spelling.runs(buf, offsets))
        got += [found[i].decode() for i in name]
    assert got == whole
