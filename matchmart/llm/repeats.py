"""Substring dedup by recompression (operator 7).

Words covered by a window of 35 words that also begins anywhere else go.

Recompression names, round by round, pairs of equal neighbours and pairs of
different neighbours of which the left falls into one half of all names and the
right into the other. Whether two neighbours join depends on the two alone, so
equal passages get the same names but for a few at their ends. A name is a
64-bit function of what it joins, so all tasks agree on it without a shuffle.
Names never span more than 2 words after the first round, 4 after the second,
and only words are joined as equals, so of any 35 equal words at least
35 - 2 * (2 + 1 + 3) = 23 in the middle are named alike wherever they stand.

1. Anchors are sequences of second-round names of 8 to 11 words, thinned to the
   smallest in every 13 places: every 35 equal words have a common anchor.
   One shuffle finds the anchors that occur twice.
2. Windows near such anchors are verified by 96 bits of their 35 words, again
   in one shuffle. (Windows in which one word stands three times running may
   have no anchor; they are verified in any case.)
3. Only documents with such windows are read again, to drop the words.

What occurs twice within a batch is settled there and sends one entry on, so a
passage that a third of all documents share puts at most one entry a batch into
the task of its key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import words as W
from matchmart.llm.common import dropped, shuffle_width, staged, table

WINDOW = 35
CAPS = (2, 4)  # most words of a name, by round
END_LOSS = 2 + 1 + 3  # words at either end of equal words that may be named apart
ANCHOR = 8  # least words of an anchor
PLACES = WINDOW - 2 * END_LOSS - (ANCHOR + CAPS[-1] - 1) + 1
RUN = 3  # so many equal words running have no certain anchor

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def named(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, first word, row) of the second round's names of a slice."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    name, begin, span = hashes, np.arange(len(hashes)), np.ones(len(hashes), np.int64)
    # Words: exactly two equal ones in a row.
    same = np.zeros(len(name) + 1, bool)
    same[1:-1] = (name[1:] == name[:-1]) & (rows[1:] == rows[:-1])
    if len(name):
        # same[i]: word i equals the one before; a run of two begins at i where
        # same is (no, yes, no) at i, i + 1, i + 2.
        after = np.append(same[2:], False)
        name, begin, span, rows = _join(name, begin, span, rows, ~same[:-1] & same[1:] & ~after, salt=1)
    for round_, cap in enumerate(CAPS):
        if len(name) < 2:
            break
        left = (W.mix(name ^ np.uint64(0xA5A5 + round_)) & np.uint64(1)).astype(bool)
        joins = left[:-1] & ~left[1:] & (rows[:-1] == rows[1:]) & (span[:-1] + span[1:] <= cap)
        name, begin, span, rows = _join(name, begin, span, rows, np.append(joins, False), salt=2 + round_)
    return name, begin, rows


def _join(name, begin, span, rows, at, salt: int):
    """Join each name where ``at`` holds with the next one."""
    second = np.concatenate([[False], at[:-1]])
    i = np.flatnonzero(at)
    name, span = name.copy(), span.copy()
    name[i] = W.mix(name[i] * np.uint64(W._BASE) + W.mix(name[i + 1] + np.uint64(salt)))
    span[i] += span[i + 1]
    keep = ~second
    return name[keep], begin[keep], span[keep], rows[keep]


def anchors(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, first word) of the thinned anchors of the rows of a slice."""
    name, begin, rows = named(hashes, first)
    n = len(hashes)
    if n < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # An anchor ends with the first name that brings it to ANCHOR words.
    ends = np.append(begin[1:], n)
    stop = np.searchsorted(ends, begin + ANCHOR)
    long_enough = np.diff(first)[rows] >= WINDOW
    good = (stop < len(name)) & long_enough
    good[good] &= rows[stop[good]] == rows[good]
    i = np.flatnonzero(good)
    value = np.zeros(len(i), np.uint64)
    size = stop[i] - i + 1
    for j, p in enumerate(W.powers(int(size.max(initial=0)) + 1)[1:]):
        part = size > j
        value[part] += name[i[part] + j] * p
    value = W.mix(value + size.astype(np.uint64))
    at = np.full(n + PLACES, 2**64 - 1, np.uint64)
    at[begin[i]] = value
    least = np.lib.stride_tricks.sliding_window_view(at, PLACES)[:n].argmin(axis=1) + np.arange(n)
    least = np.unique(least)
    least = least[least < n]
    least = least[at[least] != np.uint64(2**64 - 1)]
    return at[least], least


def running(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """First words of windows of a slice that hold a word RUN times running."""
    starts = W.inside_rows(first, WINDOW)
    if len(hashes) < RUN or not len(starts):
        return starts[:0]
    run = (hashes[2:] == hashes[1:-1]) & (hashes[1:-1] == hashes[:-2])
    total = np.concatenate([[0], np.cumsum(run)])
    return starts[total[np.minimum(starts + WINDOW - RUN + 1, len(run))] > total[starts]]


def text_keys(words: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of the word sequence of each row."""
    out = []
    for base in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5):
        n = words.counts
        place = np.arange(len(hashes)) - np.repeat(words.first[:-1], n)
        value = hashes * W.powers(int(n.max(initial=0)), base)[place] if len(hashes) else hashes
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        sums = total[words.first[1:]] - total[words.first[:-1]]
        out.append(W.mix(sums + n.astype(np.uint64) * np.uint64(base)))
    return out[0], out[1]


def _sliced(column: pa.Array):
    for lo, hi, buf, offsets in W.text_slices(column):
        words = W.find_words(buf, offsets)
        hashes = W.word_hashes(words)
        yield lo, hi, words, hashes, *text_keys(words, hashes)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, words, hashes, a, b in _sliced(batch.column(1)):
            sha = [hashlib.sha256(b" ".join(words.text(r).split())).hexdigest() for r in range(hi - lo)]
            runs = np.zeros(hi - lo, bool)
            runs[words.rows()[running(hashes, words.first)]] = True
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    pa.array(sha),
                    pa.array(runs),
                ],
                names=["doc_id", "n_words", "a", "b", "sha", "runs"],
            )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, _, _, a, b in _sliced(batch.column(0)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), batch.column(0).slice(lo, hi - lo)],
                names=["a", "b", "text"],
            )


# --- what occurs twice --------------------------------------------------------

_ENTRY = np.dtype([("h", "<u8"), ("g", "<u4"), ("a", "<i8"), ("b", "<i8"), ("at", "<i4")])
_ENTRIES = "bucket int, settled boolean, h binary, g binary, a binary, b binary, at binary, known binary"


def _pack(bucket: int, settled: bool, e: np.ndarray, known: np.ndarray) -> tuple:
    return (bucket, settled, *(e[c].tobytes() for c in _ENTRY.names), known.tobytes())


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    e = np.empty(len(row["at"]) // 4, _ENTRY)
    for c in _ENTRY.names:
        e[c] = np.frombuffer(row[c], _ENTRY[c])
    return e, np.frombuffer(row["known"], bool)


def _twice(e: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct entries, whether each one's hash occurs at two places or
    is known to, whether each is its hash's first entry)."""
    order = np.lexsort((e["at"], e["b"], e["a"], e["g"], e["h"]))
    e, known = e[order], known[order]
    head = np.ones(len(e), bool)
    head[1:] = (e["h"][1:] != e["h"][:-1]) | (e["g"][1:] != e["g"][:-1])
    fresh = head.copy()
    fresh[1:] |= (e["a"][1:] != e["a"][:-1]) | (e["b"][1:] != e["b"][:-1]) | (e["at"][1:] != e["at"][:-1])
    group = np.cumsum(head) - 1
    if len(e):
        many = np.bincount(group, fresh) > 1
        many |= np.bincount(group, known) > 0
        many = many[group]
    else:
        many = head
    return e[fresh], many[fresh], head[fresh]


def _dealt(e: np.ndarray, buckets: int, turn: int) -> Iterator[tuple]:
    """The rows of a batch: what is settled, to any bucket, and one entry a hash
    to the bucket of its hash."""
    e, many, head = _twice(e, np.zeros(len(e), bool))
    if many.any():
        yield _pack(turn % buckets, True, e[many], np.ones(int(many.sum()), bool))
    one, known = e[head], many[head]
    bucket = ((one["h"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield _pack(int(bucket[part[0]]), False, one[part], known[part])


def _met(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
    """The places of a bucket whose hash occurs at two places at least."""
    rows = found.to_pylist()
    done = [_unpack(r)[0] for r in rows if r["settled"]]
    open_ = [_unpack(r) for r in rows if not r["settled"]]
    if open_:
        e, many, _ = _twice(np.concatenate([x for x, _ in open_]), np.concatenate([k for _, k in open_]))
        done.append(e[many])
    e = np.concatenate(done) if done else np.zeros(0, _ENTRY)
    return pa.table({"a": e["a"].copy(), "b": e["b"].copy(), "at": e["at"].copy()})


def occurring_twice(entries: DataFrame) -> DataFrame:
    """(a, b, at: array of places) of the entries whose hash occurs elsewhere too.

    A bucket holds its part of the hashes, one entry a hash and batch at most,
    so its size falls as the number of buckets grows with the shuffle partitions.
    """
    met = entries.groupBy("bucket").applyInArrow(_met, "a long, b long, at int")
    return met.groupBy("a", "b").agg(F.collect_set("at").alias("at"))


def _entries(buckets: int, find):
    """Rows of entries of each slice; ``find`` gives (h, g, a, b, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            for part in find(batch):
                e = np.empty(len(part[0]), _ENTRY)
                for c, values in zip(_ENTRY.names, part):
                    e[c] = values
                turn += 1
                rows = list(_dealt(e, buckets, hash((turn, int(e["h"][0]) if len(e) else 0))))
                if rows:
                    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                        names=["bucket", "settled", "h", "g", "a", "b", "at", "known"],
                    )

    return run


def _anchor_entries(batch: pa.RecordBatch):
    for _, _, words, hashes, a, b in _sliced(batch.column(0)):
        value, at = anchors(hashes, words.first)
        row = np.searchsorted(words.first, at, "right") - 1
        # Anchors only point out documents: half of the key is enough.
        yield value, 0, a.view(np.int64)[row], 0, at - words.first[row]


def _window_entries(batch: pa.RecordBatch):
    places = batch.column("at").to_pylist()
    for lo, hi, words, hashes, a, b in _sliced(batch.column("text")):
        same = (batch.column("a").slice(lo, hi - lo).to_numpy() == a.view(np.int64)) & (
            batch.column("b").slice(lo, hi - lo).to_numpy() == b.view(np.int64)
        )
        n = len(hashes)
        near = np.zeros(n + 1, np.int64)
        for r in np.flatnonzero(same):
            if places[lo + r]:
                at = np.array(places[lo + r], np.int64) + words.first[r]
                begin = np.maximum(at + ANCHOR - WINDOW, words.first[r])
                np.add.at(near, begin, 1)
                np.add.at(near, np.minimum(at + 1, n), -1)
        near = np.cumsum(near)[:n] > 0
        near[running(hashes, words.first)] = True
        starts = W.inside_rows(words.first, WINDOW)
        starts = starts[near[starts]]
        row = np.searchsorted(words.first, starts, "right") - 1
        starts, row = starts[same[row]], row[same[row]]
        one = W.window_hashes(hashes, WINDOW)[starts] if len(starts) else starts
        two = W.window_hashes(hashes, WINDOW, 0x8CB92BA72F3D8DD7)[starts] if len(starts) else starts
        yield (
            one, two & np.uint64(0xFFFFFFFF) if len(starts) else starts,
            a.view(np.int64)[row], b.view(np.int64)[row], starts - words.first[row],
        )


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = batch.column("at").to_pylist()
        out = []
        for lo, hi, words, _, a, b in _sliced(batch.column("text")):
            for r in range(hi - lo):
                key = (int(a.view(np.int64)[r]), int(b.view(np.int64)[r]))
                if key == (batch.column("a")[lo + r].as_py(), batch.column("b")[lo + r].as_py()):
                    text = words.text(r).split()
                    gone = W.covered(np.array(places[lo + r], np.int64), WINDOW, len(text))
                    kept = b" ".join([t for t, g in zip(text, gone) if not g])
                    out.append((*key, int(gone.sum()), kept.decode()))
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            names=["a", "b", "n_removed", "kept_text"],
        )


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Words keep their order and are joined by one space; ``kept_text`` is null
    where nothing was removed (the document's own words stand) or nothing is
    left. Reads ``doc_id`` and ``text`` only. Null and empty texts have no words
    and lose none; texts under 35 words lose none; texts are read whole,
    however long. Rows of equal words are windows of each other, so both lose
    all (35 words or more), repeated rows too; null ids are rows like any
    other (their texts are told apart by their words); an empty table gives none.
    """
    spark = docs.sparkSession
    buckets = 4 * shuffle_width(spark)
    base = staged(
        docs.select("doc_id", "text").mapInArrow(
            _summary, "doc_id long, n_words long, a long, b long, sha string, runs boolean"
        ),
        "texts",
    )
    texts = base.where(f"n_words >= {WINDOW}").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.max("runs").alias("runs")
    )
    texts = staged(texts, "text-classes")
    entries = docs.select("text").mapInArrow(_entries(buckets, _anchor_entries), _ENTRIES)
    hits = staged(occurring_twice(entries).select("a", "at"), "anchor-hits")
    # One text of each class that has such an anchor, or a word running: by the
    # class's smallest id, or, where all its rows lack one, by its key.
    wanted = texts.join(hits, "a", "left").where("at IS NOT NULL OR runs").select("rep", "a", "b", "at")
    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), "text")
    nameless = docs.where("doc_id IS NULL").select("text").mapInArrow(_keyed, "a long, b long, text string")
    columns = ["text", "a", "b", "at"]
    near = staged(
        named.join(wanted.where("rep IS NOT NULL"), "rep")
        .select(*columns)
        .union(
            nameless.dropDuplicates(["a", "b"]).join(wanted.where("rep IS NULL"), ["a", "b"]).select(*columns)
        ),
        "near-repeats",
    )
    windows = near.mapInArrow(_entries(buckets, _window_entries), _ENTRIES)
    found = staged(occurring_twice(windows), "repeats")
    dropped(hits)
    alone = texts.where("copies = 1").select("a", "b")
    clean = (
        near.select("text", "a", "b")
        .join(alone, ["a", "b"], "left_semi")
        .join(found, ["a", "b"])
        .mapInArrow(_cleaned, "a long, b long, n_removed long, kept_text string")
    )
    clean = staged(clean.dropDuplicates(["a", "b"]), "cleaned")
    dropped(near, found)
    # A union, not a join: both sides of the next join are then shuffled for it
    # alone, so the rows of a large group of copies can be split.
    result = texts.where("copies > 1").selectExpr(
        "a", "b", "copies", "CAST(NULL AS BIGINT) AS n_removed", "CAST(NULL AS STRING) AS kept_text"
    ).union(clean.where("n_removed > 0").selectExpr("a", "b", "1L AS copies", "n_removed", "kept_text"))
    rows = base.join(result, ["a", "b"], "left")
    copied = F.coalesce(F.col("copies"), F.lit(1)) > 1
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(EMPTY_SHA))
        .otherwise(F.coalesce(F.sha2(F.col("kept_text"), 256), F.col("sha")))
        .alias("kept_sha256"),
        F.when(~copied, F.col("kept_text")).alias("kept_text"),
    )


def op7_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS win
  FROM w, unnest(range(1, len(ws) - 33)) AS t(i) WHERE len(ws) >= 35),
r AS (SELECT doc_id, i FROM s WHERE win IN (SELECT win FROM s GROUP BY 1 HAVING count(*) > 1)),
g AS (SELECT DISTINCT doc_id, i + j AS i FROM r, unnest(range(0, 35)) AS t(j)),
k AS (
  SELECT doc_id, i, ws[i] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(i)
  WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = w.doc_id AND g.i = t.i)),
o AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM k GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN o USING (doc_id)
"""
