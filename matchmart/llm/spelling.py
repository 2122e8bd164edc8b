"""Spelling variant grouping (operator 13).

Words at one inserted, deleted or replaced code point from each other are near.
Near words share half of themselves: with k half the length of the shorter (or
of both), either their first k code points are equal, or all after the first k
of the shorter are equal, counted from the end. So

1. every word goes to four blocks: by its beginning and by its end, as a word of
   the block's length and as one that is longer by one code point;
2. inside a block dense tiles decide: two padded code-point matrices, one filled
   from the left and one from the right, give the common prefix and suffix
   of all pairs of a tile at once; a pair is near if their sum reaches the
   longer length minus one. A block of more rows than a tile is dealt to pieces,
   and each pair of pieces is a task's group of bounded size;
3. only near pairs leave a tile. Counts, the best near word and the roots follow
   by grouping and joins; roots by doubling the steps along the forms, whose
   counts at least double, so that a few rounds reach every end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import words as W
from matchmart.llm.common import dropped, staged, table

MIN_LENGTH, MIN_COUNT = 5, 3
#: One occurrence in EVERY, by the hash of document and run, loses a code point.
EVERY = 97
#: Words of a piece of a block, at most.
PIECE = 2048
#: Code points compared at once in a tile.
TILE = 1 << 22

#: Bytes of the runs [A-Za-zÀ-ÿ]: letters, and C3 with what follows it.
_ASCII = np.zeros(256, bool)
_ASCII[0x41:0x5B] = _ASCII[0x61:0x7B] = True
_LETTER = _ASCII.copy()
_LETTER[0xC3] = True
_MULTI = 0xC3


def _inside(buf: np.ndarray) -> np.ndarray:
    """Which bytes of valid UTF-8 belong to runs."""
    inside = _LETTER[buf]
    inside[1:] |= buf[:-1] == _MULTI
    return inside


def runs(buf: np.ndarray, offsets: np.ndarray) -> W.Words:
    """The runs of the texts of a slice, lower-cased in A-Z. Bytes outside runs
    become spaces, so that runs are words."""
    return W.find_words(np.where(_inside(buf), buf, 0x20), offsets, lower=True)


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, buf, offsets); a long text comes in pieces cut at ASCII characters
    that are no letters, or elsewhere outside runs."""
    for lo, hi, buf, offsets in W.text_slices(column):
        if len(buf) <= W.SLICE:
            yield lo, hi, buf, offsets
            continue
        between = np.where(_inside(buf), np.uint8(1), np.uint8(0))
        flags = np.zeros(256, bool)
        flags[1] = True
        for begin, end in W.cuts(between, flags, W.SLICE):
            yield lo, hi, buf[begin:end], np.array([0, end - begin])


def _joined_crc(front: np.ndarray, back: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The checksums of texts joined of two, from those of both and the bytes of
    the second: crc(a + b) = shift(crc(a), len(b)) ^ crc(b), and shift is linear."""
    sizes, which = np.unique(size, return_inverse=True)
    out = back.copy()
    for i, n in enumerate(sizes.tolist()):
        rows = np.flatnonzero(which == i)
        zero = zlib.crc32(bytes(n))
        # What each value of each byte becomes, built up bit by bit.
        table = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for b in range(8):
                step = 1 << b
                table[byte, step : 2 * step] = table[byte, :step] ^ np.uint32(zlib.crc32(bytes(n), 1 << (8 * byte + b)) ^ zero)
        x = front[rows]
        out[rows] ^= table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]
    return out


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, every: int = EVERY) -> DataFrame:
    """(word, n): how often each word of at least ``min_length`` code points
    occurs after the deletions, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ["null" if i is None else str(i) for i in batch.column(0).to_pylist()]
            fronts = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
            for lo, hi, buf, offsets in _pieces(batch.column(1)):
                words = runs(buf, offsets)
                name, found = W.distinct_words(words)
                if not found:
                    continue
                back = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
                crc = _joined_crc(fronts[lo:hi][words.rows()], back[name], (words.end - words.start))
                spelt = [w.decode() for w in found]
                hit = crc % np.uint32(every) == 0
                counts = dict(zip(spelt, np.bincount(name[~hit], minlength=len(found)).tolist()))
                for i, h in zip(name[hit].tolist(), crc[hit].tolist()):
                    word = spelt[i]
                    cut = h % len(word)
                    word = word[:cut] + word[cut + 1 :]
                    counts[word] = counts.get(word, 0) + 1
                counts = {w: n for w, n in counts.items() if n and len(w) >= min_length}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
                )

    rows = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def blocks(words: DataFrame) -> DataFrame:
    """(side, size, half, word, long): the four blocks of each word. ``size`` is
    the length of the block's shorter words; ``long`` tells the longer ones."""
    length = F.char_length("word")
    rows = words.select("word", F.explode(F.array(F.lit(0), F.lit(1))).alias("long"), length.alias("__l"))
    rows = rows.withColumn("size", F.col("__l") - F.col("long"))
    k = F.expr("size div 2")
    begin = F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), k).alias("half"))
    end = F.struct(F.lit(1).alias("side"), F.right("word", F.col("size") - k).alias("half"))
    rows = rows.withColumn("__b", F.explode(F.array(begin, end)))
    return rows.select("__b.side", "size", "__b.half", "word", "long")


def _matrix(words: list[str], width: int, left: bool) -> np.ndarray:
    """Code points in rows, padded with 0 on the right or on the left."""
    pad = str.ljust if left else str.rjust
    joined = "".join(pad(w, width, "\0") for w in words)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of leading columns in which row i of ``a`` equals row j of ``b``."""
    same = a[:, None, :] == b[None, :, :]
    first = np.argmin(same, axis=2)
    first[same.all(axis=2)] = a.shape[1]
    return first


def near_in_tile(a: list[str], b: list[str], size: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of the near pairs of ``a`` (words of ``size`` code points)
    and ``b`` (``size`` or one more, all alike). Pairs whose common prefix
    reaches ``skip`` are left out (another block has them)."""
    if not a or not b:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    longer = len(b[0])
    left = [_matrix(x, longer, True) for x in (a, b)]
    right = [_matrix(x, longer, False)[:, ::-1] for x in (a, b)]
    step = max(1, TILE // (longer * len(b)))
    cols = max(1, min(len(b), TILE // longer))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(0, len(a), step):
        for j in range(0, len(b), cols):
            prefix = np.minimum(_common(left[0][i : i + step], left[1][j : j + cols]), size)
            suffix = np.minimum(_common(right[0][i : i + step], right[1][j : j + cols]), size)
            # Equal words have a prefix of their whole length.
            near = (prefix + suffix >= longer - 1) & (prefix < longer) & (prefix < skip)
            x, y = np.nonzero(near)
            found.append((x + i, y + j))
    return tuple(np.concatenate(part) for part in zip(*found))


def near_pairs(words: DataFrame, piece: int = PIECE) -> DataFrame:
    """(word, near): every near pair of the distinct ``word`` values, both ways round."""
    key = ["side", "size", "half"]
    dealt = blocks(words)
    # Blocks in which only longer words lie have no pairs; large ones are cut in pieces.
    sizes = dealt.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min("long").alias("__least"))
    sizes = sizes.where("__n > 1 AND __least = 0").select(*key, F.expr(f"(__n - 1) div {piece} + 1").alias("pieces"))
    dealt = dealt.join(sizes, key)
    own = F.pmod(F.xxhash64("word"), F.col("pieces"))
    # Piece p meets every piece q: as the first of a pair for q >= p, else the second.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    dealt = dealt.withColumn("__p", own).withColumn("__q", other)
    dealt = dealt.select(
        *key, "word", "long",
        F.least("__p", "__q").alias("one"), F.greatest("__p", "__q").alias("two"),
        (F.col("__p") > F.col("__q")).alias("second"),
    )

    def run(group: tuple, part: pa.Table) -> pa.Table:
        side, size, _, one, two = (x.as_py() for x in group)
        skip = size // 2 if side else size + 2
        word, long, second = (part.column(c).to_pylist() for c in ("word", "long", "second"))
        cells: dict[tuple, list[str]] = {}
        for w, is_long, is_second in zip(word, long, second):
            cells.setdefault((is_long, is_second), []).append(w)
        get = lambda is_long, is_second: cells.get((is_long, is_second), [])
        first, last = (False, False) if one == two else (False, True)
        # Replaced: words of the same length, each pair of them once.
        jobs = [(get(0, first), get(0, last), one == two), (get(0, first), get(1, last), False)]
        if one != two:
            jobs.append((get(0, last), get(1, first), False))
        left, right = [], []
        for a, b, alike in jobs:
            x, y = near_in_tile(a, b, size, skip)
            if alike:
                x, y = x[x < y], y[x < y]
            left += [a[i] for i in x.tolist()]
            right += [b[j] for j in y.tolist()]
        return pa.table({"word": pa.array(left + right, pa.string()), "near": pa.array(right + left, pa.string())})

    return dealt.groupBy(*key, "one", "two").applyInArrow(run, "word string, near string")


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) with ``root``: where following forms ends. Each
    round doubles the steps; forms must not lead in a circle."""
    now = staged(forms.withColumn("root", F.coalesce("form", "word")), "roots")
    while True:
        hop = now.where("form IS NOT NULL").select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        ahead = now.join(hop, now["root"] == hop["__w"], "left")
        new = staged(
            ahead.select(*forms.columns, F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("__moved")),
            "roots",
        )
        moved = not new.where("__moved").isEmpty()
        dropped(now)
        path, now = new.staged_path, new.drop("__moved")
        now.staged_path = path
        if not moved:
            return now


def group_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words and their counts.

    A word's form is its near word of the largest n (ties: the smallest in
    code-point order) if that n is at least twice the word's. Words without
    near words, and an empty table, are fine: no form, the word as root, n_near 0.
    """
    words = staged(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words)
    # Smallest (-n, word): the largest count, then the first in byte order, which
    # is code-point order in UTF-8.
    count = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        pairs.join(count, "near")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("__best"))
    )
    formed = words.join(best, "word", "left")
    has = (-F.col("__best.m")) >= 2 * F.col("n")
    formed = formed.select(
        "word",
        F.when(has, F.col("__best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, -F.col("__best.m")).alias("form_n"),
    )
    return roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = EVERY
) -> DataFrame:
    """One row per word: word, form, root (string), n, n_near, form_n (long).

    Words are the runs of letters of all texts, lower-cased in A-Z, of which one
    occurrence in ``every`` has lost a code point, as far as they have
    ``min_length`` code points and occur ``min_count`` times. Reads ``doc_id``
    and ``text`` only. A null or empty text has no words; a null id hashes as
    "null"; repeated rows count again; an empty table gives no rows.
    """
    return group_variants(word_counts(docs, min_length, every).where(F.col("n") >= min_count))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda c, _:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
raw AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
lowered AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM raw GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(
      regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) AS h
  FROM lowered, steps),
spelt AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, n FROM hashed),
v AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) AS t(p)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, coalesce(form, word) AS spot, form IS NULL AS done FROM formed
  UNION ALL
  SELECT w.word, coalesce(f.form, w.spot), f.form IS NULL FROM walk w JOIN formed f ON w.spot = f.word WHERE NOT w.done)
SELECT f.word, form, spot AS root, n, n_near, form_n FROM formed f JOIN walk w ON f.word = w.word AND w.done
"""
