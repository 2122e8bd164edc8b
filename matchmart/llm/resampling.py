"""Target-distribution importance resampling (operator 11).

Documents are drawn as if from the distribution of a target table: a hashed
bucket of words counts by how much more frequent it is in the target than in
the documents, a document weighs the sum over its words, and Gumbel noise from
its id turns the highest scores into a draw without replacement.

* Weights: one pass counts words by bucket (BUCKETS numbers a task leave it),
  the logarithms of the ratios become one array of BUCKETS integers, and a
  second pass scores each text by indexing that array.
* Ranks: a distributed radix sort, least significant digit first. The composite
  key (score down, id up) is cut into digits. A pass counts (block, digit)
  pairs, where a block is a run of consecutive positions; the counts' prefix
  sums over (digit, block) give where the rows of each pair begin, and a row
  goes there plus its place in its pair. Passes are stable, so after the last
  the position is the rank. No task sees more than a block of one digit, so a
  digit that all rows share is no hot key; digits in which no two rows differ
  have no pass.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import words as W
from matchmart.llm.common import dropped, shuffle_width, staged, table

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
#: Bits of a digit: a block's counts are 2**DIGIT rows at most.
DIGIT = 10
#: Rows of a block, at most; a table smaller than this for each shuffle
#: partition has smaller blocks, so that its passes run in parallel.
BLOCK = 1 << 20

#: Digits, a-z and all bytes of longer code points, after lower-casing A-Z.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True


def _buckets(column: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, words of each of the rows lo:hi, bucket of each word), in pieces."""
    for lo, hi, buf, offsets in W.text_pieces(column, _INSIDE):
        words = W.find_words(buf, offsets, lower=True, inside=_INSIDE)
        name, found = W.distinct_words(words)
        crc = np.fromiter(map(zlib.crc32, found), np.int64, len(found))
        yield lo, hi, words.counts, crc[name] % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Words in each bucket, over all of the ``text`` column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, bucket in _buckets(batch.column(0), buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = [0] * buckets
    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in found.collect():  # one row a bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: list[int], target: list[int]) -> np.ndarray:
    """What one word of each bucket adds to a weight: floored thousandths of the
    log ratio of its frequencies, each count plus one."""
    s, t, k = float(sum(raw)), float(sum(target)), len(raw)
    return np.array(
        [math.floor(1000 * math.log((b + 1.0) * (s + k) / ((a + 1.0) * (t + k)))) for a, b in zip(raw, target)], np.int64
    )


def noise(seed: int = SEED) -> Column:
    """Gumbel noise of a row in thousandths, from the hash of its id ("null" without one)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            weight = np.zeros(len(batch), np.int64)
            for lo, hi, counts, bucket in _buckets(batch.column(1), len(gain)):
                n[lo:hi] += counts
                total = np.concatenate([[0], np.cumsum(gain[bucket])])
                ends = np.cumsum(counts)
                weight[lo:hi] += total[ends] - total[ends - counts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(weight)], names=["doc_id", "n_features", "weight"]
            )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, "doc_id long, n_features long, weight long")


def _digits(rows: DataFrame) -> list[Column]:
    """The digits of the key (score down, doc_id up, null ids last), the least
    significant first, as far as rows differ in them."""
    low, high, first, last, some, nulls = rows.agg(
        F.min("score"), F.max("score"), F.min("doc_id"), F.max("doc_id"),
        F.count("doc_id"), F.max(F.col("doc_id").isNull().cast("int")),
    ).first()
    parts: list[tuple[Column, int]] = []
    if some:
        if first < 0:  # the span may not fit in a long: flip the sign bit instead
            parts.append((F.coalesce("doc_id", F.lit(0)).bitwiseXOR(F.lit(-(1 << 63))), 64))
        else:
            parts.append((F.coalesce("doc_id", F.lit(first)) - F.lit(first), (last - first).bit_length()))
    if nulls and some:
        parts.append((F.col("doc_id").isNull().cast("long"), 1))
    if low is not None:
        parts.append((F.lit(high) - F.col("score"), (high - low).bit_length()))
    mask = (1 << DIGIT) - 1
    return [
        F.shiftrightunsigned(value, at).bitwiseAND(F.lit(mask)).cast("int")
        for value, bits in parts
        for at in range(0, bits, DIGIT)
    ]


def _pass(rows: DataFrame, digit: Column, block: int) -> DataFrame:
    """One stable counting-sort pass: ``pos`` becomes the place by ``digit``,
    rows of one digit staying in their order."""
    dealt = rows.withColumn("__digit", digit).withColumn("__block", F.expr(f"pos div {block}L"))
    counts = staged(dealt.groupBy("__digit", "__block").agg(F.count(F.lit(1)).alias("n")), "radix-counts")
    # At most 2**DIGIT totals: where each digit's rows begin.
    begin, at = {}, 0
    for row in counts.groupBy("__digit").agg(F.sum("n").alias("n")).orderBy("__digit").collect():
        begin[row["__digit"]] = at
        at += row["n"]
    # One string is quick to send; the plan folds the cast to an array literal.
    begins = F.split(F.lit(",".join(str(begin.get(d, 0)) for d in range(1 << DIGIT))), ",").cast("array<bigint>")
    before = counts.select(
        "__digit",
        "__block",
        (F.expr("sum(n) OVER (PARTITION BY __digit ORDER BY __block) - n") + F.get(begins, F.col("__digit"))).alias("__at"),
    )
    placed = dealt.withColumn("__i", F.expr("row_number() OVER (PARTITION BY __digit, __block ORDER BY pos) - 1"))
    placed = placed.join(before, ["__digit", "__block"])
    out = staged(placed.select(*[c for c in rows.columns if c != "pos"], (F.col("__at") + F.col("__i")).alias("pos")), "radix")
    dropped(counts)
    return out


def ranked_by_score(rows: DataFrame) -> DataFrame:
    """Adds ``pos``: the place of each row from 0, by score (highest first), then
    doc_id. Rows equal in both may swap places. ``rows`` must be staged."""
    n = rows.count()
    block = max(1, min(BLOCK, n // (2 * shuffle_width(rows.sparkSession))))
    # Any order to begin with, but one that stays: by the place in the written files.
    now = staged(rows.withColumn("pos", F.monotonically_increasing_id()), "radix")
    for digit in _digits(rows) or [F.lit(0)]:  # a pass also closes the gaps
        after = _pass(now, digit, block)
        dropped(now)
        now = after
    return now


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank, all long.

    Reads ``doc_id`` and ``text`` of ``docs`` and ``text`` of ``target``. Of the
    N rows with at least ``min_words`` words, the floor(percent * N / 100) of
    the highest scores have ranks 1, 2, 3...; all others have none. Null and
    empty texts have no words and the weight 0; an empty target counts no words
    (every gain follows from the added ones); null ids share the noise of "null"
    and come last among ties; repeated rows are rows of their own; an empty
    table gives no rows.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = staged(weights(docs, gain).withColumn("score", F.col("weight") + noise(seed)), "scores")
    enough = F.col("n_features") >= min_words
    wanted = staged(scored.where(enough), "scored-eligible")
    drawn = percent * wanted.count() // 100
    order = ranked_by_score(wanted)
    dropped(wanted)
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1).cast("long")
    names = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~enough).select(*names, F.lit(None).cast("long").alias("rank"))
    return order.select(*names, rank.alias("rank")).unionAll(rest)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH steps AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda c, _:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
raw AS (
  SELECT row_number() OVER () AS i, doc_id, FALSE AS target, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM documents
  UNION ALL
  SELECT NULL, NULL, TRUE, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
  FROM benchmark),
hashed AS (
  SELECT word, xor(4294967295, list_reduce([4294967295] || list_transform(
      regexp_extract_all(hex(encode(word)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM raw), steps),
counts AS (
  SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM raw JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts)::DOUBLE + {BUCKETS})
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts)::DOUBLE + {BUCKETS}))))::BIGINT AS gain FROM counts),
sums AS (
  SELECT i, count(*) AS n, sum(gain)::BIGINT AS weight FROM raw JOIN hashed USING (word) JOIN gains USING (bucket)
  WHERE NOT target GROUP BY i),
scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS i, doc_id FROM documents) d LEFT JOIN sums USING (i)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= {MIN_WORDS}
    AND place <= {PERCENT} * (SELECT count(*) FROM scored WHERE n_features >= {MIN_WORDS}) // 100 THEN place END AS rank
FROM placed
"""
