"""MinHash near-dedup (operator 2).

A document's set is its distinct 5-word shingles, words lower-cased in A-Z.
Documents with 100 * common >= 75 * union are linked, and links make groups.

1. One pass over the texts signs each set: 300 universal hash minima, banded by
   6 into 50 bands. Two sets at similarity 0.75 share no band with probability
   5e-5, at 0.8 with 3e-7. Equal sets collapse to their smallest id.
2. Per band bucket every member is paired with the bucket's smallest id (not
   with each other). Pairs whose signatures agree too little are dropped; of
   the rest, the full sets decide.
3. Components by large-star and small-star. Buckets whose members still lie in
   different components are compared on, first the remaining pairs with the
   smallest id, then pairs across components: a pair is compared unless it is
   already in one component or the sets' profiles (how many shingles fall into
   each of 128 classes) show that too few can be common. Profiles are compared
   in dense tiles of bounded size, and only what they leave comes out. So no
   link between different texts is lost, and a group of similar documents never
   makes all its pairs.

Sets travel only for the documents of surviving pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import words as W
from matchmart.llm.common import dropped, staged, table
from matchmart.llm.components import components

SHINGLE = 5
BANDS, ROWS = 50, 6
#: Linked when 100 * common >= PERCENT * union.
PERCENT = 75
#: Least agreeing bytes of two signatures of BANDS * ROWS bytes. Sets at 0.75
#: agree in 225 of 300 (standard deviation 7.5); six deviations below.
LEAST_AGREEING = 180

PROFILE = 128  # classes of shingles
PIECE, TILE = 2048, 512  # rows of a piece of a bucket, and compared at a time

_seeds = np.random.default_rng(11)
_MULTIPLY = _seeds.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _seeds.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_BLOCK = 4096  # shingles hashed at a time


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text of a slice. A text
    of one to four words has its whole sequence as its one shingle."""
    words = W.find_words(buf, offsets, lower=True)
    hashes = W.word_hashes(words)
    windows = W.window_hashes(hashes, SHINGLE)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= SHINGLE:
            yield np.unique(windows[a : b - SHINGLE + 1])
        elif b > a:
            yield W.window_hashes(hashes[a:b], b - a)
        else:
            yield windows[:0]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash x -> a * x + b (mod 2**64)."""
    out = np.full(len(_MULTIPLY), 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), _BLOCK):
        x = shingles[i : i + _BLOCK]
        for lo in range(0, len(_MULTIPLY), 50):
            block = _MULTIPLY[lo : lo + 50, None] * x
            block += _ADD[lo : lo + 50, None]
            np.minimum(out[lo : lo + 50], block.min(axis=1), out=out[lo : lo + 50])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key a band (the band's number goes into it)."""
    rows = W.mix(signature).reshape(BANDS, ROWS)
    weights = W.powers(ROWS + 1)[1:]
    return W.mix((rows * weights).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offsets in W.text_slices(batch.column(1)):
            size, one, two, keys, bytes_ = [], [], [], [], []
            for s in shingle_sets(buf, offsets):
                size.append(len(s))
                one.append(s.sum(dtype=np.uint64) if len(s) else np.uint64(0))
                two.append(W.mix(s).sum(dtype=np.uint64) if len(s) else np.uint64(0))
                m = minima(s) if len(s) else None
                keys.append(band_keys(m).tobytes() if len(s) else None)
                bytes_.append((W.mix(m) & np.uint64(255)).astype(np.uint8).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    batch.column(2).slice(lo, hi - lo),
                    pa.array(size, pa.int64()),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.array(keys, pa.binary()),
                    pa.array(bytes_, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "bands", "signature"],
            )
        W.release()


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, n_shingles, two checksums of the set, band
    keys, signature bytes."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _signed,
        "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands binary, signature binary",
    )


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, BANDS)), pa.array(keys)], names=["x", "band"]
        )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
            for c in ("sign_x", "sign_y")
        )
        good = (left == right).sum(axis=1) >= LEAST_AGREEING
        yield batch.select(["x", "y", "m"]).filter(pa.array(good))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offsets in W.text_slices(batch.column(1)):
            sets = [s.tobytes() for s in shingle_sets(buf, offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["id", "shingles"]
            )


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            sets = [np.frombuffer(s.as_py(), np.uint64) for s in part.column(1)]
            counts = [
                np.bincount((s >> np.uint64(40)).astype(np.int64) % PROFILE, minlength=PROFILE).astype("<i4").tobytes()
                for s in sets
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(counts, pa.binary())],
                names=["x", "n", "profile"],
            )


def _possible(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
    """The pairs of a tile, of different components, whose profiles allow for enough
    common shingles: two sets share at most the sum of the smaller counts."""
    _, one, two = (k.as_py() for k in key)
    x, c, n = (part.column(name).to_numpy() for name in ("x", "c", "n"))
    profile = np.frombuffer(b"".join(part.column("profile").to_pylist()), "<i4").reshape(-1, PROFILE)
    second = part.column("second").to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(~second)
    others = rows if one == two else np.flatnonzero(second)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(rows), TILE):
        a = rows[i : i + TILE]
        for j in range(0, len(others), TILE):
            b = others[j : j + TILE]
            most = np.zeros((len(a), len(b)), np.int32)
            for k in range(PROFILE):
                most += np.minimum(profile[a, k][:, None], profile[b, k][None, :])
            good = (100 + PERCENT) * most.astype(np.int64) >= PERCENT * (n[a][:, None] + n[b][None, :])
            good &= c[a][:, None] != c[b][None, :]
            if one == two:
                good &= x[a][:, None] < x[b][None, :]  # each pair of the piece once
            p, q = np.nonzero(good)
            left.append(np.minimum(x[a[p]], x[b[q]]))
            right.append(np.maximum(x[a[p]], x[b[q]]))
    return pa.table({"x": np.concatenate(left), "y": np.concatenate(right)})


def possible_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (x, y) of the members (band, x, c, n, profile) of each bucket
    that ``_possible`` leaves. A bucket is dealt to pieces of some ``PIECE`` rows,
    and each pair of pieces is one group, so a group's size is bounded and the
    evaluations of a large bucket are spread over tasks."""
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select("band", F.expr(f"(size - 1) div {PIECE} + 1").alias("pieces"))
    dealt = members.join(sizes, "band")
    dealt = dealt.withColumn("__p", F.pmod(F.xxhash64("x", "band"), F.col("pieces")))
    dealt = dealt.withColumn("__q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    dealt = dealt.select(
        "band", "x", "c", "n", "profile",
        F.least("__p", "__q").alias("one"), F.greatest("__p", "__q").alias("two"),
        (F.col("__p") > F.col("__q")).alias("second"),
    )
    return dealt.groupBy("band", "one", "two").applyInArrow(_possible, "x long, y long").distinct()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for a, b in zip(batch.column("set_x"), batch.column("set_y")):
            a, b = (np.frombuffer(z.as_py(), np.uint64) for z in (a, b))
            common = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield batch.select(["x", "y"]).filter(pa.array(good, pa.bool_()))


class _Groups:
    """The confirmed links so far, and what a comparison needs."""

    def __init__(self, docs: DataFrame, reps: DataFrame):
        self.docs, self.reps, self.links = docs, reps, []

    def sets(self, ids: DataFrame, name: str) -> DataFrame:
        """(id, shingles) of the distinct ids of a column ``id``, staged."""
        needed = staged(ids.distinct(), f"{name}-ids")
        texts = self.docs.select(F.col("doc_id").alias("id"), "text").join(needed, "id", "left_semi")
        # Of rows that repeat an id, one.
        found = staged(texts.mapInArrow(_sets, "id long, shingles binary").dropDuplicates(["id"]), f"{name}-sets")
        dropped(needed)
        return found

    def compare(self, pairs: DataFrame, name: str, pick: bool = False, sets: DataFrame | None = None) -> DataFrame:
        """Compare the distinct pairs (x, y, m); returns the signature-checked
        ones, staged. ``pick``: confirm only the best pair of each x."""
        sign = self.reps.select(F.col("doc_id").alias("id"), "signature")
        near = staged(
            pairs.join(sign.withColumnsRenamed({"id": "x", "signature": "sign_x"}), "x")
            .join(sign.withColumnsRenamed({"id": "y", "signature": "sign_y"}), "y")
            .select("x", "y", "m", "sign_x", "sign_y")
            .mapInArrow(_agreeing, "x long, y long, m long"),
            f"{name}-near",
        )
        chosen = near
        if pick:
            # The y with most bands, then the smallest: plain longs, so the
            # aggregate pre-combines a hot x or y before the shuffle.
            top = near.groupBy("x").agg(F.max("m").alias("m"))
            chosen = near.join(top, ["x", "m"]).groupBy("x").agg(F.min("y").alias("y"))
        own = sets is None
        if own:
            sets = self.sets(chosen.select(F.explode(F.array("x", "y")).alias("id")), name)
        links = staged(
            chosen.select("x", "y")
            .join(sets.withColumnsRenamed({"id": "x", "shingles": "set_x"}), "x")
            .join(sets.withColumnsRenamed({"id": "y", "shingles": "set_y"}), "y")
            .select("x", "y", "set_x", "set_y")
            .mapInArrow(_linked, "x long, y long"),
            f"{name}-links",
        )
        if own:
            dropped(sets)
        self.links.append(links)
        return near

    def components(self) -> DataFrame:
        edges = self.links[0]
        for more in self.links[1:]:
            edges = edges.union(more)
        return staged(components(edges.selectExpr("x AS u", "y AS v")), "components")


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (x, y, ...) whose ends lie in different components."""
    side = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    return (
        pairs.join(side("x"), "x", "left")
        .join(side("y"), "y", "left")
        .where("coalesce(cx, x) <> coalesce(cy, y)")
        .drop("cx", "cy")
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Reads ``doc_id`` and ``text`` only. Null and empty texts and texts without
    words have no shingles and are linked with nothing; a text is taken whole,
    however long. ``component_id`` is the smallest doc_id reachable, and
    ``kept`` says that it is the row's own. Rows with a null id stay unlinked
    (null component, kept). Rows that repeat an id should repeat its text too:
    equal sets link by their checksums; a larger comparison of such an id uses
    one of its texts. An empty table gives no rows.
    """
    return _grouped(docs).drop("text_hash")


def _grouped(docs: DataFrame) -> DataFrame:
    """The rows of ``near_dedup`` with a hash of the text."""
    feats = staged(signed(docs), "signatures")
    real = feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staged(
        real.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep")), "set-classes"
    )
    reps = real.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    reps = staged(reps.dropDuplicates(["doc_id"]).select("doc_id", "bands", "signature"), "set-reps")

    bands = reps.select("doc_id", "bands").mapInArrow(_banded, "x long, band long")
    buckets = bands.groupBy("band").agg(F.min("x").alias("y"), F.count(F.lit(1)).alias("n"))
    # Members of buckets with company; a bucket's hot rows are split by the join.
    members = staged(bands.join(buckets.where("n > 1"), "band").select("band", "x", "y"), "bucket-members")

    groups = _Groups(docs, reps)
    pairs = members.where("x <> y").groupBy("x", "y").agg(F.count(F.lit(1)).alias("m"))
    near = groups.compare(pairs, "best", pick=True)
    comps = groups.components()

    second = groups.compare(_across(near, comps), "rest")
    dropped(near, second, comps)
    comps = groups.components()

    labelled = members.join(comps.withColumnRenamed("node", "x"), "x", "left").selectExpr(
        "band", "x", "y", "coalesce(component, x) AS c"
    )
    mixed = labelled.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    open_ = staged(labelled.join(mixed.select("band"), "band", "left_semi"), "mixed-buckets")
    # Two sets share at most the sum of the smaller counts of their profiles.
    sets = groups.sets(open_.select(F.col("x").alias("id")), "open")
    profile = sets.mapInArrow(_profiles, "x long, n long, profile binary")
    left = staged(open_.drop("y").join(profile, "x"), "open-members")
    cross = possible_pairs(left)
    third = groups.compare(cross.withColumn("m", F.lit(1).cast("long")), "cross", sets=sets)
    dropped(third, comps, members, sets, left)
    comps = groups.components()
    dropped(open_, reps, *groups.links)

    # Ids of sets, then ids of components: both joins are on unique keys.
    rows = feats.select("doc_id", "text_hash", "n_shingles", "set_a", "set_b").join(
        classes, ["set_a", "set_b", "n_shingles"], "left"
    )
    rows = rows.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = (
        F.when(F.col("doc_id").isNull(), None)
        .otherwise(F.coalesce("component", "rep", "doc_id"))
    )
    return rows.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document a group.
    Where texts share an id, only those that aren't kept go."""
    gone = _grouped(docs).where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(gone.distinct(), same, "left_anti")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
         ELSE array_to_string(ws[i:i + 4], ' ') END AS shingle
  FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i)
  WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b USING (shingle) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id
  GROUP BY 1, 2, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""
