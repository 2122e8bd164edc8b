"""Quality rules as weak supervision (operator 5).

Each rule votes good (+1), bad (-1) or abstains (0) on a document. The votes of
a document are one pattern of at most 3**9; expectation-maximisation over the
counts of the patterns estimates every rule's accuracy and the share of good
documents, and the posterior probability of good replaces all-must-pass
filtering. Features come from one pass over the texts in Arrow batches; only
the pattern counts (at most 19,683 rows, whatever the corpus) reach the driver.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmart.llm import words as W
from matchmart.llm.common import dropped, staged, table

SLICE = 1 << 20  # bytes of texts judged together; a longer text is judged in pieces
MIN_WORDS = 10  # base rule
WINDOW = 5  # words of a repeated passage
MAX_REPEAT_PERCENT = 20  # base rule: words in repeated windows

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_LETTER = np.zeros(256, np.int64)  # ASCII letters, and leads of longer code points
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC0:] = 1
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\"')")] = True
_LEAD = np.ones(256, np.int64)
_LEAD[0x80:0xC0] = 0  # continuation bytes

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lettered", "n_stops", "n_distinct"]

#: name, feature, per, good if in [low, high], bad if outside [worst low, worst high], least count of ``per``
RULES = [
    ("word_length", "word_chars", "n_words", (3.0, 9.0), (2.0, 14.0), 1),
    ("symbols", "n_symbols", "n_words", (0.0, 0.05), (0.0, 0.15), 1),
    ("symbols_by_length", "n_symbols", "word_chars", (0.0, 0.005), (0.0, 0.03), 1),
    ("repeated_lines", "n_dup_lines", "n_lines", (0.0, 0.1), (0.0, 0.3), 3),
    ("repeated_words", "n_repeat_words", "n_words", (0.0, 0.05), (0.0, 0.15), 20),
    ("lettered_words", "n_lettered", "n_words", (0.85, 1.0), (0.7, 1.0), 1),
    ("sentence_ends", "n_stops", "n_words", (0.02, 0.5), (0.005, 1.0), 50),
    ("distinct_words", "n_distinct", "n_words", (0.2, 1.0), (0.08, 1.0), 30),
    ("enough_words", "n_words", None, (20.0, float("inf")), (5.0, float("inf")), 0),
]


def _sums(weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(weights)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    seen: set[bytes] = set()
    n = again = 0
    for line in text.split(b"\n"):
        if line.strip():
            n += 1
            if line in seen:
                again += 1
            else:
                seen.add(line)
    return n, again


def features(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The features of the texts of a slice."""
    words = W.find_words(buf, offsets)
    n = words.counts
    rows = words.rows()
    hashes = W.word_hashes(words)
    out = {"n_words": n.astype(np.int64)}
    out["word_chars"] = _sums(_LEAD[buf] * ~W._IS_SPACE[buf], offsets)
    out["n_symbols"] = _sums(_SYMBOL[buf], offsets)
    out["n_lines"], out["n_dup_lines"] = np.array(
        [_lines(words.text(r)) for r in range(len(n))], np.int64
    ).reshape(-1, 2).T

    starts = W.inside_rows(words.first, WINDOW)
    salt = W.mix(np.arange(1, len(n) + 1, dtype=np.uint64))
    keys = W.window_hashes(hashes, WINDOW)[starts] ^ salt[rows[starts]] if len(starts) else starts.astype(np.uint64)
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    hit = W.covered(starts[count[name] > 1] if len(starts) else starts, WINDOW, len(rows))
    out["n_repeat_words"] = _sums(hit.astype(np.int64), words.first)

    letters = np.concatenate([[0], np.cumsum(_LETTER[buf])])
    out["n_lettered"] = _sums((letters[words.end] > letters[words.start]).astype(np.int64), words.first)
    out["n_stops"] = _sums(_STOP[buf[words.end - 1]].astype(np.int64), words.first)
    first = np.unique(hashes ^ salt[rows], return_index=True)[1] if len(rows) else rows
    new = np.zeros(len(rows), np.int64)
    new[first] = 1
    out["n_distinct"] = _sums(new, words.first)
    return out


def long_features(buf: np.ndarray) -> dict[str, np.ndarray]:
    """``features`` of one long text. It is read in pieces, and only a hash a word
    and a hash a line are kept to find what repeats."""
    sums = dict.fromkeys(FEATURES, 0)
    hashes = []
    for a, b in W.cuts(buf, ~W._IS_SPACE, SLICE):
        piece, offsets = buf[a:b], np.array([0, b - a])
        words = W.find_words(piece, offsets)
        hashes.append(W.word_hashes(words))
        sums["n_words"] += len(words.start)
        sums["word_chars"] += int(_LEAD[piece][~W._IS_SPACE[piece]].sum())
        sums["n_symbols"] += int(_SYMBOL[piece].sum())
        letters = np.concatenate([[0], np.cumsum(_LETTER[piece])])
        sums["n_lettered"] += int((letters[words.end] > letters[words.start]).sum())
        sums["n_stops"] += int(_STOP[piece[words.end - 1]].sum())
    hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])

    lines = array("Q")
    begin, size, raw = 0, len(buf), memoryview(np.ascontiguousarray(buf))
    breaks = np.concatenate([np.flatnonzero(buf[a : a + SLICE] == 10) + a for a in range(0, size, SLICE)])
    for end in (*breaks, size):
        line = raw[begin:end]
        if not line.tobytes().isspace() and len(line):
            lines.append(int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little"))
        begin = int(end) + 1
    sums["n_lines"] = len(lines)
    sums["n_dup_lines"] = len(lines) - _n_distinct(np.frombuffer(lines, np.uint64).copy() if lines else np.zeros(0, np.uint64))

    keys = W.window_hashes(hashes, WINDOW)
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    del order
    hit = np.zeros(len(hashes), bool)
    for lo in range(0, len(keys) if len(twice) else 0, SLICE):
        part = keys[lo : lo + SLICE]
        found = twice[np.minimum(np.searchsorted(twice, part), len(twice) - 1)] == part
        for j in range(WINDOW):
            hit[lo + j : lo + j + len(part)] |= found
    sums["n_repeat_words"] = int(hit.sum())
    del keys
    sums["n_distinct"] = _n_distinct(hashes)
    return {k: np.array([v], np.int64) for k, v in sums.items()}


def _n_distinct(values: np.ndarray) -> int:
    """How many distinct values there are; sorts them in place."""
    values.sort()
    return int((values[1:] != values[:-1]).sum()) + 1 if len(values) else 0


def sliced_features(texts: pa.Array) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """(lo, hi, features of the rows lo:hi) over a batch of texts."""
    for lo, hi, buf, offsets in W.text_slices(texts, SLICE):
        yield lo, hi, long_features(buf) if len(buf) > SLICE else features(buf, offsets)
    W.release()


def vote_pattern(feats: dict[str, np.ndarray], rules=RULES) -> np.ndarray:
    """The votes of each document as one number, in base 3 (vote + 1)."""
    pattern = np.zeros(len(feats["n_words"]), np.int32)
    for _, what, per, (low, high), (floor, ceiling), least in rules:
        x = feats[what].astype(float)
        if per:
            x = x / np.maximum(feats[per], 1)
        vote = np.where((x >= low) & (x <= high), 1, np.where((x < floor) | (x > ceiling), -1, 0))
        if per:
            vote = np.where(feats[per] < least, 0, vote)
        pattern = pattern * 3 + vote.astype(np.int32) + 1
    return pattern


def votes_of(pattern: np.ndarray, rules: int) -> np.ndarray:
    """The votes (patterns x rules) in -1, 0, 1."""
    return np.stack([pattern // 3 ** (rules - 1 - j) % 3 - 1 for j in range(rules)], axis=1)


#: How votes -1 and 1 fall on bad and on good documents, before the data speak:
#: a bad document breaks some rules, a good one hardly any.
_START = np.array([[0.6, 0.4], [0.05, 0.95]])


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """The posterior probability of good of each pattern.

    A hidden class (bad, good) and, given it, independent votes: EM estimates
    for each rule how accurate its votes are on either class, and the share of
    good documents, from the counts of the patterns. Abstaining tells nothing.
    It starts at ``_START`` and a share of 0.8, adds the start as a thousandth of
    the corpus (so that no vote becomes impossible), and keeps the share in
    [0.05, 0.95]. Without rows it returns none.
    """
    kinds = np.stack([votes == v for v in (-1, 1)], axis=2).astype(float)  # patterns x rules x votes
    weight = counts / max(counts.sum(), 1)
    emit, share = np.repeat(_START[:, None, :], votes.shape[1], axis=1), 0.8
    posterior = np.full(len(counts), share)
    for _ in range(rounds):
        score = np.einsum("prv,rv->p", kinds, np.log(emit[1]) - np.log(emit[0]))
        posterior = 1 / (1 + np.exp(-(score + np.log(share / (1 - share)))))
        new = np.stack(
            [np.einsum("p,prv->rv", weight * mass, kinds) for mass in (1 - posterior, posterior)]
        ) + 1e-3 * _START[:, None, :]
        new /= new.sum(2, keepdims=True)
        share = float(np.clip((weight * posterior).sum(), 0.05, 0.95))
        done = np.abs(new - emit).max(initial=0) < tolerance
        emit = new
        if done:
            break
    return posterior


def judged_texts(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns of every row, then the features and the vote pattern.
    A carried column named like a feature gives way to the feature."""
    carry = [c for c in carry if c not in (*FEATURES, "pattern")]
    schema = T.StructType([docs.schema[c] for c in carry])
    for name in FEATURES:
        schema.add(name, T.LongType())
    schema.add("pattern", T.IntegerType())
    use = list(dict.fromkeys([*carry, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, feats in sliced_features(batch.column(use.index("text"))):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(use.index(c)) for c in carry]
                    + [pa.array(feats[f]) for f in FEATURES]
                    + [pa.array(vote_pattern(feats))],
                    names=[*carry, *FEATURES, "pattern"],
                )

    return docs.select(*[F.col(f"`{c}`") for c in use]).mapInArrow(run, schema)


def verdicts(patterns: DataFrame) -> DataFrame:
    """(pattern, posterior) from a frame with a ``pattern`` column: one row per
    pattern that occurs, 3**9 at most."""
    spark = patterns.sparkSession
    found = patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in found], np.int64)
    counts = np.array([r["n"] for r in found], float)
    posterior = fit_votes(votes_of(codes, len(RULES)).reshape(-1, len(RULES)), counts)
    rows = [(int(c), float(p)) for c, p in zip(codes, posterior)]
    return spark.createDataFrame(rows, "pattern int, posterior double")


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def with_verdict(judged: DataFrame, posterior: DataFrame) -> DataFrame:
    """Adds base_failed and kept. ``posterior`` has at most 3**9 rows, so it is
    broadcast."""
    rows = judged.join(F.broadcast(posterior), "pattern", "left")
    return rows.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, the features, base_failed, posterior, kept.

    Reads ``doc_id`` and ``text`` only. A null or empty text has no words, so
    it fails the base rule; null ids and repeated rows are judged as any other;
    an empty table gives none.
    """
    judged = staged(judged_texts(docs, ["doc_id"]), "quality-features")
    return with_verdict(judged, verdicts(judged)).select(
        "doc_id", *FEATURES, "base_failed", "posterior", "kept"
    )


_JUDGED = T.StructType().add("n_words", T.LongType()).add("n_repeat_words", T.LongType()).add("pattern", T.IntegerType())


def _judged(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    names = ["n_words", "n_repeat_words", "pattern"]
    for column in texts:
        parts = [(f["n_words"], f["n_repeat_words"], vote_pattern(f)) for _, _, f in sliced_features(column)]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int32)]
        yield pa.StructArray.from_arrays([pa.array(c) for c in columns], names)


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep.

    One pass judges the texts, of which nothing but the verdict's columns comes
    back from Python, and writes the rows with them; the patterns are counted
    there, and the second pass reads what was written and filters."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    judge = F.arrow_udf(_judged, _JUDGED)
    rows = docs.select(judge(F.col("text")).alias("__j"), *[F.col(f"`{c}`").alias(v) for c, v in names.items()])
    judged = staged(rows.select("__j.n_words", "__j.n_repeat_words", "__j.pattern", *names.values()), "quality-rows")
    kept = with_verdict(judged, verdicts(judged)).where("kept")
    return kept.select(*[F.col(v).alias(c) for c, v in names.items()])


def op5_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "posterior",
    )
