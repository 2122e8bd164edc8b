"""Document fingerprints by a homomorphic multiset hash (operator 12).

A text is the multiset of its paragraphs (what lies between line breaks). Each
paragraph is hashed to a wide vector, and a text's vector is the sum of its
paragraphs' vectors modulo powers of two. So the order of paragraphs doesn't
matter, and inserting or deleting a paragraph adds or subtracts its vector;
the rest of the text is not read again. A paragraph's vector has two parts:

* 8 numbers modulo 2**64 from a 512-bit hash of the whole paragraph: equality;
* 256 signs a sentence, summed modulo 2**32: the vector of a difference of two
  texts grows with the sentences that only one has, which gives their likeness
  2 <a, b> / (<a, a> + <b, b>) with a standard error of about 1 / 16.

Equal sums of different multisets are a matter of chance (2**-256 at most for
two paragraphs exchanged), not proof against somebody who constructs them.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmart.llm.common import shuffle_width, staged, table

WIDE, SIGNS = 8, 256
_SENTENCE = re.compile(rb"(?<=[.!?]) +|(?<=\xe3\x80\x82)")
_BLOCK = 4096  # sentences whose signs are summed at a time


class Vector:
    """The sum of some paragraphs' vectors; supports + and -."""

    __slots__ = ("whole", "signs")

    def __init__(self, whole: np.ndarray | None = None, signs: np.ndarray | None = None):
        self.whole = np.zeros(WIDE, np.uint64) if whole is None else whole
        self.signs = np.zeros(SIGNS, np.uint32) if signs is None else signs

    def __add__(self, other: Vector) -> Vector:
        return Vector(self.whole + other.whole, self.signs + other.signs)

    def __sub__(self, other: Vector) -> Vector:
        return Vector(self.whole - other.whole, self.signs - other.signs)

    def __bytes__(self) -> bytes:
        """The 8 numbers, then the signs' sums in the narrowest signed integers that
        hold them, after a byte that says how wide these are."""
        sums = self.signs.view(np.int32)
        width = next(w for w in (1, 2, 4) if w == 4 or abs(sums.astype(np.int64)).max() < 1 << (8 * w - 1))
        return self.whole.astype("<u8").tobytes() + bytes([width]) + sums.astype(f"<i{width}").tobytes()

    def __str__(self) -> str:
        """The fingerprint as text; ``readable`` makes the same in Spark."""
        raw = bytes(self)
        return f"{raw[: 8 * WIDE].hex()}.{raw[8 * WIDE]}.{base64.b64encode(raw[8 * WIDE + 1 :]).decode()}"


def likeness(a: Vector, b: Vector) -> float:
    """0 to 1; 1 for equal vectors, 0 if only one has sentences."""
    if (a.whole == b.whole).all() and (a.signs == b.signs).all():
        return 1.0
    x, y = (v.signs.view(np.int32).astype(np.float64) for v in (a, b))
    size = x @ x + y @ y
    return float(np.clip(2 * (x @ y) / size, 0.0, 1.0)) if size else 0.0


def readable(raw: str) -> Column:
    """The text of a column of fingerprints as bytes."""
    n = 8 * WIDE
    return F.expr(
        f"concat(lower(hex(substring({raw}, 1, {n}))), '.', conv(hex(substring({raw}, {n + 1}, 1)), 16, 10), '.', "
        # Without the line breaks that some settings put into long texts.
        f"replace(base64(substring({raw}, {n + 2}, {4 * SIGNS})), char(13) || char(10)))"
    )


def paragraphs(pieces: list[bytes]) -> Vector:
    """The sum over ``pieces``."""
    whole = b"".join(hashlib.blake2b(p).digest() for p in pieces)
    total = np.frombuffer(whole, "<u8").reshape(-1, WIDE).sum(axis=0, dtype=np.uint64)
    digests = [
        hashlib.blake2b(s, digest_size=SIGNS // 8, person=b"sentence").digest()
        for p in pieces
        if p and not p.isspace()
        for s in _SENTENCE.split(p)
        if s
    ]
    plus = np.zeros(SIGNS, np.int64)
    for i in range(0, len(digests), _BLOCK):
        part = np.frombuffer(b"".join(digests[i : i + _BLOCK]), np.uint8).reshape(-1, SIGNS // 8)
        plus += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return Vector(total, (2 * plus - len(digests)).astype(np.uint32))


def whole_lines(text: bytes, begin: int, end: int) -> Vector:
    """The sum over the paragraphs of ``text[begin:end]``, which begins a
    paragraph and ends with a line break (or is empty); a block of them at a time."""
    total = Vector()
    while begin < end:
        stop = end if end - begin <= 1 << 18 else text.find(b"\n", begin + (1 << 18), end) + 1
        total = total + paragraphs(text[begin : stop - 1].split(b"\n"))
        begin = stop
    return total


def fingerprint(text: bytes) -> Vector:
    """The vector of a whole text; the empty text is one empty paragraph."""
    last = text.rfind(b"\n") + 1
    return whole_lines(text, 0, last) + paragraphs([text[last:]])


def replaced_tail(text: bytes, vector: Vector, cut: int, tail: bytes) -> Vector:
    """The vector of ``text[:cut] + tail`` from that of ``text``: paragraphs
    that the cut touches or that follow it are deleted, those of the tail, the
    first joined to what is left before the cut, inserted."""
    keep = text.rfind(b"\n", 0, cut) + 1  # where the paragraph of the cut begins
    if keep <= cut // 2:  # the shorter way: sum what stays instead
        left = whole_lines(text, 0, keep)
    else:
        last = text.rfind(b"\n", keep) + 1
        left = vector - whole_lines(text, keep, max(last, keep)) - paragraphs([text[max(last, keep) :]])
    return left + fingerprint(text[keep:cut] + tail)


def _judge(text: str, vector: Vector, following: str, next_vector: Vector) -> tuple:
    """The result columns of a text and the text that follows it."""
    half = len(text) // 2
    kept, tail = text[: len(text) - half].encode(), following[:half].encode()
    edited = replaced_tail(text.encode(), vector, len(kept), tail)
    digest = hashlib.sha256(kept + tail).digest()
    return len(text), digest, bytes(vector), bytes(edited), likeness(vector, edited), likeness(vector, next_vector)


_RESULT = "n_chars long, sha binary, own binary, edited binary, near_edited double, near_next double"


def _schema(docs: DataFrame, *extra: str) -> T.StructType:
    first = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    return T.StructType([*first, *T._parse_datatype_string(", ".join([_RESULT, *extra]))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _values(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch, one at a time."""
    for i in range(len(batch)):
        yield tuple(column[i].as_py() for column in batch.columns)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 2) code points
    replaced by the first as many of the next row in ascending doc_id (after the
    last row: the first); its fingerprint is derived from the text's own.
    Reads ``doc_id`` and ``text`` only. A null text is empty; null ids come
    last; rows of one id are ordered by a hash of their text, and by the text,
    equal ones in any order; a single row is followed by itself; an empty table
    gives none.

    Texts move once, to ranges of (doc_id, hash), so an id of many rows is
    spread, too. A range's first and last rows meet those of the ranges beside
    it by a join of two rows a range.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _schema(docs, "part int", "edge int", "text string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (part, doc_id, text, vector) of the row before
        for batch in batches:
            out = []
            for part, ident, text in _values(batch):
                now = (part, ident, text, fingerprint(text.encode()))
                if before is None:
                    out.append((ident, *[None] * 6, part, 0, text))
                else:
                    out.append((before[1], *_judge(before[2], before[3], now[2], now[3]), None, None, None))
                before = now
                if len(out) == 1000:
                    yield _batch(out, arrow)
                    out = []
            yield _batch(out, arrow)
        if before is not None:
            yield _batch([(before[1], *[None] * 6, before[0], 1, before[2])], arrow)

    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("__h"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("__h").asc()]
    sorted_rows = (
        keyed.repartitionByRange(shuffle_width(docs.sparkSession), *order)
        .sortWithinPartitions(*order, "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    # As bytes, compressed: text would take half as much again of the shared folder.
    rows = staged(sorted_rows.mapInArrow(run, schema), "fingerprints", compression="zstd")
    names = ["doc_id", *[f.name for f in T._parse_datatype_string(_RESULT)]]
    return rows.where("edge IS NULL").select(*names).unionAll(_at_edges(rows, names)).select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        readable("own").alias("fingerprint"),
        readable("edited").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def _at_edges(rows: DataFrame, names: list[str]) -> DataFrame:
    """The results of the last row of each range; two rows a range are read."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = rows.sparkSession
    schema = T.StructType([rows.schema[c] for c in names])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, text, following in _values(batch):
                vectors = [fingerprint(t.encode()) for t in (text, following)]
                yield _batch([(ident, *_judge(text, vectors[0], following, vectors[1]))], arrow)

    edges = rows.where("edge IS NOT NULL").select("doc_id", "part", "edge", "text")
    # The numbers of the ranges that have rows: the session's shuffle partitions at most.
    parts = sorted(r["part"] for r in edges.where("edge = 0").select("part").collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    firsts = edges.where("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("following"))
    pairs = edges.where("edge = 1").join(after, "part").join(firsts, "next")
    return pairs.select("doc_id", "text", "following").mapInArrow(run, schema)


def op12_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
