"""Edit-aware token counts (operator 3).

A document's text is cut into units at places that no pre-token crosses; blocks
of units are the leaves of a segment tree of token counts, whose root is the
document's count. An edit re-encodes the blocks it touches and one block of
context on either side (whose outer ends are unchanged, so every other unit
stays as it is), and adds the differences along the paths to the root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmart.llm import tokens as K
from matchmart.llm import words as W
from matchmart.llm.common import table

BLOCK = 32  # units of a leaf

#: What an edit of ``redactions`` removes, and what it puts there.
PERSONAL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+|[0-9]{6,}"
REDACTED = "<PII>"

EDITS = "array<struct<at:int,removed:int,inserted:string>>"


def tree_of(leaves: np.ndarray) -> np.ndarray:
    """A heap of sums: node i has children 2i and 2i + 1, the root is 1, the
    leaves are the last half."""
    size = 1 << max(len(leaves) - 1, 0).bit_length()
    tree = np.zeros(2 * size, np.int64)
    tree[size : size + len(leaves)] = leaves
    while size > 1:
        half = size // 2
        tree[half:size] = tree[size : 2 * size].reshape(-1, 2).sum(axis=1)
        size = half
    return tree


def update(tree: np.ndarray, first: int, leaves: np.ndarray) -> None:
    """Replace the leaves from ``first`` on, and the sums above them."""
    lo = len(tree) // 2 + first
    hi = lo + len(leaves) - 1
    tree[lo : hi + 1] = leaves
    while lo > 1:
        lo, hi = lo // 2, hi // 2
        tree[lo : hi + 1] = tree[2 * lo : 2 * hi + 2].reshape(-1, 2).sum(axis=1)


def _blocks(starts: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of the blocks of a text's units."""
    at = np.arange(0, len(starts), BLOCK)
    if not len(at):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    return np.diff(np.append(starts[at], end)), np.add.reduceat(counts, at)


def build_trees(docs: DataFrame, carry: list[str] = ()) -> DataFrame:
    """``doc_id``, ``text``, ``carry`` columns, then leaf_bytes and tree (binary
    arrays of longs). One row per input row; a null text counts as empty, with
    one empty leaf."""
    names = ["doc_id", "text", *carry]
    schema = T.StructType([docs.schema[c] for c in names])
    schema.add("leaf_bytes", T.BinaryType()).add("tree", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in W.text_slices(batch.column(1), K.SLICE):
                starts, counts = K.unit_counts(buf, offsets, added=True)
                first = np.searchsorted(starts, offsets)
                sizes, trees = [], []
                for r in range(hi - lo):
                    a, b = first[r], first[r + 1]
                    size, tokens = _blocks(starts[a:b], counts[a:b], offsets[r + 1])
                    sizes.append(size.astype("<i8").tobytes())
                    trees.append(tree_of(tokens).astype("<i8").tobytes())
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sizes, pa.binary()), pa.array(trees, pa.binary())],
                    names=[*names, "leaf_bytes", "tree"],
                )

    return docs.select(*names).mapInArrow(run, schema)


def _regions(text: bytes, sizes: np.ndarray, edits: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
    """(first block, last block, new bytes) of the stretches of blocks that the
    sorted byte edits touch, with a block of context that isn't empty on either
    side."""
    ends = np.cumsum(sizes)
    last = len(sizes) - 1
    open_: list = []
    for at, removed, new in edits:
        a = min(int(np.searchsorted(ends, at, "right")), last)
        b = min(int(np.searchsorted(ends, max(at, at + removed - 1), "right")), last)
        # Leaves that earlier edits have emptied are no context.
        a, b = max(a - 1, 0), min(b + 1, last)
        while a > 0 and not sizes[a]:
            a -= 1
        while b < last and not sizes[b]:
            b += 1
        if open_ and a <= open_[1] + 1:
            open_[1] = max(open_[1], b)
            open_[2].append((at, removed, new))
        else:
            if open_:
                yield _rewritten(text, ends, sizes, *open_)
            open_ = [a, b, [(at, removed, new)]]
    if open_:
        yield _rewritten(text, ends, sizes, *open_)


def _rewritten(text, ends, sizes, a, b, edits):
    out, at = [], int(ends[a] - sizes[a])
    for begin, removed, new in edits:
        out += [text[at:begin], new]
        at = begin + removed
    out.append(text[at : int(ends[b])])
    return a, b, b"".join(out)


def _byte_edits(text: str, edits: list[dict]) -> list[tuple[int, int, bytes]]:
    """Edits by code point, in any order, as sorted edits by byte. What an
    earlier edit has removed can't be removed again; edits beyond the text's end
    are at its end; null fields are 0 or empty."""
    out, done, done_bytes = [], 0, 0
    for e in sorted(edits, key=lambda e: (e["at"] or 0, e["removed"] or 0, e["inserted"] or "")):
        at = min(max(e["at"] or 0, done), len(text))
        end = min(max((e["at"] or 0) + max(e["removed"] or 0, 0), at), len(text))
        begin = done_bytes + len(text[done:at].encode())
        removed = len(text[at:end].encode())
        out.append((begin, removed, (e["inserted"] or "").encode()))
        done, done_bytes = end, begin + removed
    return out


def apply_edits(trees: DataFrame) -> DataFrame:
    """From rows of ``build_trees`` with a column ``edits`` (of ``EDITS``; null
    or empty: none): doc_id, text, leaf_bytes and tree after the edits, and
    n_tokens_before, n_tokens, n_edits, n_leaves, n_bytes (of the old text),
    n_encoded_bytes (of all stretches encoded again)."""
    names = ["doc_id", "text", "leaf_bytes", "tree"]
    schema = T.StructType([trees.schema[c] for c in names])
    more = ["n_tokens_before", "n_tokens", "n_edits", "n_leaves", "n_bytes", "n_encoded_bytes"]
    for c in more:
        schema.add(c, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, _ in W.text_slices(batch.column(1), K.SLICE):
                yield edited(batch.slice(lo, hi - lo))

    def edited(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in part.column(1).to_pylist()]
        sizes = [np.frombuffer(x, "<i8").copy() for x in part.column(2).to_pylist()]
        sums = [np.frombuffer(x, "<i8").copy() for x in part.column(3).to_pylist()]
        edits = [e or [] for e in part.column(4).to_pylist()]
        before = [int(t[1]) for t in sums]
        raw = [t.encode() for t in texts]
        length = [len(x) for x in raw]
        jobs = [
            (r, a, b, new)
            for r, e in enumerate(edits)
            if e
            for a, b, new in _regions(raw[r], sizes[r], _byte_edits(texts[r], e))
        ]
        # All stretches of the slice are encoded together.
        bounds = np.concatenate([[0], np.cumsum([len(j[3]) for j in jobs])]).astype(np.int64)
        starts, counts = K.unit_counts(np.frombuffer(b"".join(j[3] for j in jobs), np.uint8), bounds, added=True)
        first = np.searchsorted(starts, bounds)
        again = np.zeros(len(texts), np.int64)
        pieces: dict[int, list] = {}
        for i, (r, a, b, new) in enumerate(jobs):
            u, v = first[i], first[i + 1]
            # As many leaves as before, so only sums along their paths change.
            cuts = u + (v - u) * np.arange(b - a + 2) // (b - a + 1)
            edge = np.append(starts, bounds[i + 1])[np.minimum(cuts, v)]
            edge[cuts == v] = bounds[i + 1]
            edge[0] = bounds[i]
            total = np.concatenate([[0], np.cumsum(counts[u:v])])
            pieces.setdefault(r, []).append((a, b, new, np.diff(edge)))
            update(sums[r], a, np.diff(total[cuts - u]))
            again[r] += len(new)
        for r, changed in pieces.items():
            ends = np.cumsum(sizes[r])
            out, at = [], 0
            for a, b, new, size in changed:
                out += [raw[r][at : int(ends[a] - sizes[r][a])], new]
                at = int(ends[b])
            raw[r] = b"".join([*out, raw[r][at:]])
            for a, b, _, size in changed:
                sizes[r][a : b + 1] = size
        return pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([x.decode() for x in raw], pa.string()),
                pa.array([x.astype("<i8").tobytes() for x in sizes], pa.binary()),
                pa.array([x.astype("<i8").tobytes() for x in sums], pa.binary()),
                pa.array(before, pa.int64()),
                pa.array([int(t[1]) for t in sums], pa.int64()),
                pa.array([len(e) for e in edits], pa.int64()),
                pa.array([len(s) for s in sizes], pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(again),
            ],
            names=[*names, *more],
        )

    return trees.select(*names, F.col("edits").cast(EDITS)).mapInArrow(run, schema)


def redactions(text: Column) -> Column:
    """The edits that replace mail addresses and long numbers."""
    text = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(text, F.lit(PERSONAL), F.lit(0))
    between = F.split(text, PERSONAL, -1)
    size = lambda parts, n: F.aggregate(F.slice(parts, 1, n), F.lit(0), lambda a, x: a + F.length(x))
    return F.transform(
        found,
        lambda m, i: F.struct(
            (size(between, i + 1) + size(found, i)).alias("at"),
            F.length(m).alias("removed"),
            F.lit(REDACTED).alias("inserted"),
        ),
    )


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees with their edits from a table doc_id, at, removed, inserted. All
    edits of a document meet in its row, as they must to be applied."""
    grouped = edits.groupBy("doc_id").agg(F.collect_list(F.struct("at", "removed", "inserted")).alias("edits"))
    return trees.join(grouped, "doc_id", "left")


def op3_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after personal data is redacted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", redactions(F.col("text")).alias("edits"))
    return apply_edits(build_trees(docs, ["edits"])).drop("text", "leaf_bytes", "tree")
