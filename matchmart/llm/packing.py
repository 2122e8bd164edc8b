"""Best-fit packing by a configuration linear program (operator 10).

A configuration is a multiset of piece lengths that fits a sequence. The
program, minimise the number of sequences with every length covered as often
as it occurs, sees only the histogram of lengths, at most as many rows as a
sequence has tokens. Multiplicative weights solve it: uncovered lengths grow
dear, a knapsack dynamic program finds the dearest configuration, and its use
covers its lengths further. Rounding leaves some pieces, which best fit places.

Spark tokenises, counts lengths, and hands every piece its place: pieces are
ranked within their length over ranges, so no task holds a length, and a rank
names a sequence and an offset.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import tokens as K
from matchmart.llm import words as W
from matchmart.llm.common import hash_order, ranked, staged, table

CAPACITY = 1024
END = 2  # the id after each document
ROUNDS, HEAT, SLACK = 100, 0.1, 0.01
SCALES = (0.25, 0.5, 0.75, 0.95)  # quantiles of cover by which uses are divided

Configuration = tuple[tuple[int, int], ...]  # (length, times), longest first


def cut(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` tokens: whole
    sequences, but for the first piece, which takes what is over."""
    first = total % capacity or capacity
    edges = [0, *range(first, total + 1, capacity)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in W.text_slices(batch.column(1), K.SLICE):
                ids, at = K.encode_slice(buf, offsets, added=True)
                row, number, start, length, crc = [], [], [], [], []
                for r in range(hi - lo):
                    own = np.append(ids[at[r] : at[r + 1]], np.uint32(END)).astype("<u4")
                    for j, (a, n) in enumerate(cut(len(own), capacity)):
                        row.append(lo + r)
                        number.append(j)
                        start.append(a)
                        length.append(n)
                        crc.append(zlib.crc32(own[a : a + n]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
            W.release()

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(best price of each room up to the capacity, the length taken for it or
    -1), lengths ascending and usable any number of times."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        if k := upto[room]:
            value = best[room - lengths[:k]] + price[:k]
            i = int(value.argmax())
            best[room], took[room] = value[i], i
    return best, took


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[Configuration, float], np.ndarray]:
    """(uses of configurations, how many times over they cover each length) by
    multiplicative weights.

    A round's knapsack table gives, for every length, the dearest configuration
    that holds it. All that come within ``SLACK`` of the dearest are used as
    often as their scarcest length occurs; then each length's price falls by a
    factor that grows with how far the round covered it. Prices start in
    proportion to length. Uses divided by a cover are a fractional solution.
    """
    lengths = np.array(sorted(histogram), np.int64)
    need = np.array([histogram[int(x)] for x in lengths], float)
    price, covered, uses = lengths / capacity, np.zeros(len(lengths)), Counter()
    for _ in range(ROUNDS if len(lengths) else 0):
        best, took = knapsack(lengths, price, capacity)
        value = price + best[capacity - lengths]
        now = np.zeros(len(lengths))
        for i in np.flatnonzero(value >= (1 - SLACK) * value.max()):
            times, room = Counter({int(i): 1}), capacity - int(lengths[i])
            while took[room] >= 0:
                times[int(took[room])] += 1
                room -= int(lengths[took[room]])
            use = min(need[j] / n for j, n in times.items())
            uses[tuple((int(lengths[j]), n) for j, n in sorted(times.items(), reverse=True))] += use
            for j, n in times.items():
                now[j] += use * n
        covered += now / need
        share = now / need
        price = price * np.exp(-HEAT * share / share.max())
        price /= price.max()
    return uses, covered


def rounded(uses: dict[Configuration, float], scale: float, parts: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Whole uses: fractions carry over from one configuration to the next, no
    piece is placed twice, and best fit places what is left."""
    left, out, carry = Counter(parts), Counter(), 0.0
    for config, use in sorted(uses.items(), key=lambda c: (-c[1], c[0])):
        carry += use / scale
        times = min([int(carry), *(left[x] // n for x, n in config)])
        carry -= int(carry)
        if times:
            out[config] += times
            for x, n in config:
                left[x] -= n * times
    out.update(greedy(left, capacity))
    return out


def greedy(left: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Best fit: a sequence takes the longest piece that still fits, again and
    again; a filling is repeated for as long as its pieces last."""
    left, out = Counter({k: v for k, v in left.items() if v}), Counter()
    while left:
        room, config = capacity, []
        for x in sorted(left, reverse=True):
            if n := min(left[x], room // x):
                config.append((x, n))
                room -= x * n
        times = min(left[x] // n for x, n in config)
        out[tuple(config)] += times
        for x, n in config:
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[Configuration, int]:
    """Whole uses of configurations that place every piece: the program's
    solution, rounded at several scales, or best fit for all pieces, whichever
    takes the fewest sequences. Pieces as long as a sequence fill their own."""
    parts = {k: v for k, v in histogram.items() if v and k < capacity}
    uses, covered = solve(parts, capacity)
    tries = [rounded(uses, float(np.quantile(covered, q)), parts, capacity) for q in SCALES if len(covered)]
    out = min([*tries, greedy(parts, capacity)], key=lambda c: sum(c.values()))
    if histogram.get(capacity):
        out[((capacity, 1),)] += histogram[capacity]
    return out


def slots(configs: dict[Configuration, int]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, times, offset): rank r
    from the first on is at sequence first + (r - rank) // times."""
    out: dict[int, list] = {}
    ranks: Counter[int] = Counter()
    sequence = 0
    for config, uses in sorted(configs.items()):
        offset = 0
        for x, n in config:
            out.setdefault(x, []).append((ranks[x], sequence, n, offset))
            ranks[x] += n * uses
            offset += x * n
        sequence += uses
    return {x: np.array(rows, np.int64) for x, rows in out.items()}


def placed(rows: DataFrame, places: dict[int, np.ndarray]) -> DataFrame:
    """Turn the ``rank`` of a piece in its length into sequence_id and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                runs = places[int(x)]
                first, number, times, begin = runs[np.searchsorted(runs[:, 0], rank[at], "right") - 1].T
                sequence[at] = number + (rank[at] - first) // times
                offset[at] = begin + (rank[at] - first) % times * x
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return rows.select(*names, "rank").mapInArrow(
        run,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Reads ``doc_id`` and ``text`` only. A null or empty text is the end id
    alone; null ids and repeated rows are packed like any other (a row's
    pieces belong together, but nothing more tells them apart); an empty table
    gives none. The driver holds the histogram, one row a length, and the plan,
    whose size follows from the capacity, not the table.
    """
    parts = staged(pieces(docs, capacity).withColumn("by", F.expr(hash_order("doc_id", "piece", "ids_crc32"))), "pieces")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = slots(plan(histogram, capacity))
    return placed(ranked(parts, "length", "by", ["doc_id", "piece"], "rank"), places)


def op10_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
