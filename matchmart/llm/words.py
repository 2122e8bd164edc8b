"""Vectorised word work on Arrow text columns (runs inside Spark tasks).

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. A batch is cut
into slices of whole texts of at most ``SLICE`` bytes. A longer text is a slice
of its own; what is done byte by byte is then done a block at a time, so that a
task holds a few numbers a word beside the batch, never several a byte.
"""

from __future__ import annotations

import ctypes
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 4 << 20
#: Bytes, or windows, hashed at a time; a word over LONG_WORD bytes is hashed alone.
BLOCK = 1 << 18
LONG_WORD = 1 << 16

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """The words of a slice of texts: row ``r`` has words first[r]:first[r+1],
    word ``w`` is bytes start[w]:end[w] of ``buf``."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, r: int) -> bytes:
        return self.buf[self.offsets[r] : self.offsets[r + 1]].tobytes()


def text_slices(column: pa.Array, limit: int = SLICE):
    """Yield (lo, hi, buf, offsets) over the rows of a string column; null texts
    are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def text_pieces(column: pa.Array, inside: np.ndarray, limit: int = SLICE):
    """``text_slices``, but a text longer than ``limit`` comes in pieces, each with
    the (lo, hi) of its row. They end after a byte that is not ``inside`` words
    (256 flags); only one word longer than ``limit`` makes a longer piece."""
    for lo, hi, buf, offsets in text_slices(column, limit):
        if len(buf) <= limit:
            yield lo, hi, buf, offsets
            continue
        for begin, end in cuts(buf, inside, limit):
            yield lo, hi, buf[begin:end], np.array([0, end - begin])


def cuts(buf: np.ndarray, inside: np.ndarray, limit: int):
    """(begin, end) of consecutive pieces of one text, of about ``limit`` bytes."""
    begin = 0
    while begin < len(buf):
        end = begin + limit
        if end < len(buf):
            stops = np.flatnonzero(~inside[buf[begin:end]])
            if len(stops):
                end = begin + int(stops[-1]) + 1
            else:
                while end < len(buf) and inside[buf[end : end + limit]].all():
                    end += limit
                if end < len(buf):
                    end += int(np.argmin(inside[buf[end : end + limit]])) + 1
        yield begin, min(end, len(buf))
        begin = end


def find_words(buf: np.ndarray, offsets: np.ndarray, lower: bool = False, inside: np.ndarray = ~_IS_SPACE) -> Words:
    """The words of the texts: maximal runs of bytes flagged in ``inside``."""
    if lower:
        buf = _LOWER[buf]
    if len(buf) > SLICE and len(offsets) == 2:  # one long text
        parts = []
        for a, b in cuts(buf, inside, BLOCK):
            start, end = _bounds(buf[a:b], np.array([0, b - a]), inside)
            parts.append((start + a, end + a))
        start, end = (np.concatenate(x) for x in zip(*parts))
    else:
        start, end = _bounds(buf, offsets, inside)
    return Words(buf, offsets, start, end, np.searchsorted(start, offsets))


def _bounds(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the texts begin and end."""
    n = len(buf)
    solid = inside[buf]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    begins[cut] = solid[cut]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = solid[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def distinct_words(words: Words) -> tuple[np.ndarray, list[bytes]]:
    """(the number of each word in the list, the distinct words)."""
    if not len(words.start):
        return np.zeros(0, np.int64), []
    # Bounds alternate between words and what is between them.
    bounds = np.empty(2 * len(words.start) + 1, np.int64)
    bounds[0::2] = np.append(words.start, len(words.buf))
    bounds[1::2] = words.end
    runs = pa.Array.from_buffers(
        pa.large_binary(), 2 * len(words.start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(words.buf))]
    )
    coded = runs.take(pa.array(np.arange(0, len(runs), 2))).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes (polynomial over random byte values,
    then mixed with the length; of very long words a cryptographic one)."""
    start, end = words.start, words.end
    out = np.zeros(len(start), np.uint64)
    if not len(start):
        return out
    size = end - start
    long = np.flatnonzero(size > LONG_WORD)
    edges = np.searchsorted(start, np.arange(start[0], start[-1] + 1, BLOCK))
    edges = np.unique(np.concatenate([edges, long, long + 1, [0, len(start)]]))
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if size[i] > LONG_WORD:
            digest = hashlib.blake2b(words.buf[start[i] : end[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            continue
        n = size[i:j]
        at = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(at, n)
        value = _BYTE[words.buf[np.repeat(start[i:j], n) + inside]] * powers(int(n.max()))[inside]
        total = np.add.reduceat(value, at)
        out[i:j] = mix(total + n.astype(np.uint64) * np.uint64(_BASE))
    return out


def window_hashes(h: np.ndarray, width: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """The hash of each ``width`` consecutive words, whatever their row."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for lo in range(0, n, BLOCK):
        part = out[lo : lo + BLOCK]
        for j, p in enumerate(powers(width, base)):
            part += h[lo + j : lo + j + len(part)] * p
        part[:] = mix(part + np.uint64(width))
    return out


def inside_rows(first: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows of ``width`` words that stay in their row."""
    counts = np.diff(first)
    keep = np.maximum(counts - width + 1, 0)
    total = int(keep.sum())
    skip = np.repeat(first[:-1] - (np.cumsum(keep) - keep), keep)
    return np.arange(total) + skip


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``width`` that begins at one of
    ``starts``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, n), -1)
    return np.cumsum(step[:n]) > 0


def release() -> None:
    """Give freed memory back to the system: workers outlive their tasks, and an
    executor's memory counts what all of them hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass
