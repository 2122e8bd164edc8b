"""Token ids of the byte-level BPE, for whole Arrow columns (inside tasks).

A text splits into units: a new one begins at a space, tab or line break that
follows another character than white space. No pre-token crosses such a
place, so a text's ids are its units' ids in order. Texts repeat units all the
time; each is encoded once a batch. The ids are those of the tokenizer file's
own vocabulary and merges, read from its rank file (the same vocabulary; tests
compare whole tables with the ``tokenizers`` library). With ``added``, a string
of the file's added tokens is a unit of its own and has its own id, as in
``tokenizers``; what is before and after it is encoded as if it were alone.
Without, it is ordinary text.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import pyarrow as pa

VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

SLICE = 1 << 19  # bytes of texts encoded together (about 100 a byte are held); a longer text is encoded in pieces
_JOIN = 20_000  # units encoded in one call

_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x09, 0x0A, 0x0D]] = True
_OTHER_SPACE = np.zeros(256, bool)
_OTHER_SPACE[[0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F]] = True


def encoding():
    """(encoder, byte length of each id); made once a worker."""
    import public_tokenizers
    import tiktoken

    made = getattr(tiktoken, "_byte_bpe_50k", None)
    if made is None:
        with open(public_tokenizers.path(VOCABULARY), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoder = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        made = tiktoken._byte_bpe_50k = (encoder, lengths)
    return made


def added_tokens() -> tuple[dict[bytes, int], re.Pattern | None]:
    """(ids of the tokenizer file's added tokens, the pattern that finds them);
    made once a worker."""
    import public_tokenizers
    import tiktoken

    made = getattr(tiktoken, "_byte_bpe_50k_added", None)
    if made is None:
        with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
            entries = json.load(f)["added_tokens"]
        for e in entries:
            if e["single_word"] or e["lstrip"] or e["rstrip"] or e["normalized"]:
                raise ValueError(f"added token {e['content']!r} has options that aren't supported")
        ids = {e["content"].encode(): e["id"] for e in entries}
        longest = sorted(ids, key=len, reverse=True)
        made = tiktoken._byte_bpe_50k_added = (ids, re.compile(b"|".join(map(re.escape, longest))) if ids else None)
    return made


def _added_edges(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the added tokens of the texts of a slice begin and end."""
    pattern = added_tokens()[1]
    raw = memoryview(np.ascontiguousarray(buf))
    if pattern is None or not pattern.search(raw):
        return np.zeros(0, np.int64)
    # Text by text: a token never lies across two.
    edges = [
        x
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())
        for m in pattern.finditer(raw, lo, hi)
        for x in m.span()
        if x < hi
    ]
    return np.array(edges, np.int64)


def _after_other_space(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a white space character that is no break ends just before ``at``
    (or might: some punctuation counts too, which only makes longer units)."""
    pad = np.concatenate([np.zeros(3, np.uint8), buf])  # pad[i + 2] is the byte before i
    one, two, three = pad[at + 2], pad[at + 1], pad[at]
    return (
        _OTHER_SPACE[one]
        | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
        | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
        | ((three == 0xE2) & ((two == 0x80) | (two == 0x81)))
        | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    )


def unit_starts(buf: np.ndarray, offsets: np.ndarray, added: bool = False) -> np.ndarray:
    """Where the units of the texts of a slice begin (a text's start always does)."""
    at = _BREAK[buf]
    begin = np.flatnonzero(at[1:] & ~at[:-1]) + 1
    # Not after another white space character, which would join this one's run.
    begin = begin[~_after_other_space(buf, begin)]
    first = np.zeros(len(buf), bool)
    first[begin] = True
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    if added:
        first[_added_edges(buf, offsets)] = True
    return np.flatnonzero(first)


def encode_distinct(units: pa.LargeBinaryArray, added: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a pool of ids, where each unit's begin in it, and how many there are)."""
    encoder, lengths = encoding()
    at = np.frombuffer(units.buffers()[1], np.int64)[: len(units) + 1]
    data = np.frombuffer(units.buffers()[2], np.uint8)
    # Units that begin with a break and don't end in white space keep their
    # pre-tokens when they are joined: one call encodes many.
    plain = _BREAK[data[at[:-1]]] & ~_BREAK[data[at[1:] - 1]] & ~_after_other_space(data, at[1:])
    counts, begin, pools, done = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), [], 0
    special = added_tokens()[0] if added else {}
    inner = np.flatnonzero(plain)
    for lo in range(0, len(inner), _JOIN):
        part = inner[lo : lo + _JOIN]
        joined = units.take(pa.array(part))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[1 : len(part) + 1]
        text = joined.buffers()[2].to_pybytes()[: ends[-1]].decode()
        ids = np.array(encoder.encode_ordinary(text), np.uint32)
        cut = np.searchsorted(np.cumsum(lengths[ids]), ends, "left") + 1
        counts[part] = np.diff(cut, prepend=0)
        begin[part] = done + cut - counts[part]
        pools.append(ids)
        done += len(ids)
    for i in np.flatnonzero(~plain):
        unit = units[i].as_py()
        ids = np.array([special[unit]] if unit in special else encoder.encode_ordinary(unit.decode()), np.uint32)
        begin[i], counts[i] = done, len(ids)
        pools.append(ids)
        done += len(ids)
    return np.concatenate([np.zeros(0, np.uint32), *pools]), begin, counts


def distinct(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """(the number of each unit's bytes, the distinct units)."""
    bounds = np.append(starts, len(buf)).astype(np.int64)
    units = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(buf))]
    ).dictionary_encode()
    return units.indices.to_numpy(), units.dictionary


def unit_counts(buf: np.ndarray, offsets: np.ndarray, added: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the units of a slice, number of ids of each)."""
    starts = unit_starts(buf, offsets, added)
    if not len(starts):
        return starts, np.zeros(0, np.int64)
    name, units = distinct(buf, starts)
    return starts, encode_distinct(units, added)[2][name]


def _text_pieces(buf: np.ndarray, added: bool):
    """(begin, end) of consecutive pieces of one text, each of whole units."""
    begin, size = 0, SLICE
    while begin < len(buf):
        end = min(begin + size, len(buf))
        if end < len(buf):
            last = int(unit_starts(buf[begin:end], np.array([0, end - begin]), added)[-1])
            if last < 4:  # a unit longer than the piece; or too near the start to see what is before
                size *= 2
                continue
            end = begin + last
        yield begin, end
        begin, size = end, SLICE


def encode_slice(buf: np.ndarray, offsets: np.ndarray, added: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts of a slice, where each text's begin: rows + 1)."""
    if len(buf) > SLICE and len(offsets) == 2:  # one long text
        parts = [_encode(buf[a:b], np.array([0, b - a]), added)[0] for a, b in _text_pieces(buf, added)]
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])
    return _encode(buf, offsets, added)


def _encode(buf: np.ndarray, offsets: np.ndarray, added: bool) -> tuple[np.ndarray, np.ndarray]:
    starts = unit_starts(buf, offsets, added)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    name, units = distinct(buf, starts)
    pool, begin, counts = encode_distinct(units, added)
    begin, counts = begin[name], counts[name]
    total = np.concatenate([[0], np.cumsum(counts)])
    take = np.arange(total[-1]) + np.repeat(begin - total[:-1], counts)
    return pool[take], total[np.searchsorted(starts, offsets)]
