"""License scans (operator 6).

Winnowed fingerprints of license templates form an inverted index; a document's
word k-grams that it holds name candidate templates and diagonals; a banded
local alignment around each diagonal reports how much of the template is there
and where. Alignments of a template that follow each other in it and in the
text, as around an inserted passage, are one match. Words are runs of letters and digits, lower-cased in A-Z.

The templates are a parameter of bounded size, and travel to every task; the
documents are read once, each by itself, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from matchmart.llm import words as W
from matchmart.llm.common import table

GRAM = 3  # words of a fingerprint
WINNOW = 2  # grams of which the smallest is kept: any GRAM + WINNOW - 1 words running are found
BAND = 8  # words by which an alignment may leave its diagonal
LEAST_COVERAGE = 0.6  # of the template's words
#: Words that may lie between two parts of a match: so many, or so many times the template's.
MOST_INSERTED, MOST_INSERTED_TIMES = 40, 3
MOST_TEMPLATE_WORDS = 200_000

# Notices as their publishers word them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_WORDS_ONLY = np.full(256, 0x20, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _WORDS_ONLY[_b] = _b
for _b in range(0x41, 0x5B):
    _WORDS_ONLY[_b] = _b + 32


def scan_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[W.Words, np.ndarray]:
    words = W.find_words(_WORDS_ONLY[buf], offsets)
    return words, W.word_hashes(words)


def winnowed(grams: np.ndarray) -> np.ndarray:
    """Places of the grams that are smallest in some WINNOW grams running."""
    if len(grams) <= WINNOW:
        return np.arange(len(grams))[grams == grams.min()] if len(grams) else np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams, WINNOW).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


class Index:
    """The templates' words, and (fingerprint, template, place) by fingerprint."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words: list[list[int]] = []
        rows: list[tuple[int, int, int]] = []
        for t, name in enumerate(self.names):
            raw = np.frombuffer(templates[name].encode(), np.uint8)
            _, hashes = scan_words(raw, np.array([0, len(raw)]))
            self.words.append(hashes.tolist())
            if len(hashes) < GRAM:
                raise ValueError(f"template {name!r} has fewer than {GRAM} words")
            grams = W.window_hashes(hashes, GRAM)
            rows += [(int(grams[i]), t, int(i)) for i in winnowed(grams)]
        if sum(map(len, self.words)) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"more than {MOST_TEMPLATE_WORDS} words of templates")
        rows.sort()
        self.keys = np.array([r[0] for r in rows], np.uint64)
        self.template = np.array([r[1] for r in rows], np.int64)
        self.place = np.array([r[2] for r in rows], np.int64)

    def hits(self, grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, template, diagonal) of every fingerprint at ``starts``."""
        lo = np.searchsorted(self.keys, grams[starts], "left")
        n = np.searchsorted(self.keys, grams[starts], "right") - lo
        word = np.repeat(starts, n)
        entry = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return word, self.template[entry], word - self.place[entry]


def diagonals(hits: list[int]) -> Iterator[int]:
    """Middles of the clusters of sorted diagonals closer than the band."""
    lo = at = None
    for d in hits:
        if at is not None and d - lo > BAND:
            yield (lo + at) // 2
            lo = d
        lo = d if lo is None else lo
        at = d
    if at is not None:
        yield (lo + at) // 2


def align(template: list[int], words: list[int], diagonal: int, band: int = BAND) -> tuple[int, int, int, int, int]:
    """(matched words, first word, last word + 1, first and last + 1 of the
    template) of the best local alignment of a template to ``words`` within
    ``band`` of a diagonal: 1 for a match, -1 for a mismatch or a skipped word.
    Of equal scores the first ends first."""
    best = (0, 0, 0, 0, 0, 0)  # score, matched, begin, begin in the template, end, end in the template
    above: dict[int, tuple[int, int, int, int]] = {}
    for i, t in enumerate(template):
        row: dict[int, tuple[int, int, int, int]] = {}
        left = (0, 0, 0, i)
        for j in range(max(i + diagonal - band, 0), min(i + diagonal + band + 1, len(words))):
            score, matched, begin, first = above.get(j - 1, (0, 0, j, i))
            if score == 0:
                matched, begin, first = 0, j, i
            if words[j] == t:
                cell = (score + 1, matched + 1, begin, first)
            else:
                cell = (score - 1, matched, begin, first)
            up = above.get(j, (0, 0, j, i))
            cell = max(cell, (up[0] - 1, *up[1:]), (left[0] - 1, *left[1:]), key=lambda c: c[0])
            if cell[0] <= 0:
                cell = (0, 0, j, i)
            elif cell[0] > best[0]:
                best = (*cell, j + 1, i + 1)
            row[j] = left = cell
        above = row
    return best[1], best[2], best[4], best[3], best[5]


def chains(parts: list[tuple[int, int, int, int, int]], gap: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(matched words, (begin, end) of each part) of the best chain that ends in
    each alignment. Parts follow each other in template and text, at most
    ``gap`` words of text apart; words in which two overlap count once."""
    parts = sorted(parts, key=lambda p: (p[2], p[1]))  # by their ends
    out: list[tuple[int, list[tuple[int, int]]]] = []
    for i, (matched, begin, end, first, last) in enumerate(parts):
        best, before = matched, -1
        for k in range(i - 1, -1, -1):
            _, b, e, f, l = parts[k]
            if begin - e > gap:
                break
            if b < begin and e < end and f < first and l < last:
                total = out[k][0] + matched - max(e - begin, l - first, 0)
                if total > max(best, out[k][0]):
                    best, before = total, k
        out.append((best, [*(out[before][1] if before >= 0 else []), (begin, end)]))
    return out


def scan_text(index: Index, words: list[int], hits: dict[int, list[int]]) -> list[tuple[int, int, int, int]]:
    """(template, matched, begin, end) of the matches of a text; of matches whose
    parts overlap the one with most matched words, then of best coverage, stays."""
    found = []
    for t, places in hits.items():
        n = len(index.words[t])
        parts = {align(index.words[t], words, d) for d in diagonals(sorted(places))}
        for matched, spans in chains([p for p in parts if p[0]], max(MOST_INSERTED, MOST_INSERTED_TIMES * n)):
            if matched >= LEAST_COVERAGE * n:
                found.append((t, matched, spans))
    found = sorted(found, key=lambda m: (-m[1], -m[1] / len(index.words[m[0]]), m[0], m[2][-1][1]))
    kept: list = []
    for m in found:
        if all(e <= x or b >= y for k in kept for x, y in k[2] for b, e in m[2]):
            kept.append(m)
    return sorted(((t, matched, spans[0][0], spans[-1][1]) for t, matched, spans in kept), key=lambda m: m[2:])


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per match: doc_id, license, begin, end (code points of the text),
    matched, template_words, coverage.

    Reads ``doc_id`` and ``text`` only. Null and empty texts have no matches;
    a text is read whole; a null id is carried along; rows that repeat have
    their matches each; an empty table gives none. Templates may hold
    ``MOST_TEMPLATE_WORDS`` words together and need three each.
    """
    index = Index(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in W.text_slices(batch.column(1)):
                words, hashes = scan_words(buf, offsets)
                grams = W.window_hashes(hashes, GRAM)
                word, template, diagonal = index.hits(grams, W.inside_rows(words.first, GRAM))
                rows = np.searchsorted(words.first, word, "right") - 1
                out: list[tuple] = []
                for r in np.unique(rows):
                    a, b = words.first[r], words.first[r + 1]
                    mine = rows == r
                    hits: dict[int, list[int]] = {}
                    for t, d in zip(template[mine].tolist(), (diagonal[mine] - a).tolist()):
                        hits.setdefault(t, []).append(d)
                    for t, matched, begin, end in scan_text(index, hashes[a:b].tolist(), hits):
                        head = buf[offsets[r] : words.start[a + begin]].tobytes().decode()
                        body = buf[words.start[a + begin] : words.end[a + end - 1]].tobytes().decode()
                        n = len(index.words[t])
                        out.append((lo + r, index.names[t], len(head), len(head) + len(body), matched, n, matched / n))
                cols = list(zip(*out)) if out else [[] for _ in range(7)]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(arrays[0]), *arrays[1:]],
                    names=["doc_id", "license", "begin", "end", "matched", "template_words", "coverage"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, license string, begin long, end long, matched long, template_words long, coverage double",
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
