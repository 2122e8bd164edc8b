"""What tokenising a batch holds beside the batch, whatever the batch's size."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from matchmart.llm import tokens as K
from matchmart.llm import words as W


def peak_mb(texts: list[str]) -> float:
    column = pa.array(texts)
    K.encoding(), K.added_tokens()
    tracemalloc.start()
    for _, _, buf, offsets in W.text_slices(column, K.SLICE):
        K.encode_slice(buf, offsets, added=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_a_slice_is_small():
    text = " ".join(f"word{i % 997} a{i % 31}" for i in range(2000))
    assert peak_mb([text] * 300) < 16  # 7 MB of texts
    assert peak_mb([text * 300]) < 28  # the ids of one long text are kept
