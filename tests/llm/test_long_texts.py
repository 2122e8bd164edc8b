"""Long texts: the same results in pieces as at once, in bounded memory."""

import subprocess
import sys

import brute
import numpy as np
import pytest

from matchmart.llm import quality, tokens
from matchmart.llm import words as W

TEXTS = [t for _, t, *_ in brute.awkward() if t] + ["x" * 3000, " " * 3000, "a <|endoftext|> b\n" * 200, "é  　y " * 300]


def one(text):
    raw = text.encode()
    return np.frombuffer(raw, np.uint8), np.array([0, len(raw)])


@pytest.mark.parametrize("size", [64, 1000])
def test_features_in_pieces(monkeypatch, size):
    whole = [quality.features(*one(t)) for t in TEXTS]
    monkeypatch.setattr(quality, "SLICE", size)
    for text, want in zip(TEXTS, whole):
        got = quality.long_features(one(text)[0])
        assert {k: int(v[0]) for k, v in want.items()} == {k: int(v[0]) for k, v in got.items()}


@pytest.mark.parametrize("size", [64, 1000])
def test_words_in_blocks(monkeypatch, size):
    whole = [W.find_words(*one(t)) for t in TEXTS]
    hashes = [W.word_hashes(w) for w in whole]
    for name in ("SLICE", "BLOCK"):
        monkeypatch.setattr(W, name, size)
    for text, want, h in zip(TEXTS, whole, hashes):
        got = W.find_words(*one(text))
        assert (got.start == want.start).all() and (got.end == want.end).all()
        assert (W.word_hashes(got) == h).all()
        joined = "".join(text.encode()[a:b].decode() for a, b in W.cuts(one(text)[0], ~W._IS_SPACE, size))
        assert joined == text


@pytest.mark.parametrize("size", [64, 1000])
def test_ids_in_pieces(monkeypatch, size):
    whole = [tokens.encode_slice(*one(t), added=True)[0] for t in TEXTS]
    monkeypatch.setattr(tokens, "SLICE", size)
    for text, want in zip(TEXTS, whole):
        assert (tokens.encode_slice(*one(text), added=True)[0] == want).all()


def test_a_text_of_50_mb_takes_bounded_memory():
    """In a process of its own: judging 50 MB takes less than 8 times as much."""
    code = """
import resource, sys
import numpy as np, pyarrow as pa
sys.path.insert(0, %r)
from matchmart.llm import quality
words = np.char.add("w", np.random.default_rng(3).integers(0, 10**6, 1_500_000).astype(str))
text = " ".join(words.tolist())
column = pa.array([(text + ".\\n") * (50_000_000 // len(text) + 1)])
del words, text
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
(_, _, found), = quality.sliced_features(column)
assert found["n_words"][0] > 6_000_000
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
""" % str(__import__("pathlib").Path(__file__).parents[2])
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 400
