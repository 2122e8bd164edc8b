"""Plain versions of the operators, and awkward documents to run them on."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, kept boolean, pattern string, `odd name` int"


def awkward(seed: int = 5, n: int = 60) -> list[tuple]:
    """Rows of documents: few words, so that much repeats; null, empty, blank and
    long texts; copies, near copies and shared passages; repeated rows; ids out
    of order; columns named like results."""
    rng = random.Random(seed)
    vocabulary = ["a", "B", "the", "été", "x,", "foo.", "|", "日本", "no-one", "1234567", "é"] + [f"w{i}" for i in range(400)]
    say = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, base = say(50), say(120)
    texts = [None, "", " \n\t ", "a", "a b c d", "A b C d", "a b c d e", "a " * 200, "a b " * 100, "\n".join(["x y"] * 40)]
    for _ in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            words = list(base)
            for _ in range(rng.randrange(8)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind == 1:
            words = say(rng.randrange(60)) + passage + say(rng.randrange(60))
        elif kind == 2:
            words = say(rng.randrange(30)) + ["z"] * rng.randrange(60) + passage[: rng.randrange(20, 50)]
        elif kind == 3 and texts[10:]:
            texts.append(rng.choice(texts[10:]).replace(" ", "  ").upper() if rng.random() < 0.5 else rng.choice(texts[10:]))
            continue
        else:
            words = say(rng.randrange(1, 200))
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n", "\t", "  "]) for w in words))
    texts.append(" ".join(say(30_000)))
    rows = [
        (1000 - 3 * i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", 7, True, "p", i)
        for i, t in enumerate(texts)
    ]
    return rows + [rows[12], rows[12], (None, "a b c d e", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_groups(rows):
    """doc_id -> (set size, component) over rows with an id."""
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                group[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(rows, width=35):
    """The kept words of each row."""
    from collections import Counter

    texts = [words(r[1]) for r in rows]
    seen = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for w in texts:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def base_features(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    from collections import Counter

    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)
