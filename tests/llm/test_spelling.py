"""Spelling variants against all pairs."""

import random
import zlib
from collections import Counter

import pytest

from cases import clashing, documents, table
from lavoura.llm import spelling
from lavoura.llm.spelling import Alphabet, variants


def letter(c):
    return "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows, least_length, least_count, times, drop_every):
    n = Counter()
    for doc, text, *_ in rows:
        run = ""
        for c in (text or "") + " ":
            if letter(c):
                run += c.lower() if "A" <= c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if h % drop_every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                n[run] += 1
                run = ""
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v.encode()), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def misspelt(seed):
    """Frequent words, rarer ones an edit away, and rarer ones still away from those."""
    rng, rows = random.Random(seed), documents()
    letters = "abcdefghiéüÿ"
    for i in range(60):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        for n in (60, 11, 2):
            rows.append((10_000 + 10 * i + n, " ".join([word] * n), "en", "s", 0))
            at, c = rng.randrange(len(word)), rng.choice(letters)
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]])
    rows += [(None, "Qwerty÷× " * 9, "en", "s", 0), (5, "aaaaaa " * 9, "en", "s", 0), (5, "aaaaaaa " * 50, "en", "s", 0), (7, "ab" * 5000, "en", "s", 0)]
    return rows


@pytest.mark.parametrize("settings, hot, symbols", [((6, 5, 5, 199), 256, None), ((4, 1, 2, 7), 256, 4), ((5, 2, 3, 11), 1, 4)])
def test_variants(spark, monkeypatch, settings, hot, symbols):
    # With few symbols and every reduced word hot, both ways of joining are gone.
    monkeypatch.setattr(spelling, "HOT", hot)
    if symbols:
        monkeypatch.setattr(spelling, "symbols_of", lambda words, length: symbols)
    rows = misspelt(4)
    got = sorted(map(tuple, variants(clashing(table(spark, rows)), *settings).collect()), key=str)
    assert got == by_hand(rows, *settings)
    assert settings[1] > 2 or any(r[2] not in (r[0], r[1]) for r in got)


def test_without_words(spark):
    assert variants(table(spark, [])).collect() == []
    assert variants(table(spark, [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "12 _ ", "en", "s", 0)])).collect() == []


def test_neighbourhoods_hold_every_edit():
    alphabet, word = Alphabet(5), "straße"
    around = set(alphabet.neighbours(alphabet.reduced([word]))[0].tolist())
    for i in range(len(word) + 1):
        for c in "aqzéÿ":
            assert alphabet.key(word[:i] + c + word[i:]) in around
            assert i == len(word) or alphabet.key(word[:i] + c + word[i + 1 :]) in around
        assert i == len(word) or alphabet.key(word[:i] + word[i + 1 :]) in around
