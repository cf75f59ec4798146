"""Benchmark windows in documents against a plain version."""

import hashlib
import random
import re

import numpy as np
import pytest

from cases import clashing, documents, prose, table
from lavoura.llm.filters import bit_filter
from lavoura.llm.winnowing import contaminated, fingerprints

ITEMS = "item_id long, text string"


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def by_hand(rows, items, width):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        named = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(3)
    rows = documents()
    long = prose(rng, 60)
    items = [(i, prose(rng, 40)) for i in range(5)]
    items += [(10, long), (11, long[: len(long) // 2]), (100, "One"), (101, "two, WORDS"), (102, ""), (103, None), (None, long), (10, "again here")]
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 60][:3]
    items += [(20 + i, " ".join(t.split()[5:25])) for i, t in enumerate(texts)]  # inside documents
    items += [(30, "the the the"), (31, "a " * 30)]
    rows += [(800, f"x {long} y", "en", "s", 0), (801, long.upper(), "en", "s", 0), (800, "again\nhere one", "en", "s", 0), (None, f"q {long}", "en", "s", 0)]
    rows += [(802, "the " * 500, "en", "s", 0), (803, "a " * 500, "en", "s", 0), (804, " ".join(long.split()[3:12]), "en", "s", 0)]
    return rows, items


@pytest.mark.parametrize("width", [10, 4])
def test_contaminated(spark, width):
    rows, items = cases()
    got = contaminated(clashing(table(spark, rows)), clashing(spark.createDataFrame(items, ITEMS).repartition(2)), width).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows, items, width)


def test_a_passage_in_a_third_of_all_documents(spark):
    rng = random.Random(9)
    passage = prose(rng, 25)
    rows = [(i, f"{prose(rng, 8)} {passage if i % 3 == 0 else prose(rng, 25)} {prose(rng, 5)}", "en", "s", 0) for i in range(600)]
    items = [(1, passage), (2, f"{prose(rng, 9)} {passage}"), (3, prose(rng, 30))]
    got = contaminated(table(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows, items, 10)
    assert sum(r.contaminated for r in got) == 200


def test_without_rows(spark):
    rows, none = documents(), spark.createDataFrame([], ITEMS)
    assert contaminated(table(spark, []), none).collect() == []
    got = contaminated(table(spark, rows), none).collect()
    assert len(got) == len(rows) and not any(r.contaminated or r.n_hit or r.n_items for r in got)


def test_equal_windows_have_equal_fingerprints():
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 1 << 63, 10).astype(np.uint64)
    for length in (3, 5, 8, 10):
        a, b = (np.concatenate((rng.integers(0, 1 << 63, n).astype(np.uint64), shared, rng.integers(0, 1 << 63, 4).astype(np.uint64))) for n in (7, 2))
        for i in range(10 - length + 1):
            assert fingerprints(a, length)[7 + i] == fingerprints(b, length)[2 + i]
    # Far fewer fingerprints than windows.
    many = rng.integers(0, 1 << 63, 10_000).astype(np.uint64)
    assert len(np.unique(fingerprints(many, 10))) < 4_000


def test_bit_filter(spark):
    keys = spark.range(0, 5000, 1, 4).selectExpr("xxhash64(id) key")
    found = bit_filter(keys, 5000)
    held = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    assert found.holds(held).all() and int(held[0]) in found
    assert found.holds(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.05
    assert not bit_filter(keys.limit(0), 0).holds(held).any()
