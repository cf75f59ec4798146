"""Operators on texts against plain versions, and awkward rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cases import clashing, documents, roots, table
from lavoura.llm import queries, suffixes
from lavoura.llm.mixing import mixed
from lavoura.llm.near_text import near_duplicates
from lavoura.llm.passages import levels, without_repeats
from lavoura.llm.suffixes import common_prefixes, suffix_array, without_repeated_bytes
from lavoura.llm.token_files import Shard, encoded, read_tokens, write_tokens


def near_by_hand(rows, width, percent):
    sets = {}
    for d, t, *_ in rows:
        w = tuple((t or "").encode().lower().split())
        sets[d] = {w[i : i + width] for i in range(len(w) - width + 1)} if len(w) >= width else ({w} if w else set())
    pairs = [
        (a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = roots([p for p in pairs if sets[p[1]]], sets)
    return {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    rows = documents()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(clashing(table(spark)), width).collect()}
    assert got == near_by_hand(rows, width, 80)


def test_near_duplicates_of_a_large_group_of_near_copies(spark):
    """A chain and a hub: no bucket fellow links them all, components still are whole."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i : i + 60]), "en", "s", 0) for i in range(0, 300, 3)]
    rows += [(1000 + i, " ".join(words[:100] + [f"x{i}_{j}" for j in range(11)]), "en", "s", 0) for i in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(table(spark, rows), 2).collect()}
    assert got == near_by_hand(rows, 2, 80)


def test_near_duplicates_without_ids_or_rows(spark):
    rows = [(None, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, "A b c", "en", "s", 5)]
    got = sorted(map(tuple, near_duplicates(table(spark, rows), 2).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True)]
    assert near_duplicates(table(spark, []), 2).collect() == []


def test_near_duplicates_of_repeated_ids_with_different_texts(spark):
    """Both texts of id 1 have their own near copies; no link is lost and none is made up."""
    one, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, one, "en", "s", 0), (1, other, "en", "s", 0), (1, one, "en", "s", 0), (2, one + " x", "en", "s", 0), (3, other + " y", "en", "s", 0)]
    rows += [(7, other.upper(), "en", "s", 0), (9, "far away", "en", "s", 0), (9, one.replace("a3 ", "c3 "), "en", "s", 0)]
    got = sorted(map(tuple, near_duplicates(table(spark, rows), 2, with_hash=True).drop("text_hash").collect()))
    want = [(1, 59, 1, True)] * 3 + [(2, 60, 1, False), (3, 60, 1, False), (7, 59, 1, False), (9, 1, 9, True), (9, 59, 1, False)]
    assert got == want


def passages_by_hand(rows, width):
    seen, out = set(), {}
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        bad = set()
        for i in range(len(w) - width + 1):
            run = tuple(w[i : i + width])
            if run in seen:
                bad.update(range(i, i + width))
            seen.add(run)
        kept = b" ".join(x for i, x in enumerate(w) if i not in bad)
        out[d] = (len(w), len(bad), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("width", [20, 7])
def test_repeated_passages(spark, width):
    rows = documents()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in without_repeats(clashing(table(spark)), width, first=width // 2).collect()}
    assert got == passages_by_hand(rows, width)
    assert levels(20, 10) == [10, 20] and levels(20, 5) == [5, 10, 20] and levels(7, 3) == [4, 7]
    assert without_repeats(table(spark, [])).collect() == []


def bytes_by_hand(rows, length):
    texts = {d: (t or "").encode() for d, t, *_ in rows}
    n = Counter(t[i : i + length] for t in texts.values() for i in range(len(t) - length + 1))
    out = {}
    for d, t in texts.items():
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if n[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[:-1]
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[d] = (len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
    return out


def test_repeated_bytes(spark, monkeypatch):
    # Small chunks, so that repeats cross them.
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 3000)
    rows = [r for r in documents() if len(r[1] or "") < 50_000]
    rows += [(900, "a" * 1000, "en", "s", 0), (903, "ab" * 500, "en", "s", 0), (906, "a" * 399, "en", "s", 0)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeated_bytes(clashing(table(spark, rows))).collect()}
    assert got == bytes_by_hand(rows, 400)
    assert without_repeated_bytes(table(spark, [])).collect() == []


@pytest.mark.parametrize("small", [4, 100_000])
def test_suffix_arrays(monkeypatch, small):
    monkeypatch.setattr(suffixes, "SMALL", small)
    rng = np.random.default_rng(7)
    for _ in range(150):
        sigma = int(rng.integers(1, 6))
        s = np.tile(rng.integers(0, sigma, int(rng.integers(1, 50))), int(rng.integers(1, 4)))
        sa = suffix_array(s, sigma)
        text = s.tolist()
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: text[i:])
        shared = common_prefixes(s, sa)
        for a, b in itertools.pairwise(sa.tolist()):
            k = 0
            while max(a, b) + k < len(s) and text[a + k] == text[b + k]:
                k += 1
            assert shared[b] == k


def test_token_files(spark, folder):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("word_bpe_49k.json")
    tokenizer, rows, at, want = Tokenizer.from_file(path), documents(), 0, {}
    rows += [(901, "it's <|endoftext|> été \x1c 12  İ", "en", "s", 0)]
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in encoded(clashing(table(spark, rows)), path).collect()}
    assert got == want
    # Random access: any range of a document's ids, from the file.
    write_tokens(table(spark, rows), f"{folder}/tokens", path)
    texts = {d: t for d, t, *_ in rows}
    for row in read_tokens(spark, f"{folder}/tokens").collect():
        shard = Shard(bytes(row["alphabet"]), bytes(row["rules"]), bytes(row["lengths"]), bytes(row["body"]), row["starts"])
        assert len(shard.body) < row["n_ids"]
        for i, d in enumerate(row["doc_ids"]):
            ids = [*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 1]
            for a, b in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids))):
                assert shard.ids(i, a, b).tolist() == ids[a:b]
    assert encoded(table(spark, []), path).collect() == []


def test_mix(spark):
    rows = documents()
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in rows}
    of_source = defaultdict(int)
    for d, _, _, s, _ in rows:
        of_source[s] += size[d]
    order = sorted(of_source, key=lambda s: (s is None, s or ""))
    weight = dict(zip(order, itertools.cycle((3, 1, 2)), strict=False))
    left, free, target = 1.5 * sum(of_source.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * of_source[s]]
        if not over:
            target |= share
            break
        target |= {s: 2.0 * of_source[s] for s in over}
        left -= sum(2 * of_source[s] for s in over)
        free -= set(over)
    once, again = (sorted(map(tuple, mixed(clashing(table(spark, parts=p))).collect()), key=str) for p in (2, 5))
    assert once == again and len(once) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for d, s, n, whole, goal, took, times in once:
        assert n == size[d] and whole == of_source[s] and goal == pytest.approx(target[s]) and took == times * n <= 2 * n
        taken[s] += took
        largest[s] = max(largest[s], n)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in order)
    assert mixed(table(spark, [])).collect() == []
    assert [r.taken for r in mixed(table(spark, [(1, None, "en", "s", 0)])).collect()] == [0]


def test_mix_prefers_heavier_documents(spark):
    rows = [(i, "w " * 10, "en", "ab"[i % 2], 0) for i in range(2000)]
    heavy = spark.createDataFrame([(i, 4.0) for i in range(0, 2000, 4)], "doc_id long, weight double")
    got = mixed(table(spark, rows), heavy, weights=(1, 1), share=0.5).collect()
    shares = [np.mean([r.times > 0 for r in got if r.source == "a" and (r.doc_id % 4 == 0) == h]) for h in (True, False)]
    assert shares[0] > shares[1] + 0.3 and sum(r.taken for r in got) == pytest.approx(10_000, abs=20)
