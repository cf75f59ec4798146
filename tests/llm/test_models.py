"""Pieces, quality, personal data, vectors and the pipeline."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import clashing, documents, roots, table
from lavoura.llm import hnsw, private, queries
from lavoura.llm.hnsw import near_vectors
from lavoura.llm.pieces import segmented, segmenter
from lavoura.llm.private import base_spans, masked, personal_data, reliabilities
from lavoura.llm.projections import chi_square, confident, nearest
from lavoura.llm.quality import graded

MODEL = queries.tokenizer_file("piece_bpe_32k.model")


def all_segmentations(pieces, text):
    if not text:
        return [(0.0, ())]
    out = []
    for n in range(1, min(len(text), pieces.longest) + 1):
        ids, score = None, 0.0
        if text[:n] in pieces.ids:
            ids = (pieces.ids[text[:n]],)
            score = pieces.score[ids[0]]
        elif n == 1:
            ids, score = tuple(pieces.bytes[b] for b in text[0].encode()), pieces.unknown
        if ids:
            out += [(score + s, ids + rest) for s, rest in all_segmentations(pieces, text[n:])]
    return out


@pytest.mark.parametrize("text", ["to be", "thth.\n the", "a▁b ☃", "  x", "é1é"])
def test_n_best_segmentations(spark, text):
    pieces = segmenter(MODEL).pieces
    every = sorted(all_segmentations(pieces, " " + text), key=lambda x: -x[0])
    row = segmented(table(spark, [(1, text, "en", "s", 0)]), MODEL, n=6, with_ids=True).first()
    assert row.scores == [s for s, _ in every[:6]] and row.score == every[0][0]
    known = dict((ids, s) for s, ids in every)
    assert [known[tuple(ids)] for ids in row.segmentations] == row.scores and len(set(map(tuple, row.segmentations))) == len(row.scores)
    assert row.n_pieces == len(row.segmentations[0])
    assert all(pieces.decode(np.array(ids)) == text.encode() for ids in row.segmentations)


def test_pieces_round_trip(spark):
    rows = documents()
    got = {r.doc_id: r for r in segmented(clashing(table(spark)), MODEL).collect()}
    assert all(got[d].round_trip and got[d].decoded_crc32 == zlib.crc32((t or "").encode()) for d, t, *_ in rows)
    assert {r.n_pieces for d, r in got.items() if not dict((x[0], x[1]) for x in rows)[d]} == {0}
    assert all(r.scores == sorted(r.scores, reverse=True) for r in got.values())
    assert segmented(table(spark, []), MODEL).collect() == []


KIND_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_by_hand(text):
    out = []
    for k, (kind, pattern) in enumerate(KIND_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


TRICKY = [
    "a@b a@b.c x@y.z@w.q .@-.- a@@b.c a@b.c.d@e.f", "1.2.3.4.5 256.1.1.1 1.2.3.4 0001.2.3.4", "4111-1111 1111-1111 9 4111111111111111",
    "+1 (826) 555-4081 190.137.2.1 ++49 30 1234567 +4", "+1.2.3.4.5.6.7.8.9.0 é@ü.de ☃ a%b@c-d.e", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1",
]


def test_base_matches():
    for text in [*TRICKY, *[t or "" for _, t, *_ in documents()]]:
        assert base_spans(text) == spans_by_hand(text)


def test_personal_data(spark):
    rows = documents() + [(1000 + i, t, "en", "s", 0) for i, t in enumerate(TRICKY)]
    got = {r.doc_id: r for r in personal_data(clashing(table(spark, rows))).collect()}
    for d, t, *_ in rows:
        base = [f"{private.KINDS[k]}:{a}:{b}" for a, k, b in spans_by_hand(t or "")]
        assert got[d].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[d].spans.split(",")) | set()
        assert [got[d][f"n_{k}"] for k in private.KINDS] == [sum(x.startswith(k + ":") for x in base) for k in private.KINDS]
    assert personal_data(table(spark, [])).collect() == []
    assert masked("mail a@b.cd now", frozenset()) == "mail [email] now"


def test_reliabilities_find_the_better_labeler():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.5
    votes = np.stack([np.where((rng.random(4000) < p) == truth, 1, -1) for p in (0.95, 0.8, 0.6)], axis=1)
    likely, right, prior = reliabilities(votes.astype(float), np.ones(4000))
    assert right[0] > right[1] > right[2] and abs(right[0] - 0.95) < 0.05 and abs(prior - 0.5) < 0.05
    assert ((likely > 0.5) == truth).mean() > 0.93


def test_quality_on_held_out_labels(spark):
    """Two thirds of the labels train; rejected are toxic and poor ones, good ones are kept."""
    sf = "/root/testdata/sf0.1"
    docs, rated = queries.table(spark, sf, "documents"), queries.ratings(spark, sf)
    got = graded(docs, rated.where("doc_id % 3 != 0")).join(rated.where("doc_id % 3 = 0"), "doc_id")
    kept = {r["grade"]: r["k"] for r in got.groupBy("grade").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    # A third of the toxic labels stand on texts without any sign of it.
    assert kept[2] > 0.97 and kept[1] < 0.05 and kept[0] < 0.4


def test_quality_of_awkward_rows(spark):
    docs = clashing(table(spark))
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert all(r.kept and r.expected_grade is None for r in graded(docs, none).collect())
    some = spark.createDataFrame([(0, 2), (3, 1), (6, 0), (6, 2), (None, 1), (9, None), (12, 2)], "doc_id long, grade int")
    got = graded(docs, some, with_row=True)
    assert got.count() == len(documents()) and got.where("p_good is null or expected_grade is null").count() == 0
    assert got.select("row.*").columns == docs.columns
    assert graded(table(spark, []), some).collect() == []


def vectors(seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 16))
    rows = [*base, *(base[:1] + 0.05 * rng.normal(size=(60, 16))), base[1], base[1], 2 * base[2], np.zeros(16)]
    rows = [x.tolist() for x in rows] + [None, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [], [1.0, 2.0], [2.0, 4.0]]
    return [(i * 5, x) for i, x in enumerate(rows)] + [(None, base[3].tolist())]


def usable(x):
    return bool(x) and all(c is not None and np.isfinite(c) for c in x) and any(x)


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))


def test_near_vectors(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("v", "rep", "n", "c")})
    good = {i: x for i, x in rows if i is not None and usable(x)}
    pairs = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and cosine(good[a], good[b]) >= 0.95]
    root = roots(pairs, [i for i, _ in rows if i is not None])
    want = {i: (sum(i in p for p in pairs), root[i], root[i] == i) for i in root} | {None: (0, None, True)}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()} == want
    assert near_vectors(df.limit(0)).collect() == []


def test_graph_finds_neighbours_across_groups():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 32))
    x[2000:] = x[:10].repeat(100, axis=0) + 0.02 * rng.normal(size=(1000, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = hnsw.Graph.built(x)
    row, place = graph.within(x[:10], np.full(10, -1), 0.95, 16)
    assert len(row) == ((x[:10] @ x.T) >= 0.95).sum()


def test_audit_sees_links_outside_a_large_group(spark, monkeypatch):
    """A narrow beam misses pairs; the links of a third of all vectors must not outweigh them."""
    monkeypatch.setattr(hnsw, "BEAM", 1)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(1500, 24))
    x = np.concatenate((base, base[:700] + 0.15 * rng.normal(size=(700, 24)), base[:1] + 0.02 * rng.normal(size=(1100, 24))))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = dict(enumerate(((unit @ unit.T >= 0.95).sum(axis=1) - 1).tolist()))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
    assert [i for i in want if got[i] != want[i]] == []


def test_audit_judges_each_vector_once(spark):
    truth = [(i, 17_000) for i in range(170)] + [(1000 + i, 2) for i in range(300)]
    found = spark.createDataFrame([(i, n) for i, n in truth if n > 2], "a long, n long")
    truth = spark.createDataFrame(truth, "a long, truth long")
    assert not hnsw._passes(truth, found)
    assert hnsw._passes(truth, found.union(truth.where("truth = 2")))


def test_nearest(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("query", "shard", "v")})
    got = {}
    for r in nearest(df, df.where("vec_id % 10 = 0"), k=5).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    good = {i: x for i, x in rows if i is not None and usable(x)}
    for q in (i for i in good if i % 10 == 0):
        near = sorted((-cosine(good[q], good[i]), i) for i in good if i != q and len(good[i]) == len(good[q]))[:5]
        assert [got.get(q, {})[r + 1][0] for r in range(len(near))] == [i for _, i in near]
        assert np.allclose([got[q][r + 1][1] for r in range(len(near))], [-s for s, _ in near], rtol=1e-12) if near else q not in got
    assert nearest(df.limit(0), df.limit(0)).collect() == []
    assert chi_square(confident(8, 0.99), 8) == pytest.approx(0.99) and confident(8, 0.95) == pytest.approx(15.507, abs=1e-3)


def test_nearest_recall(spark):
    sf = "/root/testdata/sf0.1"
    t = queries.table(spark, sf, "embeddings").orderBy("vec_id").toArrow()
    ids, v = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), float)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = {(r.query_id, r.vec_id) for r in queries.op10_projections(spark, sf).collect()}
    found = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[i]
        s[i] = -2
        near = ids[np.argsort(-s)[:5]]
        found, total = found + sum((ids[i], j) in hits for j in near), total + 5
    assert found >= 0.99 * total


def test_pipeline_stages(spark, folder):
    """Every stage on awkward rows with further columns, then on none."""
    sf = "/root/testdata/sf0.01"
    for docs in (clashing(table(spark)), table(spark, [])):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            path = f"{folder}/{n}-{name.replace(' ', '-')}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns == columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
        assert last.where("not round_trip").count() == 0 and last.count() == docs.count()


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    rows = documents() + [(None, "a b c d e f", "en", "s", 0)] * 2 + [(0, "other", "en", "s", 0)] * 2
    kept = corpus_pipeline.near_duplicate_groups(spark, table(spark, rows), "").collect()
    # The id's other text is a document of its own, and its copy is not.
    assert sum(r.doc_id == 0 and r.text == "other" for r in kept) == 1
    texts = [r.text for r in kept if r.doc_id is not None]
    words = [t for t in texts if t and t.split()]
    assert len({b" ".join(t.encode().lower().split()) for t in words}) == len(words)
    assert sum(r.doc_id is None for r in kept) == 2
