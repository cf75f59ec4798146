"""The queries give the pieces themselves, not only digests of them."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from cases import documents, table
from lavoura.llm import pieces as module
from lavoura.llm import queries
from lavoura.llm.pieces import Pieces, Segmenter, segmenter


@pytest.mark.parametrize("name", ["op1_pieces", "pipeline"])
def test_ids_and_texts_of_all_segmentations(spark, folder, name):
    rows = documents()
    if name == "pipeline":
        found = corpus_pipeline.STAGES[-1][1](spark, table(spark), "")
    else:
        table(spark).write.parquet(f"{folder}/documents.parquet")
        found = queries.op1_pieces(spark, folder)
    pieces, texts = segmenter(queries.tokenizer_file("piece_bpe_32k.model")).pieces, {d: t or "" for d, t, *_ in rows}
    got = found.collect()
    assert len(got) == len(rows) and max(len(r.segmentations) for r in got) == 4
    for r in got:
        assert len(r.segmentations) == len(r.scores) == len(r.decoded) == len(set(map(tuple, r.segmentations)))
        assert set(r.decoded) == {texts[r.doc_id]}
        assert [pieces.decode(np.array(x, np.int64)).decode() for x in r.segmentations] == r.decoded
        assert len(r.segmentations[0]) == r.n_pieces and zlib.crc32(np.array(r.segmentations[0], "<u4").tobytes()) == r.ids_crc32


def every_segmentation(pieces, text):
    """All segmentations of a text in order: best score first, then the longer last piece, and so on."""
    if not text:
        return [(0.0, (), ())]
    out = []
    for start, score in pieces.edges_to(text, len(text)):
        own = tuple(pieces.ids_of(text[start:]))
        out += [(s + score, (start, *starts), ids + own) for s, starts, ids in every_segmentation(pieces, text[:start])]
    return sorted(out, key=lambda x: (-x[0], x[1]))


def test_n_best_with_ties_is_in_the_stated_order():
    pieces = Pieces(queries.tokenizer_file("piece_bpe_32k.model"))
    for text in ("aaaaaaaaaaaa", " banana", "mississippi", "☃☃a", "--------", "ananananan", "\n"):
        want = [(score, ids) for score, _, ids in every_segmentation(pieces, text)]
        for n in (1, 2, 5, 40):
            assert pieces.n_best(text, n) == want[:n]
        assert np.frombuffer(pieces.best([text])[0][0], "<u4").tolist() == list(want[0][1])


def test_long_stretches_take_bounded_memory():
    """Stretches without blanks: random letters, and one letter over and over."""
    pieces = Pieces(queries.tokenizer_file("piece_bpe_32k.model"))
    rng = random.Random(2)
    for text in ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)), "a" * 50_000):
        tracemalloc.start()
        found = pieces.n_best(text, 4)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200 << 20
        assert len({ids for _, ids in found}) == 4 and [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
        assert all(b"".join(pieces.spelled[i] for i in ids) == text.encode() for _, ids in found)


def some_texts(rng, common):
    """Texts of common words, words of their own, characters without a piece and long stretches."""
    def word(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    rare = [[word(rng.randint(1, 12)) for _ in range(30)] for _ in range(40)]
    return [None, "", " ", "\n\n", "☃é\u2581 ", word(60), *[" ".join(rng.sample([*common, *common, *words, "(☃),"], 70)) for words in rare]]


def test_words_in_use_stay_when_the_cache_is_full(monkeypatch):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    common, rng = [f"common{chr(97 + i)}" for i in range(20)], random.Random(5)
    batches = [pa.RecordBatch.from_pydict({"doc_id": list(range(46)), "text": some_texts(rng, common)}) for _ in range(12)]

    def rows():
        monkeypatch.setitem(module._SEGMENTERS, path, Segmenter(path))
        return pa.Table.from_batches(module._segmented(iter(batches), path, 4, True)).to_pylist()

    wanted, asked, plain = rows(), [], Pieces._side_by_side
    monkeypatch.setattr(Pieces, "_side_by_side", lambda self, stretches, length: asked.extend(stretches) or plain(self, stretches, length))
    monkeypatch.setattr(module, "CACHE_BYTES", 400_000)
    assert rows() == wanted
    assert len(asked) > len(set(asked)) and max(asked.count(f" {w}") for w in common) == 1
    assert all(set(r["decoded"]) == {t or ""} for r, t in zip(wanted, (t for b in batches for t in b.column("text").to_pylist()), strict=True))


def test_a_string_without_a_piece_is_looked_up_about_once(monkeypatch):
    pieces, slots, plain = Pieces(queries.tokenizer_file("piece_bpe_32k.model")), [], Pieces._slot
    monkeypatch.setattr(Pieces, "_slot", staticmethod(lambda keys, table: slots.append(len(keys)) or plain(keys, table)))
    keys = np.random.default_rng(3).integers(0, 1 << 63, 10_000).astype(np.uint64)
    assert (pieces._lookup(keys) == -1).all() and sum(slots) < 11_000
    slots.clear()
    for piece, i in list(pieces.ids.items())[::7]:
        assert pieces._lookup(Pieces._hash(np.array([[ord(c) for c in piece]], np.uint64))).tolist() == [i]
