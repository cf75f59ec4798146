"""What workers hold at once."""

import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import zstandard

from cases import roots
from lavoura.llm import hnsw, pieces, suffixes
from lavoura.llm.queries import tokenizer_file


def chunk_row(number, seed):
    text = np.random.default_rng(seed).integers(97, 122, 5000, np.uint8).tobytes()
    return pa.RecordBatch.from_pydict(
        {
            "chunk": pa.array([number], pa.int64()),
            "ids": pa.array([[number]], pa.list_(pa.int64())),
            "lengths": pa.array([[len(text)]], pa.list_(pa.int64())),
            "texts": pa.array([zstandard.ZstdCompressor().compress(text)], pa.binary()),
        }
    )


def test_a_chunk_is_let_go_before_the_next(monkeypatch):
    made, alive = [], []
    own = suffixes.Anchors

    def noted(*args):
        alive.append(sum(x() is not None for x in made))
        found = own(*args)
        made.append(weakref.ref(found))
        return found

    monkeypatch.setattr(suffixes, "Anchors", noted)
    list(suffixes._asked(iter([chunk_row(i, i) for i in range(4)]), 100, 2))
    assert alive == [0, 0, 0, 0]


def test_segmentations_are_told_a_few_texts_at_a_time():
    texts = [f"the {i} small words of text {i * i}" for i in range(300)] + [None]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(301), pa.int64()), "text": pa.array(texts)})
    model = tokenizer_file("piece_bpe_32k.model")
    told = list(pieces._segmented(iter([batch]), model, 4, True))
    assert max(x.num_rows for x in told) <= 128 and sum(x.num_rows for x in told) == 301
    plain = pa.Table.from_batches(pieces._segmented(iter([batch]), model, 4, False))
    assert pa.Table.from_batches(told).select(plain.column_names).equals(plain)


def one_cell(batches, index):
    """The rows a task of lookups gets: the pieces of a graph, then what is to be looked up."""
    rows = [*index.to_pylist(), *(r | {"shard": 0} for b in batches for r in b.to_pylist())]
    kinds = {f.name: f.type for f in index.schema} | {"block": pa.int64()}
    for row in rows:
        yield pa.RecordBatch.from_pydict({c: pa.array([row.get(c, 0 if c == "block" else None)], kind) for c, kind in kinds.items()})


def test_lookups_among_vectors_that_are_all_alike(monkeypatch):
    """Neither the pairs of a group nor its graph and all that is looked up in it are held at once."""
    monkeypatch.setattr(hnsw, "PIECE", 500)
    monkeypatch.setattr(hnsw, "PAIRS", 1 << 14)
    rng, n = np.random.default_rng(3), 2600
    v = rng.normal(size=(1, 24)) + 0.01 * rng.normal(size=(n, 24))
    v[-4:] = rng.normal(size=(4, 24))
    v[-4:-2] = v[-4:-3] + 0.01 * rng.normal(size=(2, 24))
    v[:1000] = v[:1000].astype(np.float32)
    table = pa.table({"rep": np.arange(n) * 7, "v": pa.array(v.tolist()), "n": np.arange(n) % 3 + 1, "shard": np.zeros(n, np.int64)})
    index = hnsw._index(table)
    assert index.num_rows == 6
    own = {i: x for p in index.to_pylist() for i, x in zip(np.frombuffer(p["ids"], np.int64), hnsw._vectors(p["vectors"], 24, len(p["ids"]) // 8))}
    assert all((own[i * 7] == v[i]).all() for i in range(n))
    cell = list(one_cell(hnsw._queries(table.select(["rep", "v", "n"]).to_batches()), index))
    assert len(cell) == 12
    tracemalloc.start()
    found = pa.Table.from_batches(hnsw._lookups(iter(cell), 0.95, 24)).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # the group's pairs alone have over 100 MB
    weights = np.arange(n) % 3 + 1
    want = {i * 7: int(weights[: n - 4].sum() - weights[i]) for i in range(n - 4)}
    want |= {(n - 4) * 7: int(weights[n - 3]), (n - 3) * 7: int(weights[n - 4])}
    assert {r["a"]: r["n"] for r in found if r["b"] is None} == want
    assert sum(r["n"] is None for r in found) == n - 4
    assert {(r["a"], r["b"], r["n"]) for r in found if r["b"] is not None and r["n"] is not None} == {
        ((n - 4) * 7, (n - 3) * 7, int(weights[n - 3])), ((n - 3) * 7, (n - 4) * 7, int(weights[n - 4]))
    }


def test_a_forest_of_parts_joins_what_the_links_join():
    rng = np.random.default_rng(4)
    forest, links, kept = hnsw.Forest(300), [], []
    for _ in range(5):
        forest.fresh(50)
        a, b = rng.integers(0, 350, 90), rng.integers(0, 300, 90)
        new = forest.add(a, b)
        # Nodes from 300 on are others in each part.
        a = np.where(a >= 300, a + 1000 * len(links), a)
        links.append((a, b))
        kept += list(zip(a[new].tolist(), b[new].tolist(), strict=True))
    every = [x for a, b in links for x in zip(a.tolist(), b.tolist(), strict=True)]
    nodes = {x for pair in every for x in pair}
    assert roots(kept, nodes) == roots(every, nodes)
    assert len(kept) == len(nodes) - len(set(roots(every, nodes).values()))


def test_a_link_seen_from_one_end_counts_for_both(spark):
    rows = [(1, None, 2), (1, 2, 2), (2, 1, 1), (3, None, 70), (3, 4, None), (4, None, 1), (4, 9, 1), (9, 4, 5), (4, 9, 1)]
    got = hnsw._counts(spark.createDataFrame(rows, "a long, b long, n long"))
    assert {tuple(r) for r in got.collect()} == {(1, 2), (2, 1), (3, 70), (4, 1), (9, 5)}
