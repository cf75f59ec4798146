"""MinHash near-duplicates with sequential Bayesian verification.

Each distinct shingle set (copies are one set) gets a MinHash signature; sets that agree on a
band of it are candidates. A candidate pair's signatures are compared batch by batch; after
each batch the pair is dropped if the posterior chance that its similarity reaches the
threshold, given the matches so far and a uniform prior, is below ``miss``. Survivors are
compared on their full shingle sets, so every link is exact.

A bucket of a band may hold a third of all sets, so its pairs are never listed. First every set
is compared with one bucket fellow, the smallest set of the bucket it shares most bands with,
and linked sets become one component. Only buckets that still hold several components are
looked at again, and there only pairs across components, in blocks of bounded size. A block's
task sends back a spanning forest of the links it found, no pairs that are not links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.common import WORDS, components, mixed, rolling, staged, text_bytes

BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
#: Hashes compared between two looks at the posterior.
BATCH = 32
#: Posterior chance of a link below which a candidate is dropped.
MISS = 1e-6
#: Rows of a bucket's block in the search across components.
BLOCK = 1024

_SEEDS = np.random.default_rng(20240501)
_XOR = _SEEDS.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _SEEDS.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words, A-Z lower-cased.

    A text with fewer words is one shingle, the whole sequence; one without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = WORDS.of(words)
    if len(words) < width:
        return rolling(h, len(words)) ^ np.uint64(0x5BD1E995 + len(words))
    runs = rolling(h, width)
    runs.sort()
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The minimum of each of HASHES permutations over a set that is not empty."""
    x = (shingle_set >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 256):
        y = x[i : i + 256, None] ^ _XOR
        y *= _MUL
        np.minimum(best, y.min(axis=0), out=best)
    return best


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a signature."""
    return mixed(rolling(sig.astype(np.uint64), ROWS)[::ROWS] + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def least_matches(threshold: float, miss: float) -> dict[int, int]:
    """Fewest matches among the first t hashes that keep a pair, for t after each batch.

    With a uniform prior the posterior after m matches of t is Beta(m + 1, t - m + 1), whose
    chance above the threshold is that of at most m successes in t + 1 trials.
    """
    out = {}
    for t in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(t + 1, m) * threshold**m * (1 - threshold) ** (t + 1 - m)
        out[t] = m
    return out


def plausible(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the row pairs of two signature arrays that no batch rules out, and their matches."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for t, m in least.items():
        matches += (a[alive, done:t] == b[alive, done:t]).sum(axis=1)
        keep = matches >= m
        alive, matches, done = alive[keep], matches[keep], t
        if not len(alive):
            break
    return alive, matches


def _described(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sizes, digests, bands = [], [], []
            for text in text_bytes(part.column(1)):
                s = shingles(text, width)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bands.append(band_keys(signature(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n_shingles", "digest", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingles(text, width) for text in text_bytes(part.column(2))]
            # Of rows that share an id, the one whose set is meant.
            meant = [i for i, (s, d) in enumerate(zip(sets, part.column(1).to_pylist(), strict=True)) if xxhash.xxh3_128_digest(s.tobytes()) == d]
            sets = [sets[i] for i in meant]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(meant, pa.int64())),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["rep", "sig", "set"],
            )


def _signatures(column) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(-1, HASHES)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * |intersection| >= percent * |union| of two sorted sets."""
    both = len(x) + len(y)
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    z = np.concatenate((x, y))
    z.sort()
    common = int((z[1:] == z[:-1]).sum())
    return 100 * common >= percent * (both - common)


def _verified(batches: Iterator[pa.RecordBatch], percent: int, least: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs that pass the signature batches and then the exact comparison of the full sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            part = part.take(pa.array(plausible(_signatures(part.column("sig_a")), _signatures(part.column("sig_b")), least)[0]))
            sets = zip(part.column("set_a").to_pylist(), part.column("set_b").to_pylist(), strict=True)
            linked = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in sets]
            yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _across(table: pa.Table, percent: int, least: dict[int, int]) -> pa.Table:
    """Links that join components inside each block cell of a bundle: a spanning forest of them.

    A pair is looked at in the bucket of the first band it shares only. Pairs whose components
    the cell has joined already are passed over; of the others the likeliest come first.
    """
    cell = table.column("cell").to_numpy()
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    rep, root, band, group = (table.column(c).to_numpy()[order].copy() for c in ("rep", "comp", "band", "place"))
    sig = _signatures(table.column("sig"))[order]
    bands = sig.reshape(-1, BANDS, ROWS)
    raw = table.column("set").combine_chunks().take(pa.array(order))
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    links: list[tuple[int, int]] = []
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True):
        rows = np.arange(low, high)
        first = group[low]
        two_blocks = (group[rows] != first).any()
        for i in rows[group[rows] == first].tolist():
            others = rows[(root[rows] != root[i]) & ((group[rows] != first) if two_blocks else (rows > i))]
            if not len(others):
                continue
            hits, matches = plausible(np.broadcast_to(sig[i], (len(others), HASHES)), sig[others], least)
            others = others[hits]
            here = (bands[others] == bands[i]).all(axis=2).argmax(axis=1) == band[i]
            others, matches = others[here], matches[here]
            mine = np.frombuffer(raw[i].as_py(), np.uint64) if len(others) else None
            for j in others[np.argsort(-matches, kind="stable")].tolist():
                if root[j] != root[i] and similar(mine, np.frombuffer(raw[j].as_py(), np.uint64), percent):
                    links.append((rep[i], rep[j]))
                    root[low:high][root[low:high] == root[j]] = root[i]
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _cells(members: DataFrame, joined: DataFrame) -> DataFrame:
    """(rep, comp, band, place, cell) of the buckets that hold several components.

    A bucket's rows are cut into blocks, those of its largest component (side 1) apart from the
    rest. A cell is a block of the largest component with one of the rest, or two of the rest;
    ``place`` tells its blocks apart.
    """
    placed = members.join(joined, members.rep == joined.node, "left").select("key", "band", "rep", F.coalesce("component", "rep").alias("comp"))
    split = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    rows = staged(placed.join(split, "key"), "near-open")
    per_comp = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    largest = per_comp.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"))
    sized = largest.select(
        "key",
        F.col("top.comp").alias("top_comp"),
        F.ceil(F.col("top.n") / BLOCK).alias("n_top"),
        F.ceil((F.col("total") - F.col("top.n")) / BLOCK).alias("n_rest"),
    )
    sides = rows.join(staged(sized, "near-sized"), "key").withColumn("side", (F.col("comp") == F.col("top_comp")).cast("int"))
    own_blocks = F.when(F.col("side") == 1, F.col("n_top")).otherwise(F.col("n_rest"))
    sides = sides.withColumn("block", F.pmod(F.xxhash64("rep"), own_blocks))

    def numbers(upto):
        return F.sequence(F.lit(0).cast("long"), F.col(upto) - 1)

    def pair(i, j):
        return F.struct(i.alias("i"), j.alias("j"))

    block = F.col("block")
    of_top = F.transform(numbers("n_rest"), lambda i: pair(i, F.col("n_rest") + block))
    with_rest = F.transform(numbers("n_rest"), lambda j: pair(F.least(block, j), F.greatest(block, j)))
    with_top = F.transform(numbers("n_top"), lambda j: pair(block, F.col("n_rest") + j))
    cell = F.explode(F.when(F.col("side") == 1, of_top).otherwise(F.concat(with_rest, with_top))).alias("c")
    cells = sides.select("rep", "comp", "band", (2 * block + F.col("side")).alias("place"), "key", cell)
    return cells.select("rep", "comp", "band", "place", F.xxhash64("key", "c.i", "c.j").alias("cell"))


def _searching(percent: int, least: dict[int, int]):
    return lambda table: _across(table, percent, least)


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    miss: float = MISS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_hash: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept[, text_hash]) for every row of ``docs``.

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of their sets of
    distinct ``width``-word shingles (A-Z lower-cased, words split at ASCII white space).
    A text with fewer words is one shingle; null and wordless texts have none and link with
    nothing. component_id is the smallest id reachable over links, kept marks that document.
    A row without id is linked with nothing: component_id null, kept true. Rows that repeat
    an id with the same text are one document; with different texts they are documents of their own,
    and a group's kept ones are all those that bear its smallest id. ``text_hash`` is Spark's
    xxhash64 of the text. Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    least = least_matches(percent / 100, miss)
    described = staged(
        docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
            lambda it: _described(it, width), "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>"
        ),
        "near-described",
    )
    known = described.where("doc_id is not null and digest is not null")
    # A class is a distinct set; its number is fixed by writing it.
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("first_id")).withColumn("rep", F.monotonically_increasing_id())
    classes = staged(classes, "near-classes")

    keys = staged(
        known.join(classes, "digest").where("doc_id = first_id").select("rep", "bands").dropDuplicates(["rep"])
        .select("rep", F.posexplode("bands").alias("band", "key")),
        "near-keys",
    )
    shared = keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("c")).where("c > 1")
    members = staged(keys.join(shared, "key"), "near-members")
    wanted = classes.join(members.select("rep").distinct(), "rep").select("rep", "digest", F.col("first_id").alias("doc_id"))
    sets = staged(
        docs.join(wanted, "doc_id").select("rep", "digest", "text").dropDuplicates(["rep", "text"])
        .mapInArrow(lambda it: _sets(it, width), "rep long, sig binary, set binary"),
        "near-sets",
    )

    left = sets.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"), F.col("set").alias("set_b"))

    # Every set against one fellow: linear in the sets, whatever the size of a bucket.
    votes = members.where("rep != pivot").groupBy("rep", "pivot").agg(F.count("*").alias("n"))
    best = votes.groupBy("rep").agg(F.max(F.struct("n", (-F.col("pivot")).alias("p"))).alias("best"))
    pairs = best.select(F.col("rep").alias("a"), (-F.col("best.p")).alias("b"))
    with_sets = pairs.join(left, "a").join(right, "b")
    links = staged(with_sets.mapInArrow(lambda it: _verified(it, percent, least), "a long, b long"), "near-links")

    # What is left: pairs of one bucket in different components. These may be known in parts only
    # by now; that leaves more pairs to look at, not fewer.
    joined = staged(components(links, "near-first", rounds=1), "near-first")
    cells = staged(_cells(members, joined), "near-cells")
    rows = cells.count()
    if rows:
        more = (
            cells.join(sets, "rep")
            .withColumn("bundle", F.pmod("cell", F.lit(math.ceil(rows / BLOCK))))
            .groupBy("bundle")
            .applyInArrow(_searching(percent, least), "a long, b long")
        )
        links = links.union(staged(more, "near-more"))
    joined = staged(components(links, "near-all"), "near-components")
    grouped = classes.join(joined, classes.rep == joined.node, "left").select("digest", "first_id", F.coalesce("component", "rep").alias("group"))
    labels = grouped.groupBy("group").agg(F.min("first_id").alias("class_component"))
    merged = grouped.join(labels, "group").select("digest", "class_component")
    own_id = F.col("doc_id")
    component = F.when(own_id.isNotNull(), F.coalesce("class_component", own_id))
    return described.join(merged, "digest", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == own_id, F.lit(True)).alias("kept"),
        *["text_hash"] * with_hash,
    )
