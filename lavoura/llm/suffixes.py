"""Repeated byte strings by suffix arrays over what anchors leave open.

Every string of ``length`` bytes has one anchor, the smallest hash among its ``GRAM``-byte
substrings (the rightmost at a tie), at the same place in every copy of the string. An anchor's
context holds all strings it is the anchor of. So

1. chunks tell each other which anchors occur with more than one context, and which contexts
   occur in several places: all strings of a repeated context are repeated;
2. of an anchor with several contexts, one copy of each context goes into its chunk's suffix
   array, sorted by induction; the permuted common prefixes show which of its strings are equal;
3. chunks tell each other which of these strings they share, each distinct one once.

Nothing is compared by anchor or string in one place, so a passage that a third of all documents
share costs no more than any other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.chunks import Chunk, Questions, answers, each_chunk, packed
from lavoura.llm.common import give_back, mixed, rolling, staged

CHUNK_BYTES, BUCKET_BYTES, RANGE_BYTES = 1 << 20, 32 << 20, 16 << 20
#: Bytes of the substrings whose hashes choose anchors.
GRAM = 64
#: Strings of names below this length end the recursion.
SMALL = 100_000
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))


# ---- suffix arrays ---------------------------------------------------------------------------


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S-type); the last suffix is L-type."""
    n = len(s)
    rises = np.zeros(n, np.int8)
    rises[:-1] = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    rises[-1] = -1
    # Equal neighbours have the type of what follows the run.
    decided = np.where(rises != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(decided[::-1])[::-1]
    return rises[nearest] > 0


def _induce(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """Induce the order of all suffixes from that of leftmost-smaller ones, bucket by bucket.

    A whole run of a bucket is induced at once: only suffixes that are preceded by the bucket's
    own symbol come back to it, so a bucket takes as many steps as its longest run.
    """
    n = len(s)
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    heads = ends - counts
    sa = np.full(n, -1, np.int64)

    def dealt(before: np.ndarray):
        """``before`` by symbol, the symbols, and each one's place among those of its symbol."""
        symbols = s[before]
        order = np.argsort(symbols, kind="stable")
        before, symbols = before[order], symbols[order]
        if sigma <= 4096 and len(before) > 64:
            sizes = np.bincount(symbols, minlength=sigma)
            kinds, starts = slice(None), np.cumsum(sizes) - sizes
            return before, symbols, np.arange(len(before)) - starts[symbols], kinds, sizes
        new = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
        sizes = np.diff(np.append(new, len(before)))
        return before, symbols, np.arange(len(before)) - np.repeat(new, sizes), symbols[new], sizes

    # Seeds stand at the ends of their buckets, in order.
    seed_symbols = s[seeds]
    seed_counts = np.bincount(seed_symbols, minlength=sigma)
    by_bucket = seeds[np.argsort(seed_symbols, kind="stable")]
    seed_at = np.concatenate(([0], np.cumsum(seed_counts)))

    used = np.nonzero(counts)[0].tolist()
    filled = heads.copy()  # next free place for larger suffixes (L-type)

    def put(before: np.ndarray) -> None:
        before, symbols, place, kinds, sizes = dealt(before)
        sa[filled[symbols] + place] = before
        filled[kinds] += sizes

    # Suffix n - 1 is preceded by the end of the string, the smallest of all.
    put(np.array([n - 1]))
    for c in used:
        done = heads[c]
        while done < filled[c]:
            upto = filled[c]
            before = sa[done:upto] - 1
            done = upto
            before = before[before >= 0]
            before = before[~smaller[before]]
            if len(before):
                put(before)
        seeded = by_bucket[seed_at[c] : seed_at[c + 1]]
        before = seeded[seeded > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            put(before)

    last = ends.copy()  # one past the next free place for smaller suffixes (S-type), from the right

    def put_back(before: np.ndarray) -> None:
        """``before`` in descending order of what induced it."""
        before, symbols, place, kinds, sizes = dealt(before)
        sa[last[symbols] - 1 - place] = before
        last[kinds] -= sizes

    for c in reversed(used):
        done = ends[c]
        while done > last[c]:
            upto = last[c]
            before = sa[upto:done][::-1] - 1
            done = upto
            before = before[before >= 0]
            before = before[smaller[before]]
            if len(before):
                put_back(before)
        larger = sa[heads[c] : filled[c]][::-1] - 1
        larger = larger[larger >= 0]
        larger = larger[smaller[larger]]
        if len(larger):
            put_back(larger)
    return sa


def suffix_array(s: np.ndarray, sigma: int, most: int | None = None) -> np.ndarray:
    """The suffixes of ``s`` (symbols below ``sigma``) in order, by induced sorting.

    Suffixes are classified, leftmost-smaller substrings are sorted by induction and named, the
    string of names is sorted by recursion where names repeat, and all suffixes are induced
    from that. Recursion ends where ``most`` names or more are left.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    if sigma <= 1 << 16:
        s = s.astype(np.uint16)  # sorted by radix
    smaller = _types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) < 2:
        return _induce(s, smaller, lms, sigma)
    sa = _induce(s, smaller, lms, sigma)
    # Names of the substrings between neighbouring leftmost-smaller places, in sorted order.
    at = np.full(n, -1, np.int64)
    at[lms] = np.arange(len(lms))
    ordered = sa[at[sa] >= 0]
    number = at[ordered]
    lengths = np.append(lms[1:] + 1, n) - lms
    a, b = ordered[:-1], ordered[1:]
    la, lb = lengths[number[:-1]], lengths[number[1:]]
    # A substring that runs to the end of the string differs from every other.
    same = (la == lb) & (number[:-1] != len(lms) - 1) & (number[1:] != len(lms) - 1)
    same = _equal(s, a, b, la, same)
    names = np.empty(len(lms), np.int64)
    ranks = np.concatenate(([0], np.cumsum(~same)))
    names[number] = ranks
    if ranks[-1] + 1 < len(lms):
        shrinks = most is None or len(lms) < most
        order = _suffixes_of_names(names, int(ranks[-1]) + 1) if shrinks else _suffixes_by_doubling(names)
    else:
        order = np.argsort(names)
    return _induce(s, smaller, lms[order], sigma)


def _equal(s: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    """Where s[a:a+length] == s[b:b+length], of the pairs that ``maybe`` are."""
    out = maybe.copy()
    alive = np.flatnonzero(maybe)
    step = 0
    while len(alive):
        alive = alive[length[alive] > step]
        good = s[a[alive] + step] == s[b[alive] + step]
        out[alive[~good]] = False
        alive = alive[good]
        step += 1
    return out


def _suffixes_of_names(names: np.ndarray, sigma: int) -> np.ndarray:
    """As ``suffix_array`` for a string of names.

    Names of a large alphabet are written as two digits each, so that buckets stay large.
    """
    n = len(names)
    if n < SMALL:
        return _suffixes_by_doubling(names)
    if sigma <= 1024:
        return suffix_array(names, sigma)
    base = math.isqrt(sigma - 1) + 1
    sa = suffix_array(np.stack((names // base, names % base), axis=1).ravel(), base, most=n * 19 // 20)
    return sa[sa % 2 == 0] // 2


def _suffixes_by_doubling(names: np.ndarray) -> np.ndarray:
    """Where recursion ends: ranks of runs of 1, 2, 4, ... names until all differ."""
    n, size = len(names), 1
    rank = names.astype(np.int64)
    base = max(n, int(rank.max(initial=0)) + 1) + 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - size)] = rank[size:] + 1
        key = rank * base + after
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            return order
        size *= 2


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: at each place of ``s``, the length of the prefix its suffix
    shares with the one before it in the suffix array.

    Where the two suffixes are preceded by the same symbol, the length is one less than at the
    place before; only the other places are compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    places = np.arange(n)
    follows = np.zeros(n, bool)
    inner = (places > 0) & (before > 0)
    follows[inner] = s[places[inner] - 1] == s[before[inner] - 1]
    alone = np.flatnonzero(~follows)
    length = np.zeros(len(alone), np.int64)
    padded = np.concatenate((s.astype(np.uint16) + 1, np.zeros(8, np.uint16)))
    alive = np.flatnonzero(before[alone] >= 0)
    i, j = alone[alive], before[alone[alive]]
    blocks = np.lib.stride_tricks.sliding_window_view(padded, 8)
    while len(alive):
        eq = blocks[np.minimum(i, n)] == blocks[np.minimum(j, n)]
        eq &= (np.arange(8) + np.maximum(i, j)[:, None]) < n
        run = np.where(eq.all(axis=1), 8, eq.argmin(axis=1))
        length[alive] += run
        go = run == 8
        alive, i, j = alive[go], i[go] + 8, j[go] + 8
    last = np.maximum.accumulate(np.where(~follows, places, 0))
    index = np.cumsum(~follows) - 1
    return length[index] - (places - last)


# ---- anchors ---------------------------------------------------------------------------------


class Anchors:
    """The anchors of one chunk's strings, and the contexts that hold their strings."""

    def __init__(self, chunk: Chunk, length: int):
        joined = np.frombuffer(chunk.joined, np.uint8)
        n, gram = len(joined), min(GRAM, length)
        hashes = rolling(_BYTE[joined], gram)
        low, high = np.repeat(chunk.ends - chunk.lengths, chunk.lengths), np.repeat(chunk.ends, chunk.lengths)
        starts = np.flatnonzero(np.arange(n) + length <= high)
        # The smallest hash of the strings' substrings; the rightmost one at a tie.
        bits = np.uint64(max(1, n).bit_length())
        low_bits = (np.uint64(1) << bits) - np.uint64(1)
        key = (hashes & ~low_bits) | (low_bits - np.arange(len(hashes), dtype=np.uint64))
        width, size = length - gram + 1, 1
        while size * 2 <= width:
            key = np.minimum(key[: len(key) - size], key[size:])
            size *= 2
        if width > size:
            key = np.minimum(key[: len(key) - (width - size)], key[width - size :])
        #: The starts of all strings, and the number of each one's anchor in ``places``.
        self.starts = starts
        anchor = (low_bits - (key[starts] & low_bits)).astype(np.int64)
        # Anchors ascend with the strings.
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        self.places, self.anchor = anchor[new], np.cumsum(new) - 1
        self.keys = hashes[self.places]
        reach = length - gram
        self.left = np.maximum(self.places - reach, low[self.places]) if n else self.places
        self.right = np.minimum(self.places + gram + reach, high[self.places]) if n else self.places
        whole, digest = chunk.joined, xxhash.xxh3_64_intdigest
        self.contexts = np.fromiter(
            (digest(whole[a:b], p - a) for a, b, p in zip(self.left.tolist(), self.right.tolist(), self.places.tolist(), strict=True)),
            np.uint64,
            len(self.places),
        )

    def payload(self, questions: Questions) -> np.ndarray:
        """The context of each distinct anchor, or MANY where this chunk has several."""
        mine = self.contexts[questions.first]
        several = np.zeros(len(mine), bool)
        several[questions.back[self.contexts != mine[questions.back]]] = True
        return np.where(several, MANY, mine.view(np.int64))


MANY = 0
#: Substrings of this length from all over the text, one in each run of as many places. A string
#: all of whose ones do not occur elsewhere cannot be repeated.
FINE = 32


def _fine(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the chosen short substrings."""
    n = len(chunk.joined)
    hashes = rolling(_BYTE[np.frombuffer(chunk.joined, np.uint8)], FINE)
    bits = np.uint64(max(1, n).bit_length())
    low_bits = (np.uint64(1) << bits) - np.uint64(1)
    key, size = (hashes & ~low_bits) | (low_bits - np.arange(len(hashes), dtype=np.uint64)), 1
    while size * 2 <= FINE and len(key) > size:
        key = np.minimum(key[: len(key) - size], key[size:])
        size *= 2
    places = (low_bits - (key & low_bits)).astype(np.int64)
    places = places[np.concatenate((places[:1] == places[:1], places[1:] != places[:-1]))]
    high = np.repeat(chunk.ends, chunk.lengths)
    places = places[places + FINE <= high[places]]
    return places, hashes[places]


# ---- what chunks ask and answer ----------------------------------------------------------------

#: Kinds of questions; a range of kind k has number k * parts + range.
FINE_KIND, ANCHOR_KIND, CONTEXT_KIND = 0, 1, 2


def _shifted(rows: pa.RecordBatch, by: int) -> pa.RecordBatch:
    part = pa.array(rows.column("part").to_numpy() + by, pa.int64())
    return pa.RecordBatch.from_arrays([part, *rows.columns[1:]], ["part", "chunk", "keys", "ranks"])


def _asked(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    for chunk, _ in each_chunk(batches, []):
        anchors = Anchors(chunk, length)
        if not len(anchors.starts):
            continue
        yield _shifted(Questions(_fine(chunk)[1], parts, False).rows(chunk.number), FINE_KIND * parts)
        keys = Questions(anchors.keys, parts, False)
        yield _shifted(keys.rows(chunk.number, anchors.payload(keys)), ANCHOR_KIND * parts)
        yield _shifted(Questions(anchors.contexts, parts, True).rows(chunk.number), CONTEXT_KIND * parts)
        # Not held while the next chunk's are made.
        del chunk, anchors, keys
        give_back()


def _told(table: pa.Table, parts: int) -> pa.Table:
    """Fine substrings: do other chunks have it? Anchors: has it several contexts? Contexts: do
    other chunks have it, and is this the first chunk that has it?"""
    chunks, numbers = np.array(table.column("chunk").to_pylist(), np.int64), table.column("part").to_pylist()
    kind = numbers[0] // parts
    raw = table.column("keys").to_pylist()
    size = 8 if kind == CONTEXT_KIND else 4
    lengths = np.array([len(x) // size for x in raw], np.int64)
    keys = np.frombuffer(b"".join(raw), np.uint64 if size == 8 else np.uint32)
    owner = np.repeat(chunks, lengths)
    order = np.lexsort((owner, keys))
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    yes, more = np.empty(len(keys), bool), np.zeros(len(keys), bool)
    if kind == ANCHOR_KIND:
        payload = np.frombuffer(b"".join(table.column("ranks").to_pylist()), np.int64)[order]
        firsts = payload[np.flatnonzero(new)][group]
        several = np.zeros(group[-1] + 1 if len(group) else 0, bool)
        several[group[(payload != firsts) | (payload == MANY)]] = True
        yes[order] = several[group]
    else:
        yes[order] = np.bincount(group, minlength=1)[group] > 1
        more[order] = new
    ends = np.cumsum(lengths)
    spans = list(zip((ends - lengths).tolist(), ends.tolist(), strict=True))
    return pa.table(
        {
            "chunk": pa.array(chunks, pa.int64()),
            "part": pa.array(numbers, pa.int64()),
            "bits": pa.array([np.packbits(yes[a:b]).tobytes() for a, b in spans], pa.binary()),
            "first": pa.array([np.packbits(more[a:b]).tobytes() if kind == CONTEXT_KIND else None for a, b in spans], pa.binary()),
        }
    )


def _squeezed(x: np.ndarray) -> bytes:
    """Ascending or nearly constant steps, as differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(x, prepend=0).astype(np.int64).tobytes())


def _unsqueezed(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(x, max_output_size=1 << 33), np.int64))


OPEN = "chunk long, marks binary, places binary, members binary, codes binary, several binary"


def _open(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Of each chunk: intervals known to be repeated, and the strings its suffix array covers."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = Chunk(batch, row)
            told = batch.column("told")[row].as_py() or []
            if not told:
                continue
            bits = [{x["part"] - k * parts: x["bits"] for x in told if x["part"] // parts == k} for k in range(3)]
            first = {x["part"] - CONTEXT_KIND * parts: x["first"] for x in told if x["part"] // parts == CONTEXT_KIND}
            anchors = Anchors(chunk, length)
            places, hashes = _fine(chunk)
            fine = Questions(hashes, parts, False)
            alone = ~((fine.answered(bits[FINE_KIND]) | (fine.counts > 1))[fine.back])
            keys = Questions(anchors.keys, parts, False)
            mixed_anchor = keys.answered(bits[ANCHOR_KIND])[keys.back]
            contexts = Questions(anchors.contexts, parts, True)
            repeated = (contexts.answered(bits[CONTEXT_KIND]) | (contexts.counts > 1))[contexts.back]
            own = np.zeros(len(anchors.contexts), bool)
            own[contexts.first[contexts.answered(first)]] = True
            marks = np.stack((anchors.left[repeated], anchors.right[repeated]), axis=1)

            # Strings of one copy of each context of an anchor with several, all of whose chosen
            # short substrings occur elsewhere. Within FINE - 1 places of a string's ends the
            # choice also depends on what is around it, so those are not looked at.
            starts = anchors.starts[(mixed_anchor & own)[anchors.anchor]]
            upto = np.zeros(len(chunk.joined) + 1, np.int64)
            upto[places[alone] + 1] = 1
            upto = np.cumsum(upto)
            starts = starts[upto[starts + length - 2 * FINE + 2] == upto[starts + FINE - 1]]
            codes, members, several = _equal_strings(np.frombuffer(chunk.joined, np.uint8), starts, length)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk.number], pa.int64()),
                    pa.array([marks.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([_squeezed(starts)], pa.binary()),
                    pa.array([_squeezed(members)], pa.binary()),
                    pa.array([codes.tobytes()], pa.binary()),
                    pa.array([np.packbits(several).tobytes()], pa.binary()),
                ],
                ["chunk", "marks", "places", "members", "codes", "several"],
            )
            # Not held while the next chunk's are made.
            del chunk, anchors, places, hashes, fine, alone, keys, mixed_anchor, contexts, repeated, own, marks, starts, upto, codes, members, several
            give_back()


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie within ``length`` of one of ``starts`` (all different)."""
    edges = np.zeros(n + 1, np.int8)
    edges[starts] += 1
    edges[starts + length] -= 1
    return np.cumsum(edges[:-1], dtype=np.int32) > 0


def _equal_strings(joined: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct strings at ``starts`` by suffix array: their fingerprints (ascending), the number
    of the one at each start, and which ones stand at several starts."""
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)
    # The covered text, its pieces separated by symbol 0.
    inside = _covered(starts, length, len(joined))
    covered, number = np.flatnonzero(inside), np.cumsum(inside) - 1
    piece = np.cumsum(np.concatenate(([0], (np.diff(covered) > 1).astype(np.int64))))
    s = np.zeros(len(covered) + int(piece[-1]), np.uint16)
    at = np.arange(len(covered)) + piece
    s[at] = joined[covered].astype(np.uint16) + 1
    begin = at[number[starts]]
    sa = suffix_array(s, 257)
    shared = common_prefixes(s, sa)
    label = np.empty(len(s), np.int64)
    label[sa] = np.cumsum(shared[sa] < length)
    kinds, first, members, sizes = np.unique(label[begin], return_index=True, return_inverse=True, return_counts=True)
    codes = rolling(_BYTE[joined[covered]], length)[number[starts[first]]]
    order = np.argsort(codes, kind="stable")
    place = np.empty(len(kinds), np.int64)
    place[order] = np.arange(len(kinds))
    return codes[order], place[members], (sizes > 1)[order]


def _asked_strings(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, codes in zip(batch.column("chunk").to_pylist(), batch.column("codes").to_pylist(), strict=True):
            if codes:
                yield Questions(np.frombuffer(codes, np.uint64), parts, True).rows(number)


def _kept(batches: Iterator[pa.RecordBatch], length: int, parts: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = Chunk(batch, row)
            edges = np.zeros(len(chunk.joined) + 1, np.int64)
            gone = np.zeros(len(chunk.joined), bool)
            if batch.column("marks")[row].is_valid:
                marks = np.frombuffer(batch.column("marks")[row].as_py(), np.int64).reshape(-1, 2)
                np.add.at(edges, marks[:, 0], 1)
                np.add.at(edges, marks[:, 1], -1)
                codes = np.frombuffer(batch.column("codes")[row].as_py(), np.uint64)
                if len(codes):
                    questions = Questions(codes, parts, True)
                    yes = questions.answered({x["part"]: x["bits"] for x in batch.column("strings")[row].as_py() or []})
                    # Two strings with one fingerprint share its answer.
                    yes = yes[questions.back] | (questions.counts > 1)[questions.back]
                    yes = yes | np.unpackbits(np.frombuffer(batch.column("several")[row].as_py(), np.uint8), count=len(codes)).astype(bool)
                    places, members = _unsqueezed(batch.column("places")[row].as_py()), _unsqueezed(batch.column("members")[row].as_py())
                    gone = _covered(places[yes[members]], length, len(gone))
            gone |= np.cumsum(edges[:-1]) > 0
            removed, spans, digests, texts = [], [], [], []
            joined = np.frombuffer(chunk.joined, np.uint8)
            for end, n in zip(chunk.ends.tolist(), chunk.lengths.tolist(), strict=True):
                mask = gone[end - n : end]
                removed.append(int(mask.sum()))
                kept = chunk.joined[end - n : end]
                if removed[-1]:
                    spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()))
                    kept = joined[end - n : end][~mask].tobytes()
                else:
                    spans.append(0)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
            columns = [pa.array(chunk.ids, pa.int64()), pa.array(chunk.lengths, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns.append(pa.array(texts, pa.binary()))
                names.append("kept_bytes")
            yield pa.RecordBatch.from_arrays(columns, names)


def without_repeated_bytes(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_bytes]) for every row of ``docs``.

    A byte of a text (UTF-8) goes if a string of ``length`` bytes of its document covers it that
    also starts anywhere else, in this document or another; copies may overlap. Strings are those
    of the input and never cross documents. n_spans counts the maximal removed runs; the digest
    is that of the remaining bytes. ``length`` is 64 at least.

    Null and empty texts have no bytes. Null and repeated ids change nothing: every row is a
    document of its own. Other columns of ``docs`` are ignored.
    """
    if length < 2 * FINE:
        raise ValueError(f"length must be {2 * FINE} or more")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks, total = packed(docs, CHUNK_BYTES, BUCKET_BYTES)
    parts = max(1, math.ceil(total / RANGE_BYTES))
    asked = chunks.mapInArrow(lambda it: _asked(it, length, parts), "part long, chunk long, keys binary, ranks binary")
    told = asked.groupBy("part").applyInArrow(lambda t: _told(t, parts), "chunk long, part long, bits binary, first binary")
    told = staged(told.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits", "first")).alias("told")), "bytes-told")
    opened = staged(chunks.join(told, "chunk").mapInArrow(lambda it: _open(it, length, parts), OPEN), "bytes-open")
    questions = opened.select("chunk", "codes").mapInArrow(lambda it: _asked_strings(it, parts), "part long, chunk long, keys binary, ranks binary")
    strings = answers(questions, "strings", whole=True)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text
    joined = chunks.join(opened, "chunk", "left").join(strings, "chunk", "left")
    return joined.mapInArrow(lambda it: _kept(it, length, parts, with_text), schema)
