"""Token ids in binary shards compressed by Re-Pair.

A shard holds the ids of consecutive documents. Frequent pairs of neighbouring symbols are
replaced by new symbols, many pairs that cannot overlap at once, until none is frequent. A shard
is one row of a token file: its alphabet, its rules (a pair of symbols each), the length each
rule expands to, the remaining symbols, and each document's place among them. Pairs never cross
documents, so any range of a document's ids can be expanded alone.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lavoura.llm.common import blank_words, in_use, shared_folder, text_bytes

#: Ids of a shard (a longer document is a shard of its own), bytes of text per task.
SHARD_IDS, TASK_BYTES = 1 << 20, 32 << 20
#: Bytes of text encoded together, about.
BLOCK_BYTES = 4 << 20
#: A pair is replaced if it occurs so often; rules per round at most. Rounds go on while there is
#: such a pair and a symbol for it.
LEAST, RULES = 8, 8192
#: Symbols of a shard that fit in 16 bits; with more of them they take 32.
SYMBOLS = 1 << 16

SHARD = (
    "task long, shard long, doc_ids array<long>, starts array<long>, n_ids long, "
    "alphabet binary, rules binary, lengths binary, body binary"
)


# ---- words to ids ----------------------------------------------------------------------------

#: A word and its blank: letters (ASCII and Latin-1, which do not combine) and marks after them, which
#: are encoded alone. Other words are not cut, such as one with a "<", which may be a special token.
_WORD = "^(?P<letters>[a-zà-öø-ÿ]+)(?P<marks>[!-&(-/:;=-@\\[-`{-~]*) $"
#: Words and parts of words kept in a worker before they are dropped.
CACHE_PARTS = 800_000


class Encoder(dict):
    """Ids of words, or of their letters and marks, as little-endian 32-bit integers.

    The tokenizer turns white space into one blank and never joins across it, so a text's ids
    are those of its words (between ASCII blanks).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        # How the model's pieces spell letters beyond ASCII.
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelled = {ord(c): "".join(x for x, _ in cut(c)) for c in map(chr, range(0xE0, 0x100)) if c.isalpha()}

    def clear(self) -> None:
        super().clear()
        self[""] = b""

    def _letters(self, strings: list[str]) -> list[bytes]:
        """As ``_of`` for strings of letters: each is one word to the tokenizer, so it goes to the model directly."""
        tokenize, spelled = self.tokenizer.model.tokenize, self.spelled
        return [array("I", [x.id for x in tokenize(s if s.isascii() else s.translate(spelled))]).tobytes() for s in strings]

    def _of(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _looked_up(self, strings: pa.Array, encode) -> tuple[np.ndarray, list[bytes]]:
        """Distinct strings by number, and the ids of each."""
        told = strings.dictionary_encode()
        names = _listed(told.dictionary)
        found = list(map(self.get, names))
        gaps = [i for i, x in enumerate(found) if x is None]
        if len(self) + len(gaps) > CACHE_PARTS:
            self.clear()
        new = [names[i] for i in gaps]
        for i, name, ids in zip(gaps, new, encode(new), strict=True):
            found[i] = self[name] = ids
        return told.indices.to_numpy(), found

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        in_use(self)
        if not texts:
            return []
        # Lower case makes fewer words; the tokenizer does the same, after looking for special tokens.
        texts = [(t if b"<|" in t else t.lower()).replace(b"\n", b" ") for t in texts]
        told = blank_words(b" ".join([*texts, b""]), utf8=True).dictionary_encode()
        words = told.dictionary
        cut = pc.extract_regex(words, _WORD)
        plain = cut.is_valid().to_numpy(zero_copy_only=False)
        letters, marks = (pc.struct_field(cut, [i]).drop_null() for i in range(2))
        odd = pc.binary_slice(words.filter(pa.array(~plain)).cast(pa.binary()), 0, -1).cast(pa.string())
        # Each word is its first and its second part; an odd one has no second part.
        first, second, known = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [b""]
        # Odd ones as they are: special tokens are looked for before case is changed.
        for strings, encode, to, rows in (
            (letters, self._letters, first, plain), (marks, self._of, second, plain), (odd, self._of, first, ~plain)
        ):
            numbers, found = self._looked_up(strings, encode)
            to[rows] = len(known) + numbers
            known += found
        flat, start, length = np.frombuffer(b"".join(known), "<u4"), *_laid([len(x) >> 2 for x in known])
        parts = np.stack((first, second), axis=1).ravel()
        flat = flat[_runs(start[parts], length[parts])]
        start, length = _laid(length[first] + length[second])
        places = told.indices.to_numpy()
        ids = flat[_runs(start[places], length[places])]
        last = np.cumsum([t.count(b" ") + 1 for t in texts])[:-1]
        return np.split(ids, np.concatenate(([0], np.cumsum(length[places])))[last])


def _laid(lengths) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of runs that lie one after the other."""
    length = np.array(lengths, np.int64)
    return np.cumsum(length) - length, length


def _listed(strings: pa.Array) -> list[str]:
    """Strings without line breaks as a list; quicker than ``to_pylist``."""
    if not len(strings):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings), "\n")[0].as_py().split("\n")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- Re-Pair -----------------------------------------------------------------------------------


def compress(ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(alphabet, rules, lengths, body, places) of ``ids`` cut into documents at ``cuts``.

    Symbols below the alphabet's size stand for its ids, the following ones for the rules.
    ``places`` are the documents' starts in the body.
    """
    present = np.unique(ids)
    size = len(present)
    number = np.zeros(int(present[-1]) + 1 if size else 0, np.uint32)
    number[present] = np.arange(size)
    body = number[ids]
    starts = np.zeros(len(ids) + 1, bool)
    starts[cuts] = True
    rules: list[np.ndarray] = []
    symbols = size
    while True:
        if len(body) < 2:
            break
        # Pairs are one number; half of it for each symbol.
        half, kind = (16, np.uint32) if symbols <= SYMBOLS else (32, np.uint64)
        inner = ~starts[1 : len(body)]
        # In a run of one symbol, pairs from left to right: every other place.
        same = np.flatnonzero(inner & (body[:-1] == body[1:]))
        if len(same):
            first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
            since = np.arange(len(same)) - np.repeat(first, np.diff(first, append=len(same)))
            inner[same[since % 2 == 1]] = False
        keys = (body[:-1].astype(kind) << kind(half)) | body[1:].astype(kind)
        ordered = np.sort(keys[inner])
        edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))) if len(ordered) else np.zeros(1, np.int64)
        counts = np.diff(edge)
        often = np.flatnonzero(counts >= LEAST)
        often = often[np.argsort(-counts[often], kind="stable")[: 2 * RULES]]
        # Pairs of one round share no symbol as left of one and right of another: no overlaps.
        # A pair of equal symbols shares its symbol with itself only.
        lefts, rights, chosen = set(), set(), []
        for key in ordered[edge[often]].tolist():
            x, y = key >> half, key & ((1 << half) - 1)
            if x in rights or y in lefts:
                continue
            lefts.add(x)
            rights.add(y)
            chosen.append(key)
            if len(chosen) == RULES:
                break
        if not chosen:
            break
        pairs = np.sort(np.array(chosen, kind))
        rule = np.stack((pairs >> kind(half), pairs & kind((1 << half) - 1)), axis=1).astype(np.uint32)
        is_left, is_right = np.zeros(symbols, bool), np.zeros(symbols, bool)
        is_left[rule[:, 0]], is_right[rule[:, 1]] = True, True
        at = np.flatnonzero(inner & is_left[body[:-1]] & is_right[body[1:]])
        found = np.searchsorted(pairs, keys[at])
        found[found == len(pairs)] = 0
        hit = pairs[found] == keys[at]
        at, found = at[hit], found[hit]
        body[at] = symbols + found
        keep = np.ones(len(body), bool)
        keep[at + 1] = False
        body = body[keep]
        starts = np.append(starts[:-1][keep], True)
        rules.append(rule)
        symbols += len(pairs)
    table = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    lengths = np.ones(symbols, np.int64)
    done = size
    for group in rules:
        lengths[done : done + len(group)] = lengths[group[:, 0]] + lengths[group[:, 1]]
        done += len(group)
    # A document starts where so many ids come before it.
    before = np.concatenate(([0], np.cumsum(lengths[body])))
    return present, table, lengths[size:], body, np.searchsorted(before, cuts)


def expansions(size: int, rules: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat, start, length): what each symbol stands for is flat[start : start + length]."""
    length = np.concatenate((np.ones(size, np.int64), lengths))
    start = np.concatenate(([0], np.cumsum(length)[:-1])) if len(length) else np.zeros(0, np.int64)
    flat = np.empty(int(length.sum()), np.uint32)
    flat[:size] = np.arange(size)
    done = np.arange(len(length)) < size
    todo = np.arange(len(rules))
    while len(todo):
        ready = todo[done[rules[todo, 0]] & done[rules[todo, 1]]]
        for side, shift in ((0, None), (1, 0)):
            child = rules[ready, side]
            to = start[size + ready] + (0 if shift is None else length[rules[ready, 0]])
            flat[_runs(to, length[child])] = flat[_runs(start[child], length[child])]
        done[size + ready] = True
        todo = todo[~done[size + todo]]
    return flat, start, length


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for length[0] places, then the next."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)


class Shard:
    """A shard read back; ``ids(i, a, b)`` expands only what covers ids a to b of document i."""

    def __init__(self, alphabet: bytes, rules: bytes, lengths: bytes, body: bytes, starts: list[int]):
        self.alphabet = np.frombuffer(alphabet, "<u4")
        kind = "<u2" if len(self.alphabet) + len(lengths) // 4 <= SYMBOLS else "<u4"
        self.rules = np.frombuffer(rules, kind).reshape(-1, 2).astype(np.int64)
        self.body = np.frombuffer(body, kind)
        self.starts = np.array(starts, np.int64)
        self.flat, self.start, self.length = expansions(len(self.alphabet), self.rules, np.frombuffer(lengths, "<u4").astype(np.int64))

    def all_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids before each document."""
        length = self.length[self.body]
        ids = self.alphabet[self.flat[_runs(self.start[self.body], length)]]
        return ids, np.concatenate(([0], np.cumsum(length)))[self.starts]

    def ids(self, document: int, a: int, b: int) -> np.ndarray:
        end = self.starts[document + 1] if document + 1 < len(self.starts) else len(self.body)
        body = self.body[self.starts[document] : end]
        ends = np.cumsum(self.length[body])
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b, side="left") + 1
        part = body[first:last]
        ids = self.alphabet[self.flat[_runs(self.start[part], self.length[part])]]
        skip = a - int(ends[first - 1] if first else 0)
        return ids[skip : skip + b - a]


def _shards(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId(), 0
    own = encoder(path)
    ids, parts, size = [], [], 0

    def row():
        counts = np.array([len(p) for p in parts], np.int64)
        cuts = np.cumsum(counts) - counts
        alphabet, rules, lengths, body, places = compress(np.concatenate(parts), cuts)
        kind = "<u2" if len(alphabet) + len(rules) <= SYMBOLS else "<u4"
        return pa.RecordBatch.from_pydict(
            {
                "task": pa.array([task], pa.int64()),
                "shard": pa.array([made], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "starts": pa.array([places], pa.list_(pa.int64())),
                "n_ids": pa.array([int(counts.sum())], pa.int64()),
                "alphabet": pa.array([alphabet.astype("<u4").tobytes()], pa.binary()),
                "rules": pa.array([rules.astype(kind).tobytes()], pa.binary()),
                "lengths": pa.array([lengths.astype("<u4").tobytes()], pa.binary()),
                "body": pa.array([body.astype(kind).tobytes()], pa.binary()),
            }
        )

    end = np.array([end_id], np.uint32)
    for batch in batches:
        for part in _blocks(batch):
            for doc, found in zip(part.column(0).to_pylist(), own.encode(text_bytes(part.column(1))), strict=True):
                ids.append(doc)
                parts.append(np.concatenate((found, end)))
                size += len(found) + 1
                if size >= SHARD_IDS:
                    yield row()
                    made, ids, parts, size = made + 1, [], [], 0
    if ids:
        yield row()


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text) in turn, some megabytes of text at a time."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(sizes // BLOCK_BYTES)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text of ``docs`` and write token files to ``folder``.

    Shards ascend with the id (null ids last) by (task, shard), documents in a shard likewise.
    A null text is empty: its only id is ``end_id``, which ends every document.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = F.col("doc_id").asc_nulls_last()
    placed = docs.repartitionByRange(max(1, math.ceil(total / TASK_BYTES)), order).sortWithinPartitions(order)
    placed.mapInArrow(lambda it: _shards(it, tokenizer, end_id), SHARD).write.option("compression", "zstd").parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row["alphabet"], row["rules"], row["lengths"], row["body"], row["starts"])
            ids, before = shard.all_ids()
            ends = np.append(before[1:], len(ids))
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(before.tolist(), ends.tolist(), strict=True)]
            n = len(before)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(before, pa.int64()), pa.array(ends - before, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array([row["task"]] * n, pa.int64()), pa.array([row["shard"]] * n, pa.int64()),
                ],
                ["doc_id", "before", "n_tokens", "ids_crc32", "task", "shard"],
            )


def read_tokens(spark, folder: str) -> DataFrame:
    """The shards of token files."""
    return spark.read.schema(SHARD).parquet(folder)


def digests(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of token files, decoded from them.

    start is the number of ids of all documents before it in the files' order.
    """
    shards = read_tokens(spark, folder)
    sizes = shards.select("task", "shard", "n_ids")
    tasks = sizes.groupBy("task").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("ids").over(earlier.orderBy("task")), F.lit(0)).alias("of_task"))
    in_task = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("of_shard", F.coalesce(F.sum("n_ids").over(in_task), F.lit(0))).join(tasks, "task")
    found = shards.mapInArrow(_documents, "doc_id long, before long, n_tokens long, ids_crc32 long, task long, shard long")
    start = F.col("of_task") + F.col("of_shard") + F.col("before")
    return found.join(offsets, ["task", "shard"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as token files in the shared folder and return their ``digests``.

    An empty table gives empty files and no rows; repeated ids are documents of their own, in no
    particular order among each other; other columns are ignored.
    """
    folder = shared_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, end_id, id_col, text_col)
    return digests(docs.sparkSession, folder)
