"""Spelling variants by reduced alphabets.

Letters are hashed to a few symbols, so words become reduced words, and one edit of a word is one
edit of its reduced word or none at all. Each word generates the full one-edit neighbourhood of its
reduced word; joining it with the vocabulary's reduced words brings all near words and some others,
which the original strings sort out. The number of symbols follows the vocabulary, so that the
candidates of a word stay few.

Before the join, a bit filter of bounded size drops neighbours that no word reduces to. A reduced
word that more than HOT words share is joined once more finely: there the neighbours are those
original strings one edit away that reduce to it.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.common import mixed, staged
from lavoura.llm.filters import BitFilter, bit_filter

#: Words counted in a task before it sends them on.
HELD_WORDS = 200_000
#: Reduced words of one length for each word of that length, about.
SPARSE = 16
#: Words with the same reduced word from which on it is joined by original strings.
HOT = 256
#: Neighbours made at once in a task.
MADE = 1 << 21

# ---- fixed values: letters, and the runs that count as words -----------------------------------
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_BASE = 0x9E3779B97F4A7C15


def counted(batches: Iterator[pa.RecordBatch], least_length: int, drop_every: int) -> Iterator[pa.RecordBatch]:
    """(word, n): words of the texts after the deletions, counted in part."""
    # Runs that are too short make no word, and a deletion only shortens them.
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_length)
    held: Counter = Counter()

    def row():
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                # bytes.lower() changes A-Z only.
                for run, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % drop_every == 0:
                        place = h % len(run)
                        run = run[:place] + run[place + 1 :]
                        if len(run) < least_length:
                            continue
                    held[run] += n
                if len(held) >= HELD_WORDS:
                    yield row()
                    held.clear()
    if held:
        yield row()


def symbols_of(words: int, length: int) -> int:
    """Fewest symbols that leave SPARSE reduced words of the least length to each word."""
    symbols = 4
    while symbols**length < SPARSE * words and symbols < len(_LETTERS):
        symbols += 1
    return symbols


class Alphabet:
    """Reduction of words to ``symbols`` symbols, and keys of reduced words and their neighbours."""

    def __init__(self, symbols: int):
        self.symbols = symbols
        points = np.arange(0x100, dtype=np.uint64)
        # Symbols count from 1, so that the key tells how many there are.
        self.of_point = (mixed(points * np.uint64(_BASE) + np.uint64(1)) % np.uint64(symbols) + np.uint64(1)).astype(np.uint64)

    def reduced(self, words: list[str]) -> np.ndarray:
        """Symbols of words of one length, a row for each."""
        raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
        return self.of_point[raw]

    def key(self, word: str) -> int:
        return int(self.keys(self.reduced([word]))[0])

    @staticmethod
    def keys(rows: np.ndarray) -> np.ndarray:
        """The key of each row of symbols: a polynomial in them, to 64 bits."""
        out = np.zeros(len(rows), np.uint64)
        for column in rows.T:
            out = out * np.uint64(_BASE) + column
        return out

    def neighbours(self, rows: np.ndarray) -> np.ndarray:
        """Keys of each row itself and of all rows one deletion, replacement or insertion away."""
        n, length = rows.shape
        power = np.array([pow(_BASE, i, 1 << 64) for i in range(length + 2)], np.uint64)
        before = np.zeros((n, length + 1), np.uint64)  # polynomial of what precedes a place
        for i in range(length):
            before[:, i + 1] = before[:, i] * np.uint64(_BASE) + rows[:, i]
        whole = before[:, length :]
        # ... and of what follows it: the whole less what precedes, moved up.
        after = whole - before * power[length - np.arange(length + 1)]
        signs = np.arange(1, self.symbols + 1, dtype=np.uint64)
        places = power[length - 1 - np.arange(length)]
        deleted = before[:, :-1] * places + after[:, 1:]
        # With an open place, that any symbol may fill.
        replaced = (before[:, :-1] * power[length - np.arange(length)] + after[:, 1:])[:, :, None] + signs * places[:, None]
        opened = before * power[length + 1 - np.arange(length + 1)] + after
        inserted = opened[:, :, None] + signs * power[length - np.arange(length + 1)][:, None]
        return np.concatenate((whole, deleted, replaced.reshape(n, -1), inserted.reshape(n, -1)), axis=1)


def string_key(word: str) -> int:
    """A 64-bit key of an original string."""
    return xxhash.xxh3_64_intdigest(word.encode()) - (1 << 63)


def _keyed(batches: Iterator[pa.RecordBatch], alphabet: Alphabet) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        keys = np.zeros(len(words), np.uint64)
        for places, same in _by_length(words):
            keys[places] = alphabet.keys(alphabet.reduced(same))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(keys.view(np.int64)), pa.array([string_key(w) for w in words], pa.int64())],
            ["word", "n", "key", "exact"],
        )


def _by_length(words: list[str], symbols: int = 0) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words of one length, so many that their neighbours are about MADE at most."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        step = max(1, MADE // (1 + length + symbols * (2 * length + 1)))
        for at in range(0, len(places), step):
            some = places[at : at + step]
            yield some, [words[i] for i in some.tolist()]


def _neighbourhoods(batches: Iterator[pa.RecordBatch], alphabet: Alphabet, known: BitFilter) -> Iterator[pa.RecordBatch]:
    """(seeker, key): the neighbours of each word's reduced word that may be reduced words themselves."""
    for batch in batches:
        for _, words in _by_length(batch.column(0).to_pylist(), alphabet.symbols):
            made = alphabet.neighbours(alphabet.reduced(words))
            row, column = np.nonzero(known.holds(made.ravel()).reshape(made.shape))
            key = made[row, column]
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            taken = pa.array(words, pa.string()).take(pa.array(row[new]))
            yield pa.RecordBatch.from_arrays([taken, pa.array(key[new].view(np.int64))], ["seeker", "key"])


def _edits(word: str) -> Iterator[str]:
    """All strings one edit from a word, some more than once."""
    letters = [c for c in _LETTERS if not "A" <= c <= "Z"]
    for i in range(len(word) + 1):
        before, after = word[:i], word[i + 1 :]
        if i < len(word):
            yield before + after
            yield from (before + c + after for c in letters if c != word[i])
        yield from (before + c + word[i:] for c in letters)


def _fine(batches: Iterator[pa.RecordBatch], alphabet: Alphabet) -> Iterator[pa.RecordBatch]:
    """(seeker, key, exact): original strings one edit from a word that reduce to the key."""
    for batch in batches:
        for word, key in zip(batch.column("seeker").to_pylist(), batch.column("key").to_pylist(), strict=True):
            found = set()
            for some in itertools.batched(_edits(word), 4096):
                for _, same in _by_length(sorted({*some} - {""})):
                    hits = np.flatnonzero(alphabet.keys(alphabet.reduced(same)).view(np.int64) == key)
                    found.update(string_key(same[i]) for i in hits.tolist())
            columns = [pa.array([word] * len(found), pa.string()), pa.array([key] * len(found), pa.int64()), pa.array(sorted(found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["seeker", "key", "exact"])


def near_words(vocabulary: DataFrame, least_length: int = 1) -> DataFrame:
    """(word, near, near_n) for all pairs of ``vocabulary`` (word, n) that are one edit apart, both ways.

    Words are distinct strings of the letters a-z and U+00C0 to U+00FF, ``least_length`` at least.
    """
    size = vocabulary.count()
    alphabet = Alphabet(symbols_of(size, least_length))
    shape = "word string, n long, key long, exact long"
    keyed = staged(vocabulary.select("word", "n").mapInArrow(lambda it: _keyed(it, alphabet), shape), "spell-keyed")
    known = vocabulary.sparkSession.sparkContext.broadcast(bit_filter(keyed.select("key"), size))
    made = keyed.select("word").mapInArrow(lambda it: _neighbourhoods(it, alphabet, known.value), "seeker string, key long")
    made = staged(made, "spell-made")
    hot = staged(keyed.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select("key"), "spell-hot")
    # HOT words at most share a reduced word here; the others are met by original strings.
    usual = made.join(keyed.join(hot, "key", "left_anti"), "key")
    fine = made.join(hot, "key").mapInArrow(lambda it: _fine(it, alphabet), "seeker string, key long, exact long")
    fine = fine.join(keyed.join(hot, "key", "left_semi"), ["key", "exact"])
    pair = [F.col("seeker").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")]
    one_edit = F.expr("levenshtein(word, seeker, 1) = 1")
    return usual.where(one_edit).select(pair).unionByName(fine.where(one_edit).select(pair))


def last_of(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``forms`` (word, form) from each word ends; steps double."""
    now = staged(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "spell-roots")
        if moved.where("went").isEmpty():
            return now
        now = moved.drop("went")


def variants(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    times: int = 5,
    drop_every: int = 199,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of ``docs``.

    Runs are maximal runs of ``[A-Za-z`` and U+00C0 to U+00FF ``]``, A-Z in lower case. Where
    ``drop_every`` divides the CRC-32 of ``<doc_id>:<run>``, the run loses the code point at that
    CRC-32 modulo its length. Words are the distinct results of ``least_length`` code points and
    ``least_count`` occurrences at least. Near words differ by one inserted, deleted or replaced
    code point. The form is the near word of largest n (at a tie the smallest in code-point order)
    if its n is ``times`` the word's n at least, else null; root is the end of the chain of forms.

    Null and empty texts have no words. A null id counts as an empty one in the CRC-32, and rows
    that repeat an id are documents of their own. Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    partial = docs.mapInArrow(lambda it: counted(it, least_length, drop_every), "word string, n long")
    vocabulary = staged(partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "spell-vocabulary")
    near = near_words(vocabulary, least_length)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    )
    told = vocabulary.join(best, "word", "left")
    has_form = -F.col("best.less") >= times * F.col("n")
    told = staged(
        told.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        ),
        "spell-forms",
    )
    roots = last_of(told.where("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
