"""Quality of documents by ordinal regression on graded ratings.

Grades are ordered: 0 toxic, 1 poor, 2 good. One weight vector over hashed words and a few
figures of the text gives a document's score; ordered thresholds cut the scores into grades:
P(grade <= k) = sigmoid(threshold[k] - score). The expected grade ranks documents, the tail
probability of the best grade selects them.

The model is fitted in one task on a bounded sample of labelled documents (``SAMPLE``, those of
the smallest hashes of their ids); scoring covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.common import WordCache, in_use, staged, text_bytes

#: Labelled documents that the model is fitted on at most.
SAMPLE = 8192
GRADES = 3
#: Hashed words; a word counts if so many documents of the sample have it, and if its share among
#: the grades up to some grade and above differ by so many standard errors.
BITS, LEAST_DOCS, LEAST_Z = 18, 8, 7.0
STEPS, RATE, RIDGE = 400, 0.1, 2e-5
#: Chance of the lower grades from which on a document is rejected.
REJECT = 0.5
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_UPPER, _SIGNS, _DIGITS = (bytes(range(65, 91)), _MARKS, b"0123456789")


class WordSlots(WordCache):
    """Slot of each word (bytes), without marks around it and without case; -1 for none."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_MARKS).lower()
        return self.put(word, xxhash.xxh3_64_intdigest(bare) & ((1 << BITS) - 1) if bare else -1)


SLOTS = WordSlots()


def slots(text: bytes) -> np.ndarray:
    """The distinct slots of a text's words, ascending."""
    in_use(SLOTS)
    words = set(text.split())
    found = np.unique(np.fromiter(map(SLOTS.__getitem__, words), np.int64, len(words)))
    return found[1:] if len(found) and found[0] < 0 else found


FIGURES = 9


def figures(text: bytes) -> list[float]:
    """Shares of capitals, marks, digits, repeated lines and words, words like the one before; lengths."""
    n = max(1, len(text))
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    return [
        (n - len(text.translate(None, _UPPER))) / n,
        (n - len(text.translate(None, _SIGNS))) / n,
        (n - len(text.translate(None, _DIGITS))) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(set(words)) / max(1, len(words)),
        sum(map(bytes.__eq__, words, words[1:])) / max(1, len(words)),
        min(len(text) / max(1, len(words)), 40) / 40,
        min(1.0, np.log1p(len(words)) / 12),
        text.count(b"\n") / n * 10,
    ]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[bytes], grades: np.ndarray) -> dict[str, list]:
    """Weights of slots and figures, their scaling, and the ordered thresholds, by maximum
    likelihood with a ridge (Adam on the whole sample)."""
    rows = [slots(t) for t in texts]
    counts = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    owner = np.repeat(grades, counts)
    n = np.array([np.bincount(flat[owner == g], minlength=1 << BITS) for g in range(GRADES)], float)
    share = np.bincount(grades, minlength=GRADES)
    all_n, all_docs = n.sum(axis=0), max(1, len(grades))
    telling = np.zeros(1 << BITS, bool)
    for g in range(GRADES - 1):
        low, high = max(1, share[: g + 1].sum()), max(1, share[g + 1 :].sum())
        error = np.sqrt(all_n / all_docs * (1 - all_n / all_docs) * (1 / low + 1 / high)) + 1e-9
        telling |= np.abs(n[: g + 1].sum(axis=0) / low - n[g + 1 :].sum(axis=0) / high) >= LEAST_Z * error
    known = np.flatnonzero(telling & (all_n >= LEAST_DOCS))
    number = np.full(1 << BITS, -1, np.int64)
    number[known] = np.arange(len(known))
    doc = np.repeat(np.arange(len(rows)), counts)
    slot = number[flat]
    doc, slot = doc[slot >= 0], slot[slot >= 0]
    x = np.array([figures(t) for t in texts]) if texts else np.zeros((0, FIGURES))
    mean, spread = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(FIGURES), np.ones(FIGURES))
    x = (x - mean) / spread
    weight = np.full(len(grades), 1 / all_docs)
    # Parameters: slots, figures, first threshold, logs of the further steps.
    size = len(known) + FIGURES
    w = np.zeros(size + GRADES - 1)
    w[size:] = [-1.0] + [np.log(1.0)] * (GRADES - 2)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        score = np.bincount(doc, weights=w[slot], minlength=len(rows)) + x @ w[len(known) : size]
        cut = np.concatenate(([w[size]], w[size] + np.cumsum(np.exp(w[size + 1 :]))))
        below = np.concatenate((np.zeros((len(rows), 1)), _sigmoid(cut - score[:, None]), np.ones((len(rows), 1))), axis=1)
        pick = np.arange(len(rows))
        high, low = below[pick, grades + 1], below[pick, grades]
        chance = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / chance * weight, low * (1 - low) / chance * weight
        d_score = d_high - d_low
        g = np.empty_like(w)
        g[: len(known)] = np.bincount(slot, weights=d_score[doc], minlength=len(known))
        g[len(known) : size] = x.T @ d_score
        d_cut = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            d_cut[k] = -d_high[grades == k].sum() + d_low[grades == k + 1].sum()
        g[size] = d_cut.sum()
        g[size + 1 :] = [d_cut[k + 1 :].sum() * np.exp(w[size + 1 + k]) for k in range(GRADES - 2)]
        g[:size] += RIDGE * w[:size]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    cut = np.concatenate(([w[size]], w[size] + np.cumsum(np.exp(w[size + 1 :]))))
    return {"slots": known.tolist(), "weights": w[: len(known)].tolist(), "figures": w[len(known) : size].tolist(), "mean": mean.tolist(), "spread": spread.tolist(), "cuts": cut.tolist()}


class Model:
    """A fitted model that scores texts."""

    def __init__(self, fitted: dict[str, list]):
        self.weight = np.zeros(1 << BITS)
        self.weight[np.array(fitted["slots"], np.int64)] = fitted["weights"]
        self.figure, self.mean, self.spread = (np.array(fitted[k]) for k in ("figures", "mean", "spread"))
        self.cuts = np.array(fitted["cuts"])

    def grades(self, texts: list[bytes]) -> np.ndarray:
        """Chances of the grades of each text."""
        score = np.array([self.weight[slots(t)].sum() for t in texts])
        x = np.array([figures(t) for t in texts]).reshape(-1, FIGURES)
        score = score + ((x - self.mean) / self.spread) @ self.figure
        below = np.concatenate((np.zeros((len(texts), 1)), _sigmoid(self.cuts - score[:, None]), np.ones((len(texts), 1))), axis=1)
        return np.diff(below, axis=1)


FITTED = "slots array<long>, weights array<double>, figures array<double>, mean array<double>, spread array<double>, cuts array<double>"


def _fit(table: pa.Table) -> pa.Table:
    fitted = fit(text_bytes(table.column("text").combine_chunks()), table.column("grade").to_numpy().astype(np.int64))
    return pa.table({k: pa.array([v], pa.list_(pa.int64() if k == "slots" else pa.float64())) for k, v in fitted.items()})


def fitted_model(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of the rated documents, or None if there are none.

    ``ratings`` has (doc_id, grade). Of several ratings of a document the lowest counts; null
    ids and grades are left out, and so are documents without text.
    """
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    ids = staged(texts.select("doc_id").join(rated, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "quality-ids")
    # The ids are at most ``sample``, so they are sent to where the texts are.
    chosen = texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    rows = staged(chosen.groupBy(F.lit(1).alias("one")).applyInArrow(_fit, FITTED), "quality-model").collect()
    return Model(rows[0].asDict()) if rows else None


def _scored(batches: Iterator[pa.RecordBatch], model: Model, in_row: int | None) -> Iterator[pa.RecordBatch]:
    """Chances behind (doc_id, text) or (doc_id, row), where ``in_row`` is the text's place in the row."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts = part.column(1) if in_row is None else part.column(1).flatten()[in_row]
            chance = model.grades(text_bytes(texts))
            columns, names = list(part.columns), list(part.schema.names)
            if in_row is None:
                columns, names = columns[:1], names[:1]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(chance @ np.arange(GRADES)), pa.array(chance[:, -1]), pa.array(chance[:, 0])],
                [*names, "expected_grade", "p_good", "p_toxic"],
            )


def graded(docs: DataFrame, ratings: DataFrame, with_row: bool = False, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, [row,] expected_grade, p_good, p_toxic, kept) for every row of ``docs``.

    ``docs`` has doc_id and text, and maybe other columns; ``row`` is a struct of all of them. A
    document is kept if the chance of the best grade is at least 1 - ``REJECT``. Null and empty
    texts are scored as empty. Without ratings nothing is known: expected_grade and the chances
    are null, and everything is kept. Null and repeated ids are rows like others.
    """
    model = fitted_model(docs, ratings, sample)
    second = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if with_row else F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), second)
    chances = ("expected_grade", "p_good", "p_toxic")
    if model is None:
        rows = rows.select("*", *[F.lit(None).cast("double").alias(c) for c in chances])
    else:
        in_row = docs.columns.index("text") if with_row else None
        shape = f"doc_id long, row {rows.schema['row'].dataType.simpleString()}, " if with_row else "doc_id long, "
        rows = rows.mapInArrow(lambda it: _scored(it, model, in_row), shape + ", ".join(f"{c} double" for c in chances))
    kept = F.coalesce(F.col("p_good") >= 1 - REJECT, F.lit(True))
    return rows.select("doc_id", *(["row"] if with_row else []), *chances, kept.alias("kept"))
