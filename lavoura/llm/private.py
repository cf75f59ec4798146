"""Personal data by weak supervision.

Four kinds of base matches (email, ip, card, phone) are fixed patterns. Beyond them, a wider
pattern per kind yields candidates on which labelers vote for, against, or not at all: the
candidate's own form, gazetteers of words around it, and other context. Votes are counted over
all documents; expectation-maximisation estimates how reliable each labeler is and how likely
each combination of votes is personal data. A logistic classifier of spans is then trained on
these likelihoods, and candidates it accepts are added to the base matches.

A candidate is described by a small code (kind, votes, form), so what is trained on are counts
of codes: their number has a bound whatever the number of documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = 5
#: A candidate's likelihood from which on it is personal data.
ACCEPT = 0.5

# ---- fixed values: base patterns ---------------------------------------------------------------
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# ---- candidates and what labelers look for ------------------------------------------------------
_WIDE = (
    re.compile(r"[A-Za-z0-9._%+-]+\s?(?:\[at\]|\(at\)|\[@\])\s?[A-Za-z0-9-]+(?:\s?(?:\.|\[dot\]|\(dot\))\s?[A-Za-z0-9-]+)+"),
    re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])"),
    re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20.-][0-9]{4}){3}(?![0-9])"),
    re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
_FOR = (
    ("mail", "contact", "write", "reach", "address", "correo", "courriel"),
    ("ip", "host", "server", "address", "client", "login"),
    ("card", "visa", "credit", "payment", "account", "karte", "carte", "tarjeta"),
    ("phone", "tel", "call", "fax", "mobile", "contact", "reach", "ring", "dial"),
)
_AGAINST = (
    ("example of", "format"),
    ("version", "mac", "hash"),
    ("isbn", "serial", "order no", "invoice"),
    ("isbn", "serial", "version", "total", "page", "invoice", "part no"),
)
_NEAR = 32
#: What a text must have for the wider pattern of a kind to match at all.
_DIGIT = re.compile(r"[0-9]{3}")
_MARK = (
    lambda text: "[at]" in text or "(at)" in text or "[@]" in text,
    lambda text: text.count(":") >= 7,
    lambda text: _DIGIT.search(text),
    lambda text: _DIGIT.search(text),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, leftmost and non-overlapping per kind, in order."""
    found = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            found.append((start, 0, end))
        at = text.find("@", end if match else at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, code) of base matches and of wider matches that touch none of them."""
    spans = [(*x, True) for x in base]
    taken = list(base)
    for kind, pattern in enumerate(_WIDE):
        if not _MARK[kind](text):
            continue
        for m in pattern.finditer(text):
            if not any(a < m.end() and m.start() < b for a, _, b in taken):
                spans.append((m.start(), kind, m.end(), False))
                taken.append((m.start(), kind, m.end()))
    out = []
    for start, kind, end, strict in spans:
        around = text[max(0, start - _NEAR) : start].lower()
        digits = sum(map(str.isdigit, text[start:end]))
        votes = (
            # Form: the base pattern, or a length that is usual for the kind.
            1 if strict else 0,
            # Gazetteers of words before the match.
            1 if any(w in around for w in _FOR[kind]) else 0,
            -1 if any(w in around for w in _AGAINST[kind]) else 0,
            # Context: other matches nearby; marks that join it to something longer.
            1 if any(0 < abs(start - a) <= 4 * _NEAR for a, _, _ in taken) else 0,
            -1 if text[end : end + 1] in ("%", "€", "$", "=", "/", "_") or text[start - 1 : start] in ("=", "/", "_", "$", "€") else 1,
        )
        usual = ((0, 40), (4, 32), (14, 19), (10, 15))[kind]
        form = 2 * (usual[0] <= digits <= usual[1]) + (len(set(text[start:end])) > 4)
        code = (kind * 4 + form) * 2 + strict
        for v in votes:
            code = code * 3 + v + 1
        out.append((start, kind, end, code))
    return sorted(out)


def decoded(code: int) -> tuple[int, int, bool, list[int]]:
    votes = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        votes.insert(0, v - 1)
    code, strict = divmod(code, 2)
    kind, form = divmod(code, 4)
    return kind, form, bool(strict), votes


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote rows (-1, 0, 1) that occur ``n`` times.

    Returns each row's likelihood, each labeler's chance to be right when it votes, and the prior.
    """
    right, prior = np.full(votes.shape[1], 0.75), 0.5
    likely = np.full(len(votes), prior)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + votes @ np.log(right / (1 - right))
        likely = 1 / (1 + np.exp(-odds))
        agree = (votes == 1) * likely[:, None] + (votes == -1) * (1 - likely)[:, None]
        cast = (votes != 0) * n[:, None]
        # A weak prior keeps labelers that hardly vote near 3 in 4, and all better than chance.
        right = np.clip(((agree * n[:, None]).sum(axis=0) + 7.5) / (cast.sum(axis=0) + 10), 0.55, 0.99)
        prior = float(np.clip((likely * n).sum() / max(n.sum(), 1), 0.05, 0.95))
    return likely, right, prior


def span_classifier(codes: list[int], n: np.ndarray) -> dict[int, float]:
    """The likelihood of each code by logistic regression on the estimated likelihoods."""
    if not codes:
        return {}
    rows = [decoded(c) for c in codes]
    votes = np.array([r[3] for r in rows], float)
    likely, _, _ = reliabilities(votes, n.astype(float))
    x = np.zeros((len(codes), 1 + LABELERS + len(KINDS) + 3))
    x[:, 0] = 1
    x[:, 1 : 1 + LABELERS] = votes
    for i, (kind, form, strict, _) in enumerate(rows):
        x[i, 1 + LABELERS + kind] = 1
        x[i, -3:] = strict, form & 1, form >> 1
    w, weight = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(50):  # Newton's steps with a weak ridge
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weight * (p - likely)) + 1e-4 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
        w -= np.linalg.solve(curve, slope)
    return dict(zip(codes, (1 / (1 + np.exp(-x @ w))).tolist(), strict=True))


def _texts(column) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("code", pa.int64())]))
    for batch in batches:
        rows = []
        for text in _texts(batch.column(1)):
            rows.append([dict(zip(("start", "kind", "end", "code"), c, strict=True)) for c in candidates(text, base_spans(text))])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, shape)], ["doc_id", "found"])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _reported(batches: Iterator[pa.RecordBatch], accepted: frozenset[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, spans = [[], [], [], []], [], []
        for found in batch.column(1).to_pylist():
            base = [(c["start"], c["kind"], c["end"]) for c in found if decoded(c["code"])[2]]
            more = [(c["start"], c["kind"], c["end"]) for c in found if c["code"] in accepted and not decoded(c["code"])[2]]
            for k in range(4):
                counts[k].append(sum(s[1] == k for s in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(base + more))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(spans)],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
        )


def _accepted(found: DataFrame) -> frozenset[int]:
    """Codes of candidates that count as personal data; their counts cover all documents."""
    rows = found.select(F.explode("found.code").alias("code")).groupBy("code").agg(F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: r["code"])
    likely = span_classifier([r["code"] for r in rows], np.array([r["n"] for r in rows], float))
    return frozenset(c for c, p in likely.items() if p >= ACCEPT)


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shape = "doc_id long, found array<struct<start: long, kind: int, end: long, code: long>>"
    return staged(docs.mapInArrow(_scan, shape), "private-found")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs``.

    The counts and the digest are those of the base matches; ``spans`` also holds what the
    method adds, of the same kinds and touching no base match. Places are code points, ends
    exclusive. A null or empty text has no match. Null and repeated ids are rows like others;
    other columns of ``docs`` are ignored.
    """
    found = _found(docs, id_col, text_col)
    accepted = _accepted(found)
    return found.mapInArrow(
        lambda it: _reported(it, accepted),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )


def masked(text: str, accepted: frozenset[int]) -> str:
    """``text`` with each match replaced by its kind in brackets; of overlapping ones the first."""
    out, at = [], 0
    for start, kind, end, code in candidates(text, base_spans(text)):
        if start >= at and (decoded(code)[2] or code in accepted):
            out += [text[at:start], f"[{KINDS[kind]}]"]
            at = end
        elif start < at < end and (decoded(code)[2] or code in accepted):
            at = end  # the rest of an overlapping match goes too
    return "".join(out) + text[at:] if out else text


def without_personal_data(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with masked texts, and ``length_col`` set to their lengths; null texts stay null."""
    found = _found(docs.withColumn("_id", F.lit(0)), "_id", text_col)
    accepted = _accepted(found)
    place = docs.columns.index(text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else masked(x, accepted) for x in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    out = docs.mapInArrow(mask, docs.schema)
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.length(text_col)).cast(kind))
    return out
