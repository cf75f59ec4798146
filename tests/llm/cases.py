"""Documents with awkward rows, and plain versions of what operators compute."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("rep", "key", "component", "chunk", "size", "slice", "before", "weight", "row", "kept_id", "target", "words_20", "told", "copy")


def word(rng) -> str:
    return "".join(rng.choice(["ba", "no", "ri", "tel", "sun", "é", "Qu"]) for _ in range(rng.randint(1, 4)))


def prose(rng, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def documents(seed: int = 1) -> list[tuple]:
    """Prose with copies, near copies, shared passages, empty and null texts, a long one, ties."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 120)) for _ in range(12)]
    passage = prose(rng, 130)
    texts = list(base)
    texts += [base[0], base[0], base[1]]  # exact copies
    texts += [base[2] + " extra words", base[2].upper(), base[3].replace(" ", "\n", 5)]
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(4)]
    texts += ["", None, " \t\n ", "one", "one", "two words", "ONE", prose(rng, 20_000), passage + " " + passage]
    texts += ["mail a.b@c.de, ip 10.0.0.1, card 4111 1111 1111 1111, call +1 (826) 555-4081", "a▁b ☃ \U0001f600\n\n  x"]
    rows = [(i * 3, t, "en", ["s1", "s2", "s1", None][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def table(spark, rows=None, parts: int = 3):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING})


def roots(pairs, nodes) -> dict:
    """The smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}
