"""Nearest neighbours inside groups that single precision cannot tell apart."""

import numpy as np

from lavoura.llm.projections import nearest


def nearest_by_hand(x, q, k):
    v = np.array(x)
    cosine = (v * v[q]).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((v[q] * v[q]).sum()))
    order = [i for i in np.lexsort((np.arange(len(v)), -cosine)).tolist() if i != q]
    return order[:k]


def test_nearest_in_tight_groups(spark):
    """1500 jittered and 1500 scaled copies: ties and the last digits decide."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(200, 16))
    jittered = base[0] + 1e-5 * rng.normal(size=(1500, 16))
    scaled = base[1] * 2.0 ** rng.integers(-300, 300, size=(1500, 1))
    x = np.concatenate((base, jittered, scaled))[rng.permutation(3200)]
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, df.where("vec_id % 100 = 0"), k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {q: nearest_by_hand(x, q, 5) for q in range(0, 3200, 100)}
    assert {q: (got[q], want[q]) for q in want if got[q] != want[q]} == {}
