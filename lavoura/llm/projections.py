"""Nearest neighbours by few stable projections and a kd-tree.

Every vector, scaled to length one, is projected to ``dims`` random directions with normal
components, a stable distribution: the squared distance of two projections, over that of the
vectors, follows a chi-square law with ``dims`` degrees of freedom. A kd-tree over the
projections yields a query's neighbours there leaf by leaf in ascending distance; each is
compared with the query in single precision, and all that rounding may have put below the k-th
best in double precision on the original vectors. The search of a shard ends when a vector nearer than the k-th best would
already have shown up with the chosen confidence.

Shards hold a bounded number of vectors, queries come in bounded blocks, and every block is
searched in every shard.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lavoura.llm.common import staged
from lavoura.llm.vectors import as_double, matrix, norms, usable

#: Vectors of a shard, queries of a block, points of a kd-tree leaf, leaves looked at together.
SHARD, QUERIES, LEAF, STEP = 16384, 2048, 64, 8
#: Candidates compared in double precision at once.
EXACT = 1024


def chi_square(x: float, dims: int) -> float:
    """Chance that a chi-square variable of even ``dims`` is at most x."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(dims // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def confident(dims: int, confidence: float) -> float:
    """The smallest chi-square value whose chance is ``confidence``."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < confidence else (low, mid)
    return high


class KdTree:
    """Leaves of a kd-tree: their boxes, and their points side by side."""

    def __init__(self, points: np.ndarray):
        order, spans, todo = np.arange(len(points)), [], [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= LEAF:
                spans.append((a, b))
                continue
            own = points[order[a:b]]
            axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)]
            todo += [(a, a + mid), (a + mid, b)]
        self.order, self.spans = order, sorted(spans)
        ordered = points[order]
        self.low = np.array([ordered[a:b].min(axis=0) for a, b in self.spans])
        self.high = np.array([ordered[a:b].max(axis=0) for a, b in self.spans])

    def ascending(self, q: np.ndarray):
        """(spans of the next leaves, squared distance from which all others are), by steps."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        to_leaf = (gap * gap).sum(axis=1)
        leaves = np.argsort(to_leaf, kind="stable")
        for i in range(0, len(leaves), STEP):
            reach = to_leaf[leaves[i + STEP]] if i + STEP < len(leaves) else math.inf
            yield [self.spans[j] for j in leaves[i : i + STEP].tolist()], reach


def _search(table: pa.Table, k: int, dims: int, limit: float) -> pa.Table:
    """The k best of one shard for each query of one block."""
    is_query = table.column("query").to_numpy(zero_copy_only=False).astype(bool)
    v, ids = matrix(table.column("v")), table.column("vec_id").to_numpy()
    wanted, wanted_ids = v[is_query], ids[is_query]
    v, ids = v[~is_query], ids[~is_query]
    out: list[tuple[int, int, float]] = []
    if len(v) and len(wanted):
        # Equal vectors are one point with all their ids.
        whole = np.ascontiguousarray(v + 0.0).view(np.dtype((np.void, v.shape[1] * 8))).ravel()
        _, first, back = np.unique(whole, return_index=True, return_inverse=True)
        by_point = np.lexsort((ids, back))
        ends = np.cumsum(np.bincount(back))
        starts = np.concatenate(([0], ends[:-1]))
        # More than k, as the query itself may be among them, as often as its id occurs.
        wide = k + int(np.unique(ids, return_counts=True)[1].max())
        fellows = [ids[by_point[a : min(b, a + wide)]] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        v, least_id = v[first], ids[by_point[starts]]
        length = norms(v)
        directions = np.random.default_rng(v.shape[1]).standard_normal((v.shape[1], dims))
        unit = v / length[:, None]
        tree = KdTree(unit @ directions)
        # Side by side as the leaves are; single precision finds the best, double compares them.
        coarse = unit[tree.order].astype(np.float32)
        # By how much rounding may change the difference of two cosines in single precision.
        error = 2 * (v.shape[1] + 4) * 2.0**-24
        for q, own in zip(wanted, wanted_ids.tolist(), strict=True):
            size = math.sqrt(float((q * q).sum()))
            coarse_q = (q / size).astype(np.float32)
            best, best_at = np.empty(0, np.int64), np.empty(0, np.float32)
            for spans, reach in tree.ascending((q / size) @ directions):
                best = np.concatenate([best, *[np.arange(a, b) for a, b in spans]])
                best_at = np.concatenate([best_at, *[coarse[a:b] @ coarse_q for a, b in spans]])
                if len(best) < wide:
                    continue
                worst = float(np.partition(best_at, -wide)[-wide]) - error
                keep = best_at >= worst
                best, best_at = best[keep], best_at[keep]
                if reach >= limit * max(0.0, 2 - 2 * worst):
                    break
            best = tree.order[best]
            parts = [best[i : i + EXACT] for i in range(0, len(best), EXACT)]
            best_at = np.concatenate([(v[p] * q).sum(axis=1) / (length[p] * size) for p in parts])
            # Of the points, as many suffice; at a tie those of the smaller ids.
            first_ones = np.lexsort((least_id[best], -best_at))[:wide]
            best, best_at = best[first_ones], best_at[first_ones]
            near = [(-s, i, s) for p, s in zip(best.tolist(), best_at.tolist(), strict=True) for i in fellows[p].tolist() if i != own]
            out += [(own, i, s) for _, i, s in sorted(near)[:k]]
    q_out, i_out, s_out = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"query_id": pa.array(q_out, pa.int64()), "vec_id": pa.array(i_out, pa.int64()), "score": pa.array(s_out, pa.float64())})


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, dims: int = 8, confidence: float = 0.9999,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors of largest cosine found for each query.

    A query never finds its own id; ties go to the smaller id; fewer than ``k`` candidates are
    all returned. The score is computed in double precision on the original vectors. Rows with
    null id, and vectors that are null, empty, zero or hold a null or non-finite component, take
    no part, on either side; vectors are only compared with others of their number of
    components. Rows that repeat an id and vector are found once each. ``dims`` is even.
    """
    own = staged(as_double(vectors, id_col, vector_col).where(usable("v") & F.col("vec_id").isNotNull()), "ann-vectors")
    asked = staged(as_double(queries, id_col, vector_col).where(usable("v") & F.col("vec_id").isNotNull()), "ann-queries")
    shards, blocks = max(1, math.ceil(own.count() / SHARD)), max(1, math.ceil(asked.count() / QUERIES))
    left = own.select(
        F.size("v").alias("size"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(False).alias("query"), "vec_id", "v",
    )
    right = asked.select(
        F.size("v").alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block"), F.lit(True).alias("query"), "vec_id", "v",
    )
    limit = confident(dims, confidence)
    found = (
        left.unionByName(right)
        .groupBy("size", "shard", "block")
        .applyInArrow(lambda t: _search(t, k, dims, limit), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
