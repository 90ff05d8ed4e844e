"""Exact top-k by inner product of integer vectors: columnar branch and bound.

Each vector component becomes floor(scale * x). Candidates lie in shards in vertical layout, one row
per dimension. For a query the dimensions are taken in blocks, those with the query's largest
components first: the partial products of a block are added for the candidates still alive, then the
remaining mass (the norms of the parts not yet seen, of query and candidate) bounds each final score
from both sides; candidates whose upper bound is below the k-th lower bound are compacted away.
Scores are integers, so the result is exact.

Blocks of queries meet shards of candidates: work is the product of both, what moves and what a task
holds is bounded by their sizes, and a shard returns at most k rows per query.

Defined cases: vectors that are null, empty or hold a null or non-finite component, or have no id,
take no part; vectors of another length than the query's are not candidates; a row with the query's
id is its own; a query id that repeats is asked once, with the least vector; ties go to the smaller
vec_id; a score beyond the range of long is held at its end; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from . import vectors

SCALE = 256
K = 5
DIMENSIONS = 8

_FOUND = vectors.FOUND.format("long")


def _scaled(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): floats that hold integers, or Python integers where floats would round."""
    with np.errstate(over="ignore"):
        f = np.floor(scale * v)
    if not len(f) or np.abs(f).max() < 2.0**22:
        return f
    from fractions import Fraction
    from math import floor

    return np.array([[floor(Fraction(float(x)) * scale) for x in row] for row in v], object).reshape(v.shape)


def search(query: np.ndarray, columns: np.ndarray, tails: np.ndarray, live: np.ndarray, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(candidates, scores) that hold the k best of ``live``, ties included.

    ``columns`` is (dimension, candidate); ``tails`` the candidates' squares, same layout.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    score, mass = np.zeros(len(live), query.dtype), tails[:, live].sum(axis=0) if len(live) else np.zeros(0)
    for at in range(0, len(order), step):
        dims = order[at : at + step]
        score = score + query[dims] @ columns[np.ix_(dims, live)]
        mass = np.maximum(mass - tails[np.ix_(dims, live)].sum(axis=0), 0)
        rest = float((query[order[at + step :]].astype(np.float64) ** 2).sum())
        if len(live) <= k or not rest:
            continue
        # rounding of the float norms is far below this margin
        slack = np.sqrt(rest * mass) * (1 + 1e-6) + 1e-6 * (rest + mass) + 1
        lower = score.astype(np.float64) - slack
        bar = np.partition(lower, len(lower) - k)[len(lower) - k]
        keep = score.astype(np.float64) + slack >= bar
        live, score, mass = live[keep], score[keep], mass[keep]
    return live, score


def _unit(k: int, scale: int, step: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        shards = vectors.by_length(candidates)
        for n, (query_ids, asked) in vectors.by_length(queries).items():
            if n not in shards:
                continue
            ids, found = shards[n]
            columns, asked = np.ascontiguousarray(_scaled(found, scale).T), _scaled(asked, scale)
            big = columns.dtype == object or asked.dtype == object
            if big:
                columns, asked = columns.astype(object), asked.astype(object)
                whole = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
                columns, asked = whole(columns), whole(asked)
            tails = columns.astype(np.float64) ** 2
            for q, v in zip(query_ids, asked, strict=True):
                others = np.flatnonzero(ids != q)
                # beyond exact floats every candidate is scored in integers
                live, score = (others, np.array([sum(a * b for a, b in zip(v, columns[:, c], strict=True)) for c in others], object)) if big else search(v, columns, tails, others, k, step)
                best = sorted(zip((-int(s) for s in score), ids[live].tolist(), strict=True))[:k]
                out += [(int(q), i, max(-(1 << 63), min((1 << 63) - 1, -s))) for s, i in best]
        return pa.table({name: pa.array([r[i] for r in out], pa.int64()) for i, name in enumerate(["query_id", "vec_id", "score"])})

    return run


def exact_top_k(table: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, vec_id: str = "vec_id", embedding: str = "embedding", shard: int = vectors.SHARD, queries: int = vectors.QUERIES, step: int = DIMENSIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of greatest integer inner product per query."""
    x = vectors.usable(table, vec_id, embedding)
    asked = x.where(is_query)
    n_shards, n_blocks = vectors.pieces(x, shard), vectors.pieces(asked, queries)
    left = vectors.every(vectors.sharded(x, shard), "block", n_blocks)
    right = vectors.every(vectors.query_blocks(asked, n_blocks), "shard", n_shards)
    found = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(_unit(k, scale, step), _FOUND)
    return vectors.nearest(found, k)
