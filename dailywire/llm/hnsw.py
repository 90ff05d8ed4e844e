"""Approximate nearest neighbours by cosine: a hierarchical navigable small-world graph per shard.

Vectors are dealt into shards of bounded size. A shard's index is one row: ids, unit vectors, levels
and, for each level, a flat array with a fixed number of neighbour slots per node. Equal directions
are one node that lists its ids. Levels are drawn from a hash of the vector; on each, a node is joined
to the neighbours that the selection rule leaves of its ``pool`` nearest (one nearer to an already
chosen neighbour than to the node is passed over), and back, the nearest first.

A search descends greedily through the upper levels and explores the lowest with a beam of ``beam``;
every shard is searched for every query and the shards' finds are merged. Scores are cosines of the
original vectors in double precision.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, or have no
id, take no part; lengths never mix; a row with the query's id is its own; a query id that repeats is
asked once, with the least vector; ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailywire.session import checkpoint

from . import texthash, vectors

K = 5
NEIGHBOURS = 16
POOL = 64
BEAM = 96

_INDEX = "shard int, length int, entry int, ids binary, starts binary, vectors binary, levels array<binary>"
_FOUND = vectors.FOUND.format("double")


def _levels(unit: np.ndarray, m: int) -> np.ndarray:
    """Level of each node: geometric with ratio 1 / m, from a hash of its bytes."""
    bits = np.ascontiguousarray(unit).view(np.uint64)
    h = np.zeros(len(unit), np.uint64)
    for column in bits.T:
        h = texthash.mix(h * np.uint64(texthash.BASE_A) + column)
    u = (h >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(m)).astype(np.int64)


def _chosen(near: np.ndarray, sims: np.ndarray, all_sims: np.ndarray, m: int) -> np.ndarray:
    """(nodes, m) neighbours by the selection rule, -1 where fewer are left.

    ``near`` lists each node's candidates, nearest first, ``sims`` their similarity to the node.
    """
    n, pool = near.shape
    out, used = np.full((n, m), -1, np.int64), np.zeros(n, np.int64)
    for c in range(pool):
        cand = near[:, c]
        picked = out >= 0
        rival = np.where(picked, all_sims[cand[:, None], np.where(picked, out, 0)], -2).max(axis=1)
        take = np.flatnonzero((sims[:, c] > rival) & (used < m) & np.isfinite(sims[:, c]))
        out[take, used[take]] = cand[take]
        used[take] += 1
    # room that the rule left goes to the nearest passed over
    for c in range(pool):
        take = np.flatnonzero((used < m) & ~(out == near[:, c : c + 1]).any(axis=1) & np.isfinite(sims[:, c]))
        out[take, used[take]] = near[take, c]
        used[take] += 1
    return out


def build_level(unit: np.ndarray, nodes: np.ndarray, m: int, pool: int) -> np.ndarray:
    """(nodes, 2 * m) flat neighbour slots (node numbers of the shard, -1 for none) of one level."""
    x = unit[nodes].astype(np.float32)
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    pool = min(pool, len(nodes) - 1)
    if pool < 1:
        return np.full((len(nodes), 2 * m), -1, np.int32)
    near = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
    own = np.take_along_axis(sims, near, axis=1)
    by = np.argsort(-own, axis=1, kind="stable")
    near, own = np.take_along_axis(near, by, axis=1), np.take_along_axis(own, by, axis=1)
    out = np.full((len(nodes), 2 * m), -1, np.int64)
    out[:, :m] = _chosen(near, own, sims, m)
    # links back, the nearest first, into the other half of the slots
    a, slot = np.nonzero(out[:, :m] >= 0)
    b = out[a, slot]
    back = ~(out[b, :m] == a[:, None]).any(axis=1)
    a, b = a[back], b[back]
    by = np.lexsort((-sims[b, a], b))
    a, b = a[by], b[by]
    place = np.arange(len(b)) - np.searchsorted(b, b)
    fits = place < m
    out[b[fits], m + place[fits]] = a[fits]
    return np.where(out >= 0, nodes[np.maximum(out, 0)], -1).astype(np.int32)


def _index(m: int, pool: int):
    def run(table: pa.Table) -> pa.Table:
        rows = []
        for n, (ids, found) in vectors.by_length(table).items():
            # a scale keeps squares of very large or small components in range
            tiny = np.abs(found).max(axis=1)
            ids, found, tiny = ids[tiny > 0], found[tiny > 0], tiny[tiny > 0]
            if not len(ids):
                continue
            unit = found / tiny[:, None]
            unit /= np.linalg.norm(unit, axis=1)[:, None]
            _, first, node = np.unique(unit, axis=0, return_index=True, return_inverse=True)
            by = np.lexsort((ids, node.ravel()))
            starts = np.searchsorted(node.ravel()[by], np.arange(len(first) + 1))
            nodes = unit[first]
            level = _levels(nodes, m)
            top = int(level.max())
            flat = [build_level(nodes, np.flatnonzero(level >= lv), m, pool) for lv in range(top + 1)]
            wide = []
            for lv, slots in enumerate(flat):  # upper levels keep a slot row for their own nodes only
                wide.append(np.concatenate([np.flatnonzero(level >= lv).astype(np.int32)[:, None], slots], axis=1).tobytes())
            rows.append((table["shard"][0].as_py(), n, int(np.flatnonzero(level == top)[0]), ids[by].tobytes(), starts.astype(np.int64).tobytes(), found[by].tobytes(), wide))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary())]
        return pa.table({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(zip(["shard", "length", "entry", "ids", "starts", "vectors", "levels"], kinds, strict=True))})

    return run


class Graph:
    """One index row, opened for searching."""

    def __init__(self, row: dict, m: int):
        n = row["length"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, n)
        scale = np.abs(self.vectors).max(axis=1, keepdims=True)
        unit = self.vectors / scale
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        self.unit = unit[self.starts[:-1]].astype(np.float32)
        self.levels = [np.frombuffer(x, np.int32).reshape(-1, 2 * m + 1) for x in row["levels"]]
        self.entry = row["entry"]

    def beam(self, q: np.ndarray, width: int) -> np.ndarray:
        """The nodes that a search with this beam ends with."""
        at, best = self.entry, float(self.unit[self.entry] @ q)
        for slots in reversed(self.levels[1:]):
            while True:
                row = slots[np.searchsorted(slots[:, 0], at), 1:]
                row = row[row >= 0]
                if not len(row):
                    break
                sims = self.unit[row] @ q
                i = int(sims.argmax())
                if sims[i] <= best:
                    break
                at, best = int(row[i]), float(sims[i])
        base = self.levels[0]
        seen = np.zeros(len(self.unit), bool)
        seen[at] = True
        todo, kept = [(-best, at)], [(best, at)]
        while todo:
            sim, at = heapq.heappop(todo)
            if len(kept) >= width and -sim < kept[0][0]:
                break
            row = base[at, 1:]
            row = row[row >= 0]
            row = row[~seen[row]]
            seen[row] = True
            for s, i in zip((self.unit[row] @ q).tolist(), row.tolist(), strict=True):
                if len(kept) < width:
                    heapq.heappush(kept, (s, i))
                elif s > kept[0][0]:
                    heapq.heapreplace(kept, (s, i))
                else:
                    continue
                heapq.heappush(todo, (-s, i))
        return np.array([i for _, i in kept])

    def search(self, query_id: int, query: np.ndarray, k: int, width: int) -> list[tuple[int, float]]:
        scale = np.abs(query).max()
        unit = query / scale
        nodes = self.beam((unit / np.linalg.norm(unit)).astype(np.float32), width)
        # k + 1 ids of a node are enough: they are sorted, and one may be the query's own
        rows = np.concatenate([np.arange(self.starts[i], min(self.starts[i] + k + 1, self.starts[i + 1])) for i in nodes])
        rows = rows[self.ids[rows] != query_id]
        v = self.vectors[rows]
        big = np.abs(v).max(axis=1, initial=0, keepdims=True)
        plain = 1e-100 < scale < 1e100 and (not len(v) or 1e-100 < big.min() and big.max() < 1e100)
        a, v = (query, v) if plain else (unit, v / big)
        score = (v @ a) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((a * a).sum()))
        best = np.lexsort((self.ids[rows], -score))[:k]
        return [(int(self.ids[rows[b]]), float(score[b])) for b in best]


def _unit(k: int, width: int, m: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out, asked = [], vectors.by_length(queries)
        for row in index.to_pylist():
            graph = Graph(row, m)
            for q, v in zip(*asked.get(row["length"], ([], [])), strict=True):
                if v.any():
                    out += [(int(q), i, s) for i, s in graph.search(int(q), v, k, width)]
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate(kinds.items())})

    return run


def build(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", shard: int = vectors.SHARD, m: int = NEIGHBOURS, pool: int = POOL) -> DataFrame:
    """The index, one row per shard and vector length, as a stage table."""
    x = vectors.sharded(vectors.usable(table, vec_id, embedding), shard)
    return checkpoint(x.groupBy("shard").applyInArrow(_index(m, pool), _INDEX))


def approximate_top_k(table: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", shard: int = vectors.SHARD, queries: int = vectors.QUERIES, m: int = NEIGHBOURS, pool: int = POOL, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query, nearest first."""
    x = vectors.usable(table, vec_id, embedding)
    asked = x.where(is_query)
    index = build(table, vec_id, embedding, shard, m, pool)
    n_shards, n_blocks = vectors.pieces(x, shard), vectors.pieces(asked, queries)
    left = vectors.every(index, "block", n_blocks)
    right = vectors.every(vectors.query_blocks(asked, n_blocks), "shard", n_shards)
    found = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(_unit(k, beam, m), _FOUND)
    return vectors.nearest(found, k)
