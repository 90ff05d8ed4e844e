"""Confirms clusters of candidate documents on their full shingle sets, word for word.

Within a slice of whole groups words are numbered by their bytes and runs of words by their numbers, so
that two shingles have one number if and only if their words are equal: nothing rests on a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import groups, texthash

#: Text bytes of the groups that are numbered together.
SLICE_BYTES = 1 << 20


def _numbered(words: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` numbered words, equal for equal runs only."""
    piece, length, at, out = words, 1, 0, None
    n = len(words) - size + 1
    while True:
        if size & length:
            out = piece[:n] if out is None else pd.factorize(out * (piece.max() + 1) + piece[at : at + n])[0]
            at += length
        if 2 * length > size:
            return out
        piece = pd.factorize(piece[:-length] * (piece.max() + 1) + piece[length:])[0]
        length *= 2


def shingle_numbers(column: pa.Array | pa.ChunkedArray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle numbers of each text (ASCII letters in lower case)."""
    data, offsets = texthash.text_bytes(column)
    starts, ends, first = texthash.words(data, offsets)
    codes, _ = texthash.word_codes(data, starts, ends, lower=True)
    del data, starts, ends
    count = np.diff(first)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(count)
    above = 0
    for size in range(1, k + 1):
        own = np.flatnonzero(count == size if size < k else count >= k)
        if len(own):
            every = _numbered(codes, size)
            for d in own.tolist():
                out[d] = np.unique(every[first[d] : first[d + 1] - size + 1]) + above
            above += int(every.max()) + 1
    return out


def spanning_tree(order: np.ndarray, linked) -> list[tuple[int, int]]:
    """Spanning-tree edges of the graph that ``linked(i, others) -> mask`` describes."""
    left, edges = order, []
    while len(left):
        front, left = [left[0]], left[1:]
        root = front[0]
        while front and len(left):
            hit = linked(front.pop(), left)
            found, left = left[hit], left[~hit]
            edges += [(int(x), int(root)) for x in found]
            front += found.tolist()
    return edges


def similar_sets(sets: list[np.ndarray], order: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning trees of the sets of ``order`` with 100 * intersection >= percent * union."""
    size = np.array([len(x) for x in sets])
    order = order[size[order] > 0]

    def compared(i, others):
        """(intersection, union) sizes of set i with each other set."""
        both = np.concatenate([sets[x] for x in others])
        at = np.minimum(np.searchsorted(sets[i], both), len(sets[i]) - 1)
        same = np.add.reduceat((sets[i][at] == both).astype(np.int64), np.r_[0, np.cumsum(size[others])[:-1]])
        return same, size[others] + size[i] - same

    def sliced(i, others, each=256):
        found = [compared(i, others[c : c + each]) for c in range(0, len(others), each)]
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    # the triangle inequality of the Jaccard distance to the first set rules many pairs out
    far = np.zeros(len(sets))
    if len(order) > 64:
        same, union = sliced(order[0], order)
        far[order] = 1 - same / union

    def linked(i, others):
        near = 100 * np.minimum(size[i], size[others]) >= percent * np.maximum(size[i], size[others])
        near &= np.abs(far[others] - far[i]) <= 1 - percent / 100 + 1e-9
        if near.any():
            same, union = sliced(i, others[near])
            near[near] = 100 * same >= percent * union
        return near

    return spanning_tree(order, linked)


def edge_table(ids: np.ndarray, pairs: list[tuple[int, int]]) -> pa.Table | None:
    if not pairs:
        return None
    e = np.array(pairs)
    return pa.table({"a": ids[e[:, 0]], "b": ids[e[:, 1]]})


def _confirmed(k: int, percent: int):
    def handle(table: pa.Table, bounds: np.ndarray) -> pa.Table | None:
        ids, pairs = np.array(table["id"]), []
        cuts = np.r_[bounds, len(ids)]
        _, offsets = texthash.text_bytes(table["text"])
        g = 0
        while g < len(bounds):
            # whole groups of about a slice together
            stop = max(g + 1, int(np.searchsorted(offsets[cuts], offsets[cuts[g]] + SLICE_BYTES, "right")) - 1)
            base = int(cuts[g])
            sets = shingle_numbers(table["text"].slice(base, int(cuts[stop]) - base), k)
            for lo, hi in zip(cuts[g:stop].tolist(), cuts[g + 1 : stop + 1].tolist(), strict=True):
                order = lo - base + np.argsort(ids[lo:hi], kind="stable")
                pairs += [(a + base, b + base) for a, b in similar_sets(sets, order, percent)]
            g = stop
        return edge_table(ids, pairs)

    return lambda batches: groups.whole_groups(batches, ["key", "i", "j"], handle)


def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Each row once for every two blocks of its key that it belongs to (once if the key has one)."""
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .where("blocks = 1 or own <> other")
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("own", "other", "blocks")
    )


def grouped(rows: DataFrame) -> DataFrame:
    """Rows dealt and sorted by (key, i, j)."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, "key", "i", "j").sortWithinPartitions("key", "i", "j")


def confirmed_links(members: DataFrame, texts: DataFrame, k: int, percent: int, block_shingles: int) -> DataFrame:
    """Spanning trees (a, b) of the links inside clusters. ``members``: key, id, n (shingles), one row for
    each set; ``texts``: id, text. A cluster with more shingles than ``block_shingles`` is searched block against block."""
    # here, so that the module's functions can travel to executors without the library
    from dailywire.session import checkpoint

    total = members.groupBy("key").agg(F.sum("n").alias("total"))
    inside = members.join(total, "key").select("id", "key", F.ceil(F.col("total") / block_shingles).alias("size")).distinct()
    # the same join at every size: the members grow with the input, so they are never broadcast
    unit = texts.join(checkpoint(inside).hint("merge"), "id")
    unit = grouped(in_blocks(unit, F.col("size")).select("key", "i", "j", "id", "text"))
    return unit.mapInArrow(_confirmed(k, percent), "a long, b long")
