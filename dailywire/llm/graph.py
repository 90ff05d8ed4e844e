"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dailywire.session import checkpoint

#: Edges that one local pass holds.
LOCAL = 1 << 20


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the nodes that are not the smallest, for these edges."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        # hook every root to the smallest root over an edge, then shorten the ways
        p, q = least[x], least[y]
        new = least.copy()
        np.minimum.at(new, p, q)
        np.minimum.at(new, q, p)
        while (new[new] != new).any():
            new = new[new]
        if (new == least).all():
            break
        least = new
    other = least != np.arange(len(nodes))
    return nodes[other], nodes[least[other]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars in place of the edges of one task, so many of them at a time."""
    held, n = [], 0

    def out():
        a, b = (np.concatenate([np.asarray(x.column(c)) for x in held]) for c in ("a", "b"))
        return pa.RecordBatch.from_arrays([pa.array(v) for v in _stars(a, b)], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= LOCAL:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a stage table, with their number and a sum that names them (from the same job)."""
    seen = Observation()
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark")
    table = checkpoint(edges.observe(seen, F.count(F.lit(1)).alias("n"), mark))
    return table, (seen.get["n"], seen.get["mark"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b): every node that is not the smallest of its component, with that smallest node.

    Each task first turns its edges into stars. Then large-star and small-star steps alternate: in each a
    node hands its neighbours to the smallest of them. Minima are taken by partial aggregation and joined
    back, so a node with very many neighbours costs no window or list. Each round is one job that writes a
    stage table in the shared folder.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"))
    e, state = _written(e.where("a <> b").mapInArrow(_local, "a long, b long").distinct())
    while state[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        before = state
        e, state = _written(small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        if state == before:
            break
    return e
