"""Blocks of queries against shards of candidates, shared by the exact and the approximate search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates of a shard, queries of a block.
SHARD = 4096
QUERIES = 8192

FOUND = "query_id long, vec_id long, score {}"


def usable(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: an id, and components that are all finite."""
    x = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & whole)


def pieces(table: DataFrame, each: int) -> int:
    return max(1, -(-table.count() // each))


def sharded(candidates: DataFrame, shard: int = SHARD) -> DataFrame:
    """Candidates with a shard number, dealt by a hash of the id and the vector."""
    n = pieces(candidates, shard)
    return candidates.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)).cast("int"))


def query_blocks(queries: DataFrame, n: int) -> DataFrame:
    """One row per query id (the least vector, should an id repeat) with its block."""
    one = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return one.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))


def every(rows: DataFrame, name: str, n: int) -> DataFrame:
    """Each row once for every number below ``n`` of the other side's pieces."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def nearest(found: DataFrame, k: int) -> DataFrame:
    """Rank the shards' finds of each query (k of each shard at most) and keep the first k."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (ids, vectors): vectors are only compared with those of their own length."""
    lists = table["embedding"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    ids, flat = np.array(table["vec_id"], np.int64), np.array(lists.flatten(), np.float64)
    sizes = np.array(lists.value_lengths(), np.int64)
    ends = np.cumsum(sizes)
    out = {}
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        out[int(n)] = ids[rows], flat[(ends[rows] - n)[:, None] + np.arange(n)]
    return out
