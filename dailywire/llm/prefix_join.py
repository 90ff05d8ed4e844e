"""Exact Jaccard self-join of documents on word n-grams, by a grouped prefix join.

A document's set holds its distinct shingles of ``shingle`` words (ASCII letters in lower case); a
shorter text is one shingle, a text without words has the empty set and is linked with nothing. Two
documents are linked if 100 * intersection >= ``percent`` * union.

1. Frequencies: every task counts its documents' shingles in a fixed table of cells, the tables are added
   up slice by slice, and the sum (``CELLS`` numbers whatever the input) goes back to the tasks. A
   shingle's rank is its cell's level of frequency, then its hash: the same total order everywhere,
   rare shingles first.
2. Prefixes: of a set of n shingles the n - ceil(n * t) + 1 first in that order; two linked sets
   always share one of them. Sets with equal prefixes and sizes are one group, so copies and most near
   copies take part in the join once.
3. Group pairs: groups meet under the prefix shingles that at least two groups have (of shingles with
   the same groups one is enough). A pair of groups is left out if its sizes rule a link out, or if the
   prefixes, as far as both reach in the order, differ in more shingles than linked sets of these
   sizes can. A search under each shingle emits a spanning tree of the pairs that stay, never all
   pairs; a shingle with more than ``block`` groups is searched block against block. A cell's count
   bounds the groups of its shingles: those that may have more than ``HOT`` are dealt over several tasks.
4. Expansion: trees join to clusters of groups, these expand to their member sets (one document for
   each distinct set), and the members are verified on their full sets, word for word; the links
   found, spanning trees again, give the components.

Defined cases: null text is empty; a null doc_id is kept and linked with nothing; rows that repeat a
doc_id are joined by their texts, each row with the component of its own text's set; an empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailywire.session import checkpoint

from . import groups, texthash, verify, workers
from .graph import components
from .minhash import shingle_sets

SHINGLE = 5
PERCENT = 80
#: Cells of the frequency table (8 bytes each), and cells of one slice of it.
CELLS, SLICE = 1 << 20, 1 << 14
#: Groups under a shingle, and shingles of a cluster, that one search holds.
BLOCK = 4096
BLOCK_SHINGLES = 500_000
#: Groups of one shingle that one task gets, at most.
HOT = 1 << 17
LEVELS = 8

_SETS = "doc_id long, n long, signature binary, same binary, prefix binary"


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def most_different(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that linked sets of these sizes have in one of them only, at most."""
    least = -(-percent * (n + m) // (100 + percent))
    return n + m - 2 * least


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int64)


def _count(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, h, _ in shingle_sets(batch.column("text"), k):
                cells += np.bincount(_cell(h), minlength=CELLS)
        slices = cells.reshape(-1, SLICE)
        some = np.flatnonzero(slices.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([slices[i].tobytes() for i in some], pa.binary())], names=["slice", "counts"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the slices in this task (at most as many as there are slices)."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            sums[i] = sums.get(i, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])


def frequency_levels(texts: DataFrame, k: int) -> np.ndarray:
    """Level of each cell: eighths of the binary logarithm of the shingles counted there, rounded up (one byte each)."""
    counted = texts.mapInArrow(workers.giving_back(_count(k)), "slice long, counts binary")
    added = counted.repartition(CELLS // SLICE, "slice").mapInArrow(_added, "slice long, counts binary")
    cells = np.zeros((CELLS // SLICE, SLICE), np.int64)
    for row in added.collect():  # CELLS numbers in all, at every size
        cells[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(np.ceil(LEVELS * np.log2(cells.ravel() + 1)), 255).astype(np.uint8)


def _prefixed(k: int, percent: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            for a, h, bounds in shingle_sets(batch.column("text"), k):
                n = len(bounds) - 1
                size = np.diff(bounds)
                rank = level[_cell(h)].astype(np.uint64) << np.uint64(56) | h >> np.uint64(8)
                for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    rank[x:y].sort()
                one, two = (np.concatenate([[0], np.cumsum(texthash.mix(h + np.uint64(s)))]).astype(np.uint64) for s in (1, 2))
                name = np.stack([one[bounds[1:]] - one[bounds[:-1]], two[bounds[1:]] - two[bounds[:-1]], size.astype(np.uint64)], axis=1)
                until = bounds[:-1] + np.where(size > 0, prefix_length(size, percent), 0)
                prefix = [rank[x:y].tobytes() for x, y in zip(bounds.tolist(), until.tolist(), strict=False)]
                same = [hashlib.blake2b(x, digest_size=16, key=m.to_bytes(8)).digest() for x, m in zip(prefix, size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, n), pa.array(size, pa.int64()), pa.array([x.tobytes() for x in name], pa.binary()), pa.array(same, pa.binary()), pa.array(prefix, pa.binary())],
                    names=["doc_id", "n", "signature", "same", "prefix"],
                )

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, part, id): a row for each shingle of a group's prefix; ``part`` deals frequent shingles."""
    for batch in batches:
        blobs = batch.column("prefix").to_pylist()
        keys = np.frombuffer(b"".join(blobs), np.uint64)
        ids = np.repeat(np.asarray(batch.column("id")), [len(x) // 8 for x in blobs])
        parts = (_parts(keys) * (texthash.mix(ids.astype(np.uint64)) >> np.uint64(40)).astype(np.int64)) >> 24
        for at in range(0, len(keys), 1 << 18):
            piece = slice(at, at + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(keys[piece].view(np.int64)), pa.array(parts[piece]), pa.array(ids[piece])], names=["key", "part", "id"])


def _parts(keys: np.ndarray) -> np.ndarray:
    """Tasks over which the groups of each shingle are dealt, by the count of its cell."""
    most = 2.0 ** ((keys >> np.uint64(56)).astype(np.float64) / LEVELS)
    return np.maximum(1, np.ceil(most / HOT)).astype(np.int64)


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id) of the shingles with two groups at least. Those with the same groups become one key, the
    hash of their ids; of a shingle that is dealt over several tasks all rows go on."""

    def handle(table: pa.Table, bounds: np.ndarray) -> pa.Table | None:
        keys, ids = np.array(table["key"]), np.array(table["id"])
        size = np.diff(np.r_[bounds, len(keys)])
        dealt = _parts(keys[bounds].view(np.uint64)) > 1
        hashes = texthash.mix(ids.astype(np.uint64) * np.uint64(texthash.BASE_A))
        of = texthash.mix(np.add.reduceat(hashes, bounds) + size.astype(np.uint64))
        of = np.where(dealt, keys[bounds], of.view(np.int64))
        _, first = np.unique(np.where(dealt, np.arange(len(of)), of), return_index=True)
        once = np.zeros(len(of), bool)
        once[first] = True
        keep = np.repeat(dealt | (once & (size > 1)), size)
        return pa.table({"key": np.repeat(of, size)[keep], "id": ids[keep]}) if keep.any() else None

    return groups.whole_groups(batches, ["key", "part"], handle)


def differing(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """For each other prefix: shingles that only one of the two has, up to where both reach."""
    last = np.array([x[-1] for x in others])
    both, size = np.concatenate(others), np.array([len(x) for x in others])
    cuts = np.r_[0, np.cumsum(size)[:-1]]
    at = np.minimum(np.searchsorted(a, both), len(a) - 1)
    same = np.add.reduceat((a[at] == both).astype(np.int64), cuts)
    mine = np.searchsorted(a, np.minimum(last, a[-1]), "right")
    theirs = np.add.reduceat((both <= a[-1]).astype(np.int64), cuts)
    return mine + theirs - 2 * same


def _candidates(percent: int):
    def handle(table: pa.Table, bounds: np.ndarray) -> pa.Table | None:
        ids, size = np.array(table["id"]), np.array(table["n"])
        prefix = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["prefix"]]
        edges = []
        for lo, hi in zip(bounds, [*bounds[1:], len(ids)], strict=True):
            order = lo + np.argsort(ids[lo:hi], kind="stable")

            def linked(i, others):
                near = 100 * np.minimum(size[i], size[others]) >= percent * np.maximum(size[i], size[others])
                some = np.flatnonzero(near)
                for at in range(0, len(some), 1024):
                    part = others[some[at : at + 1024]]
                    near[some[at : at + 1024]] = differing(prefix[i], [prefix[x] for x in part]) <= most_different(size[i], size[part], percent)
                return near

            edges += verify.spanning_tree(order, linked)
        return verify.edge_table(ids, edges)

    return lambda batches: groups.whole_groups(batches, ["key", "i", "j"], handle)


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    levels = spark.sparkContext.broadcast(frequency_levels(texts, shingle))
    rows = checkpoint(texts.mapInArrow(workers.giving_back(_prefixed(shingle, percent, levels)), _SETS))
    live = rows.where("n > 0 and doc_id is not null")
    sets = checkpoint(live.groupBy("signature").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("same").alias("same")))
    first = sets.groupBy("same").agg(F.min("id").alias("doc_id"))
    heads = checkpoint(live.join(first, ["doc_id", "same"]).select(F.col("doc_id").alias("id"), "n", "same", "prefix"))

    # shingles with two groups at least; of those with the same groups one is enough
    token = heads.select("id", "prefix").mapInArrow(_tokens, "key long, part long, id long")
    token = token.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "part").sortWithinPartitions("key", "part")
    member = checkpoint(token.mapInArrow(_recurring, "key long, id long")).distinct()
    size = member.groupBy("key").agg(F.count("*").alias("count")).where("count > 1")
    member = member.join(size, "key").join(heads.select("id", "n", "prefix"), "id")
    member = verify.grouped(verify.in_blocks(member, F.ceil(F.col("count") / block)).select("key", "i", "j", "id", "n", "prefix"))
    cluster = components(member.mapInArrow(_candidates(percent), "a long, b long"))

    # a group stands for its sets: those of a cluster, or those of one group alone
    of_group = heads.select("id", "same").distinct().join(cluster.select(F.col("a").alias("id"), "b"), "id", "left")
    inside = sets.join(of_group.select("same", F.coalesce("b", "id").alias("key")), "same").select("key", "id", "n")
    several = inside.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1").select("key")
    inside = inside.join(several, "key", "left_semi")
    one_text = texts.withColumnRenamed("doc_id", "id")
    linked = components(verify.confirmed_links(inside, one_text, shingle, percent, block_shingles))

    of_set = sets.select("signature", "id").join(linked.select(F.col("a").alias("id"), "b"), "id", "left").select("signature", F.coalesce("b", "id").alias("component"))
    out = rows.select("doc_id", "n", F.when(F.expr("n > 0 and doc_id is not null"), F.col("signature")).alias("signature")).join(of_set, "signature", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
