"""Near-duplicate documents by HyperMinHash sketches, confirmed on the full shingle sets.

A document's set holds its distinct shingles of ``shingle`` words (ASCII letters in lower case); a
shorter text is one shingle, a text without words has the empty set and is linked with nothing. Two
documents are linked if 100 * intersection >= ``percent`` * union.

1. One sketch per document: the shingle hashes fall into 128 buckets by their top 7 bits; a register
   keeps the leading-zero count of its smallest hash and the 10 bits after its leading one.
2. Documents with equal sets collapse to the smallest doc_id (partial aggregation by a 128-bit
   signature of the set, whose hashes have no structure in common with the words); all later steps see one representative per set.
3. Bands of 4 registers (empty ones borrow from the next filled one) are the candidate keys. Sets of
   at most 50 shingles use their prefix instead, the smallest n - ceil(n * t) + 1 hashes, of which
   two linked sets always share one; sets from 50 * t on have bands, so any pair of sizes that could
   be linked meets under one of the two.
4. Within a key, representatives whose sizes and collision-corrected estimate allow a link (five
   standard errors below the threshold) are joined by a search that emits a spanning tree, never all
   pairs. A key with more than ``block`` members is split, and each two of its blocks are searched
   together, so nothing is capped.
5. Trees join to clusters; each cluster's texts are gathered, their full sets compared word for word
   (shingles are numbered, not hashed), and the links found (again a spanning tree) give the components. A pair is compared on the full sets
   unless the two are joined already, or the triangle inequality of the Jaccard distance to the
   first text of the search rules the link out. Large clusters are split by blocks as in 4.

Defined cases: null text is empty; a null doc_id is kept and linked with nothing; rows that repeat a
doc_id are one node of the graph; ties go to the smaller doc_id; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailywire.session import checkpoint

from . import groups, texthash, verify, workers
from .graph import components

SHINGLE = 5
PERCENT = 80
BUCKETS = 128
MANTISSA = 10
ROWS = 4
#: Sets up to SMALL have prefix keys; those from ``percent`` of SMALL on have bands.
SMALL = 50
#: Members of a key, and shingles of a cluster, that one search holds.
BLOCK = 4096
BLOCK_SHINGLES = 500_000
ERRORS = 5.0

_SKETCH = "doc_id long, n long, signature binary, registers binary, keys array<long>"


def shingle_sets(column, k: int, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, shingle hashes sorted within each document without repeats, bounds) per block."""
    data, offsets = texthash.text_bytes(column)
    for a, b in texthash.blocks(offsets, limit):
        part = data[offsets[a] : offsets[b]]
        starts, ends, first = texthash.words(part, offsets[a : b + 1] - offsets[a])
        words = np.ascontiguousarray(texthash.word_digests(part, starts, ends, lower=True)[:, 0])
        count = np.diff(first)
        bounds = np.zeros(len(count) + 1, np.int64)
        np.cumsum(np.where(count >= k, count - k + 1, np.minimum(count, 1)), out=bounds[1:])
        h = np.zeros(bounds[-1], np.uint64)
        long = count >= k
        if long.any():
            size = (count - k + 1)[long]
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            h[np.repeat(bounds[:-1][long], size) + step] = texthash.run_hashes(words, k)[np.repeat(first[:-1][long], size) + step]
        for size in range(1, k):
            short = np.flatnonzero(count == size)
            if len(short):
                h[bounds[short]] = texthash.run_hashes(words, size)[first[short]]
        cuts = bounds.tolist()
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            h[x:y].sort()
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        new[bounds[:-1][bounds[:-1] < len(h)]] = True
        yield a, h[new], np.r_[0, np.cumsum(new)][bounds]


def registers(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, BUCKETS) registers of sorted hashes: (leading zeros + 1) << MANTISSA | mantissa, 0 if empty."""
    bits = int(BUCKETS).bit_length() - 1
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    cell = doc * BUCKETS + bucket
    new = np.ones(len(h), bool)
    new[1:] = cell[1:] != cell[:-1]
    rest = h[new] << np.uint64(bits)
    # exact bit length by the two 32-bit halves
    high, low = (rest >> np.uint64(32)).astype(np.float64), (rest & np.uint64(0xFFFFFFFF)).astype(np.float64)
    length = np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])
    zeros = np.minimum(64 - length, 64 - bits)
    mantissa = (rest << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    out = np.zeros(n * BUCKETS, np.uint16)
    out[cell[new]] = ((zeros + 1) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    return out.reshape(n, BUCKETS)


def band_keys(r: np.ndarray) -> np.ndarray:
    """(documents, bands): empty registers borrow the next filled one and their distance to it."""
    n, m = r.shape
    place = np.where(r > 0, np.arange(m), 2 * m)
    twice = np.concatenate([place, place + m], axis=1)
    twice = np.minimum.accumulate(twice[:, ::-1], axis=1)[:, ::-1][:, :m]
    away = twice - np.arange(m)
    value = np.take_along_axis(r, twice % m, axis=1).astype(np.uint64) * np.uint64(1024) + away.astype(np.uint64) + np.uint64(1)
    key = np.zeros((n, m // ROWS), np.uint64)
    for i in range(ROWS):
        key = texthash.mix(key * np.uint64(texthash.BASE_A) + value[:, i::ROWS])
    return texthash.mix(key + np.arange(1, m // ROWS + 1, dtype=np.uint64) * np.uint64(texthash.BASE_B))


def _sketches(k: int, percent: int):
    large = SMALL * percent // 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, h, bounds in shingle_sets(batch.column("text"), k):
                n = len(bounds) - 1
                size = np.diff(bounds)
                doc = np.repeat(np.arange(n), size)
                r = registers(h, doc, n)
                # two sums of differently mixed hashes, and the size, name the set
                one, two = (np.concatenate([[0], np.cumsum(texthash.mix(h + np.uint64(s)))]).astype(np.uint64) for s in (1, 2))
                name = np.stack([one[bounds[1:]] - one[bounds[:-1]], two[bounds[1:]] - two[bounds[:-1]], size.astype(np.uint64)], axis=1)
                bands, keys = band_keys(r), []
                for d in range(n):
                    own = [bands[d].view(np.int64)] if size[d] >= large else []
                    if 0 < size[d] <= SMALL:
                        prefix = size[d] - -(-size[d] * percent // 100) + 1
                        own.append(texthash.mix(h[bounds[d] : bounds[d] + prefix]).view(np.int64))
                    keys.append(np.concatenate(own) if own else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, n), pa.array(size, pa.int64()), pa.array([x.tobytes() for x in name], pa.binary()), pa.array([x.tobytes() for x in r], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "signature", "registers", "keys"],
                )

    return run


def estimate(r: np.ndarray, n: np.ndarray, s: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate of each row of ``r`` with ``s``, registers filled in either): equal registers
    less those that sets of these sizes are expected to share by chance."""
    filled = ((r > 0) | (s > 0)).sum(axis=1)
    equal = ((r == s) & (s > 0)).sum(axis=1)
    zeros = np.arange(1, 58)
    high, low = 2.0 ** -(zeros - 1), 2.0**-zeros

    def at_level(count: np.ndarray) -> np.ndarray:
        count = np.asarray(count, np.float64)[:, None]
        return (1 - low / BUCKETS) ** count - (1 - high / BUCKETS) ** count

    chance = BUCKETS * (at_level(n) * at_level(np.array([m]))).sum(axis=1) / 2.0**MANTISSA
    return np.clip((equal - chance) / np.maximum(filled, 1), 0, 1), filled


def _candidates(percent: int):
    t = percent / 100

    def handle(table: pa.Table, bounds: np.ndarray) -> pa.Table | None:
        ids, size = np.array(table["id"]), np.array(table["n"])
        r = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint16).reshape(len(ids), BUCKETS)
        edges = []
        for lo, hi in zip(bounds, [*bounds[1:], len(ids)], strict=True):
            order = lo + np.argsort(ids[lo:hi], kind="stable")

            def linked(i, others):
                j, filled = estimate(r[others], size[others], r[i], size[i])
                fits = 100 * np.minimum(size[i], size[others]) >= percent * np.maximum(size[i], size[others])
                return fits & (j >= t - ERRORS * np.sqrt(t * (1 - t) / np.maximum(filled, 1)))

            edges += verify.spanning_tree(order, linked)
        return verify.edge_table(ids, edges)

    return lambda batches: groups.whole_groups(batches, ["key", "i", "j"], handle)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the smallest doc_id of a component is kept.

    ``percent`` is 80 to 100: bands of ROWS registers find few pairs below."""
    if not PERCENT <= percent <= 100:
        raise ValueError("percent must be from 80 to 100")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = checkpoint(texts.mapInArrow(workers.giving_back(_sketches(shingle, percent)), _SKETCH))
    live = sketches.where("n > 0 and doc_id is not null")
    sets = checkpoint(live.groupBy("signature").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("registers").alias("registers"), F.first("keys").alias("keys")))

    # keys with two members at least; of keys with equal members one is enough
    member = sets.select("id", F.explode("keys").alias("key"))
    size = member.groupBy("key").agg(F.count("*").alias("count"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s"), F.sum(F.xxhash64(F.col("id"), F.lit(1)).cast("decimal(20,0)")).alias("t"))
    size = size.where("count > 1").groupBy("count", "s", "t").agg(F.min("key").alias("key")).select("key", "count")
    member = member.join(size, "key").join(sets.select("id", "n", "registers"), "id")
    member = verify.grouped(verify.in_blocks(member, F.ceil(F.col("count") / block)).select("key", "i", "j", "id", "n", "registers"))
    cluster = components(member.mapInArrow(_candidates(percent), "a long, b long"))

    inside = cluster.select(F.col("a").alias("id"), F.col("b").alias("key")).union(cluster.select(F.col("b").alias("id"), F.col("b").alias("key")).distinct())
    inside = inside.join(sets.select("id", "n"), "id")
    linked = components(verify.confirmed_links(inside, texts.withColumnRenamed("doc_id", "id"), shingle, percent, block_shingles))

    of_set = sets.select("signature", "id").join(linked.select(F.col("a").alias("id"), "b"), "id", "left").select("signature", F.coalesce("b", "id").alias("component"))
    out = sketches.select("doc_id", "n", F.when(F.expr("n > 0 and doc_id is not null"), F.col("signature")).alias("signature")).join(of_set, "signature", "left")
    own = F.coalesce(F.col("component"), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"))
