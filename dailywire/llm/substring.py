"""Substring dedup over word windows: difference-cover anchors, then exact extension.

Words are runs of bytes outside the ASCII blanks, unchanged. A window is ``size`` consecutive words
of one document. A word is removed when some window that covers it also starts in a document with a
smaller ``doc_id``; windows are judged on the input.

Two equal windows start at positions i and j of their documents. The difference cover D modulo v
has a shift s < v with i + s and j + s both in D (mod v), so the two windows share an anchor: the
``size - v + 1`` words from there. Only anchors are hashed and compared at first; only windows that
hold a repeated anchor are then extended to all their words and compared by a 96-bit hash.

1. every chunk of documents sends each of its distinct anchor hashes once -> which recur in another
   chunk (or in another document of the same one)
2. the chunk gets back its recurring anchors, forms the windows around them and sends each distinct
   window with the smallest doc_id it has there -> smallest doc_id of all
3. the chunk gets back the windows that start in a smaller document elsewhere, each with a tag of the
   anchor it was found by; it forms the windows around these anchors and around those that recur in
   itself, and marks words

A chunk sends each hash at most once, so a passage that a third of all documents holds costs one
entry per chunk, not one per document. The text is shuffled once; the three steps read the same
exchange.

Defined cases: null text has no words and keeps the hash of the empty string; null ``doc_id`` counts
as smaller than any other; rows that repeat a doc_id are one document to each other (neither is
smaller); fewer than ``size`` words: nothing is removed; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common, texthash, workers

WINDOW = 13
PERIOD = 7
#: A difference cover modulo 7: every residue is a difference of two members.
COVER = (1, 2, 4)
#: Hash entries of one bucket, about.
BUCKET = 1 << 20

_NO_ID = -(1 << 63)
_SENT = "bucket int, chunk int, hashes binary"
_BACK = "chunk int, hashes binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


class _Chunk:
    """The words of one chunk's documents, block by block."""

    def __init__(self, table: pa.Table, size: int, period: int, cover: tuple[int, ...]):
        ids = np.array([_NO_ID if x is None else x for x in table["doc_id"].to_pylist()], np.int64)
        self.ids, self.null = ids, np.array(table["doc_id"].is_null())
        self.data, self.offsets = texthash.text_bytes(table["text"])
        self.size, self.period, self.cover = size, period, cover

    def blocks(self):
        """(first document, bytes, words' starts, ends, first word of each document, word digests, document of each word)"""
        for a, b in texthash.blocks(self.offsets):
            data = self.data[self.offsets[a] : self.offsets[b]]
            starts, ends, first = texthash.words(data, self.offsets[a : b + 1] - self.offsets[a])
            digests = texthash.word_digests(data, starts, ends)
            yield a, data, starts, ends, first, digests, np.repeat(np.arange(b - a), np.diff(first))

    def anchors(self, first: np.ndarray, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of every anchor: words at cover positions, counted from the document's start."""
        long = self.size - self.period + 1
        at = np.flatnonzero(np.isin((np.arange(len(doc)) - first[doc]) % self.period, self.cover))
        at = at[at + long <= first[1:][doc[at]]]
        return at, texthash.run_hashes(np.ascontiguousarray(hashes[:, 0]), long)[at]

    def windows(self, at: np.ndarray, anchor: np.ndarray, first: np.ndarray, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, entry without its document) of the windows that hold one of the anchors ``at`` within a
        period of their start; the tag is of the first such anchor."""
        some = np.zeros(len(doc) + 1, bool)
        for s in range(self.period):
            some[at[at >= s] - s] = True
        starts = np.flatnonzero(some[:-1])
        starts = starts[starts + self.size <= first[1:][doc[starts]]]
        out = np.zeros(len(starts), _ENTRY)
        if len(starts):
            out["a"] = texthash.run_hashes(hashes[:, 0], self.size)[starts]
            out["b"] = texthash.run_hashes(hashes[:, 1], self.size)[starts] >> np.uint64(32)
            out["tag"] = anchor[np.searchsorted(at, starts)] & np.uint64(0xFFFFFFFF)
        return starts, out


_HASH = np.dtype([("a", "<u8"), ("b", "<u4"), ("tag", "<u4")])
_ENTRY = np.dtype([("a", "<u8"), ("b", "<u4"), ("tag", "<u4"), ("doc", "<i8")])


def _first_of(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by hash and doc, whether an element is the first of its hash)"""
    order = np.lexsort((entries["doc"], entries["b"], entries["a"]))
    e = entries[order]
    new = np.ones(len(e), bool)
    new[1:] = (e["a"][1:] != e["a"][:-1]) | (e["b"][1:] != e["b"][:-1])
    return order, new


def _dealt(chunk: int, bucket: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row per bucket: the values that fall there."""
    order = np.argsort(bucket, kind="stable")
    bucket, values = bucket[order], values[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], len(bucket)][: len(cuts)]
    return pa.table({
        "bucket": pa.array(bucket[cuts].astype(np.int32)),
        "chunk": pa.array(np.full(len(cuts), chunk, np.int32)),
        "hashes": pa.array([values[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
    })


def _gathered(table: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, chunk of each) of a bucket's rows."""
    blobs = [np.frombuffer(x.as_buffer(), dtype) for x in table["hashes"]]
    return np.concatenate(blobs) if blobs else np.zeros(0, dtype), np.repeat(np.array(table["chunk"], np.int32), [len(x) for x in blobs])


def _back(chunks: np.ndarray, values: np.ndarray) -> pa.Table:
    order = np.argsort(chunks, kind="stable")
    return _dealt(0, chunks[order], values[order]).drop_columns(["chunk"]).rename_columns(["chunk", "hashes"])


def _set_of(table: pa.Table, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype) for x in table["hashes"]]) if len(table) else np.zeros(0, dtype)


def remove_repeated_windows(docs: DataFrame, size: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER, chunk_bytes: int = common.CHUNK_BYTES, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, text): text is the kept words, joined by one space."""
    if size < period or {(x - y) % period for x in cover for y in cover} != set(range(period)):
        raise ValueError("cover must be a difference cover modulo period, and period at most size")
    total = common.text_total(docs)
    x = common.chunked(docs, common.parts(total, chunk_bytes))
    # about one word in six bytes, len(cover) / period of them anchors
    n = common.parts(total * len(cover) // (6 * period), bucket, 16)

    def opened(table: pa.Table) -> tuple[int, _Chunk]:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        return table["chunk"][0].as_py(), _Chunk(table, size, period, cover)

    def send_anchors(table: pa.Table) -> pa.Table:
        number, c = opened(table)
        once, again = [], []
        for a, _, _, _, first, hashes, doc in c.blocks():
            at, h = c.anchors(first, hashes, doc)
            # an anchor counts once for each document id
            pair = np.unique(np.rec.fromarrays([h, c.ids[a + doc[at]]], names="h,d"))
            once.append(pair["h"].copy())
        h = np.sort(np.concatenate(once)) if once else np.zeros(0, np.uint64)
        values, counts = np.unique(h, return_counts=True)
        again = values[counts > 1]
        # a hash that two documents of this chunk share is sent twice: it recurs already
        sent = np.concatenate([values, again])
        return _dealt(number, (sent % np.uint64(n)).astype(np.int64), sent)

    def recurring(table: pa.Table) -> pa.Table:
        values, chunks = _gathered(table, np.uint64)
        order = np.argsort(values, kind="stable")
        values, chunks = values[order], chunks[order]
        same = values[1:] == values[:-1]
        keep = np.r_[False, same] | np.r_[same, False] if len(values) else np.zeros(0, bool)
        values, chunks = values[keep], chunks[keep]
        new = np.r_[True, (values[1:] != values[:-1]) | (chunks[1:] != chunks[:-1])] if len(values) else np.zeros(0, bool)
        return _back(chunks[new], values[new])

    def send_windows(table: pa.Table, back: pa.Table) -> pa.Table:
        if not len(table):
            return pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary())]).empty_table()
        number, c = opened(table)
        known, found = np.sort(_set_of(back, np.uint64)), []
        for a, _, _, _, first, hashes, doc in c.blocks():
            at, h = c.anchors(first, hashes, doc)
            again = _within(h, known)
            starts, e = c.windows(at[again], h[again], first, hashes, doc)
            e["doc"] = c.ids[a + doc[starts]]
            order, new = _first_of(e)
            found.append(e[order][new])
        e = np.concatenate(found) if found else np.zeros(0, _ENTRY)
        order, new = _first_of(e)
        e = e[order][new]
        return _dealt(number, (e["a"] % np.uint64(n)).astype(np.int64), e)

    def smaller(table: pa.Table) -> pa.Table:
        e, chunks = _gathered(table, _ENTRY)
        order, new = _first_of(e)
        e, chunks = e[order], chunks[order]
        least = e["doc"][np.flatnonzero(new)][np.cumsum(new) - 1] if len(e) else e["doc"]
        later = e["doc"] > least
        return _back(chunks[later], np.ascontiguousarray(np.rec.fromarrays([e[c][later] for c in _HASH.names], dtype=_HASH)))

    def remove(table: pa.Table, back: pa.Table) -> pa.Table:
        if not len(table):
            return pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())]).empty_table()
        _, c = opened(table)
        every = np.sort(_set_of(back, _HASH), order=["a", "b"])
        tags = np.unique(every["tag"])
        mine = [h for _, _, _, _, first, hashes, doc in c.blocks() for h in [c.anchors(first, hashes, doc)[1]]]
        mine, counts = np.unique(np.concatenate(mine) if mine else np.zeros(0, np.uint64), return_counts=True)
        mine = mine[counts > 1]
        places, whole = [], []  # windows around anchors that recur, here or elsewhere
        for a, _, _, _, first, hashes, doc in c.blocks():
            at, h = c.anchors(first, hashes, doc)
            again = _within(h, mine) | _within((h & np.uint64(0xFFFFFFFF)).astype(np.uint32), tags)
            starts, e = c.windows(at[again], h[again], first, hashes, doc)
            e["doc"] = c.ids[a + doc[starts]]
            places.append(starts)
            whole.append(e)
        e = np.concatenate(whole) if whole else np.zeros(0, _ENTRY)
        order, new = _first_of(e)
        sorted_, later = e[order], np.zeros(len(e), bool)
        if len(e):
            later[order] = sorted_["doc"] > sorted_["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
            later |= _within_pairs(e, every)
        kept, counts, removed, done = [], [], [], 0
        for (a, data, starts, ends, first, hashes, doc), at in zip(c.blocks(), places, strict=True):
            hit, done = at[later[done : done + len(at)]], done + len(at)
            edge = np.zeros(len(doc) + size + 1, np.int64)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + size, -1)
            gone = np.cumsum(edge)[: len(doc)] > 0
            raw = data.tobytes()
            for d in range(len(first) - 1):
                lo, hi = first[d], first[d + 1]
                stay = np.flatnonzero(~gone[lo:hi]) + lo
                kept.append(b" ".join([raw[s:t] for s, t in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]))
                counts.append(int(hi - lo))
                removed.append(int(hi - lo - len(stay)))
        return pa.table({
            "doc_id": pa.array(c.ids, mask=c.null),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            "text": pa.array([x.decode() for x in kept], pa.string()),
        })

    known = x.groupBy("chunk").applyInArrow(workers.giving_back(send_anchors), _SENT).groupBy("bucket").applyInArrow(workers.giving_back(recurring), _BACK)
    sent = x.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(workers.giving_back(send_windows), _SENT)
    later = sent.groupBy("bucket").applyInArrow(workers.giving_back(smaller), _BACK)
    return x.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(workers.giving_back(remove), _RESULT)


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _within_pairs(e: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which 96-bit hashes are among ``known``, sorted by both parts."""
    if not len(known):
        return np.zeros(len(e), bool)
    at, out = np.searchsorted(known["a"], e["a"]), np.zeros(len(e), bool)
    live = np.arange(len(e))
    while len(live):
        live = live[at[live] < len(known)]
        live = live[known["a"][at[live]] == e["a"][live]]
        hit = known["b"][at[live]] == e["b"][live]
        out[live[hit]] = True
        live = live[~hit]
        at[live] += 1
    return out
