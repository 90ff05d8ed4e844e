"""Exact substring dedup: every byte covered by a string of ``match`` bytes that also starts earlier.

Texts are UTF-8 bytes; matches stay inside a document. Earlier means a smaller doc_id, or the same
document and an earlier start; strings are judged on the input. The suffixes (windows of ``match``
bytes) are sorted bucket by bucket:

1. Every window belongs to its minimizer, the k-mer of least hash in it. Neighbouring windows with
   one minimizer form a super-window. Each chunk of documents sends its distinct minimizer hashes;
   only super-windows whose minimizer recurs can hold a repeat.
2. These super-windows go, as bytes, to the bucket of their minimizer, so equal windows meet. Within
   a chunk only the first of equal super-windows is sent: all windows of the others have an earlier
   start already. So a passage that a third of all documents share costs one entry a chunk.
3. A bucket sorts its suffixes by a difference cover modulo ``PERIOD``: the suffixes at cover
   positions are ranked first; then all are sorted by their first 32 bytes, and longer ties are
   resolved by comparing the cover ranks at the shift that brings both suffixes onto the cover. The
   ranks take the place of the long comparisons, so memory is a few words per byte of the bucket.
   Neighbours in that order are compared on all ``match`` bytes; of each class the earliest stays.
4. The ranges found return to their chunks, which cut the bytes.

A minimizer with more than ``hot`` different super-windows in all chunks together (a short phrase in
very many contexts) would fill one bucket: its windows travel one by one, as 128-bit hashes dealt by
the hash itself. The chunks report how many super-windows each minimizer would send; by default
``hot`` is the number that makes an eighth of a bucket's bytes, whatever the size of the input.

Defined cases: null text is empty; null doc_id comes before all others; rows that repeat a doc_id
are ordered by text, and each counts as a document; an empty table gives an empty result. ``text`` is
the remaining bytes decoded, without characters that a cut broke. ``carry`` names other columns to
hand through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common, texthash, workers

MATCH = 100
KMER = 32
PERIOD = 31
#: A perfect difference cover modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
#: Minimizer hashes of one bucket of step 1, and super-window bytes of one suffix bucket, about.
HASHES = 1 << 19
SUFFIXES = 16 << 20
#: Minimizers of this part of a bucket's bytes are split.
HOT_PART = 8

_NO_ID = -(1 << 63)
_PLACE = np.dtype([("doc", "<i8"), ("row", "<i4"), ("start", "<i8"), ("size", "<i8")])
_RANGE = np.dtype([("row", "<i4"), ("start", "<i8"), ("end", "<i8")])
_HASH = np.dtype([("a", "<u8"), ("b", "<u8")])
_SENT = "bucket int, chunk int, kind int, head binary, body binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("head", pa.binary()), ("body", pa.binary())])
_BYTES, _DONE, _SINGLE = 0, 1, 2


def super_windows(data: np.ndarray, offsets: np.ndarray, match: int, kmer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, minimizer hash) of the super-windows of one block of documents."""
    n, width = len(data) - match + 1, match - kmer + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    p = texthash.prefix(texthash.byte_values(data), texthash.BASE_A)
    at = np.arange(len(data) - kmer + 1)
    h = texthash.span_hash(p, texthash.BASE_A, at, at + kmer)
    # leftmost least: ties of the upper 36 bits go by position, so equal windows choose alike
    low = (h & ~np.uint64((1 << 28) - 1)) | (at.astype(np.uint64) & np.uint64((1 << 28) - 1))
    size = 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    low = np.minimum(low[:n], low[width - size : width - size + n])
    inside = np.arange(n) + match <= np.repeat(offsets[1:], np.diff(offsets))[:n]
    new, stop = inside.copy(), inside.copy()
    changed = low[1:] != low[:-1]
    new[1:] &= ~inside[:-1] | changed
    stop[:-1] &= ~inside[1:] | changed
    start, end = np.flatnonzero(new), np.flatnonzero(stop) + 1
    span = np.uint64((1 << 28) - 1)
    where = start + ((low[start] - start.astype(np.uint64)) & span).astype(np.int64)
    return start, end - start, h[where]


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as a number that sorts like them."""
    return np.ndarray(len(data) - 7, ">u8", data, strides=(1,))


def _refined(words: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of ``at`` by 8 * depth bytes, whether an element differs from the one before it)."""
    key = words[at].astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    for d in range(1, depth):
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = words[at[order[tied]] + 8 * d].astype(np.uint64)
        by = np.lexsort((key, group))
        order[tied] = order[tied[by]]
        key = key[by]
        new[tied[1:][key[1:] != key[:-1]]] = True
    return order, new


def _shifts(period: int, cover: Sequence[int]) -> np.ndarray:
    """[i, j]: least shift that brings residues i and j both onto the cover."""
    on = np.isin(np.arange(period), cover)
    r = np.arange(period)
    both = np.stack([on[(r[:, None] + s) % period] & on[(r[None, :] + s) % period] for s in range(period)])
    if not both.any(axis=0).all():
        raise ValueError("not a difference cover")
    return both.argmax(axis=0)


def suffix_classes(data: np.ndarray, at: np.ndarray, match: int, period: int = PERIOD, cover: Sequence[int] = COVER) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the windows ``at`` in suffix order and where a class of equal windows begins.

    ``data`` has at least 2 * match + 16 bytes after the last window's start.
    """
    words = _words(data)
    reach = np.zeros(len(data) + 1, np.int32)
    np.add.at(reach, at, 1)
    np.add.at(reach, np.minimum(at + period, len(data)), -1)
    sample = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
    sample = sample[np.isin(sample % period, cover)]
    by, new = _refined(words, sample, -(-match // 8))
    rank = np.zeros(len(data), np.int32)
    rank[sample[by]] = np.cumsum(new)

    order, new = _refined(words, at, -(-period // 8))
    head = new.copy()
    shift, open_ = _shifts(period, cover), np.ones(len(at), bool)
    while True:
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]) & open_)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        first = np.r_[True, group[1:] != group[:-1]]
        begin = np.flatnonzero(first)
        size = np.diff(np.r_[begin, len(tied)])
        own = at[order[tied]]
        pivot = np.repeat(own[begin + size // 2], size)
        s = shift[own % period, pivot % period]
        side = np.sign(rank[own + s] - rank[pivot + s])
        by = np.argsort(group * 4 + side, kind="stable")
        order[tied], side = order[tied[by]], side[by]
        new[tied[1:][(side[1:] != side[:-1])]] = True
        open_[tied[side == 0]] = False
    # the order is settled; equal windows are neighbours within one head
    same = np.flatnonzero(~head)
    a, b = at[order[same - 1]], at[order[same]]
    for d in [*range(0, match - 7, 8), match - 8]:
        equal = words[a + d] == words[b + d]
        same, a, b = same[equal], a[equal], b[equal]
    new = np.ones(len(at), bool)
    new[same] = False
    return order, new


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all spans, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _row(bucket: int, chunk: int, kind: int, head: np.ndarray, body: bytes | None) -> tuple:
    return bucket, chunk, kind, head.tobytes(), body


def _sent(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SENT_ARROW)], schema=_SENT_ARROW)


def _sliced(by: np.ndarray):
    """(value, indices) for each value of ``by``."""
    if not len(by):
        return
    order = np.argsort(by, kind="stable")
    cuts = np.flatnonzero(np.r_[True, by[order][1:] != by[order][:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(by)], strict=True):
        yield int(by[order[a]]), order[a:b]


def _ranges(row: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.empty(len(row), _RANGE)
    out["row"], out["start"], out["end"] = row, start, start + size
    return out


def remove_repeats(docs: DataFrame, match: int = MATCH, kmer: int = KMER, chunk_bytes: int = common.CHUNK_BYTES, suffixes: int = SUFFIXES, hot: int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, text, *carry)"""
    if match < max(PERIOD + 8, kmer):
        raise ValueError("match must be at least the cover's period + 8 bytes and the k-mer")
    total = common.text_total(docs)
    n_chunks = common.parts(total, chunk_bytes)
    # a minimizer for every width / 2 positions, about; a super-window repeats match bytes
    n_hashes = common.parts(2 * total // (match - kmer + 2), HASHES, 16)
    n_buckets = common.parts(total + 2 * match * total // (match - kmer + 2), suffixes, 16)
    hot = max(1, suffixes // (HOT_PART * (2 * match - kmer))) if hot is None else hot
    base = common.chunked(docs, n_chunks)
    x = base
    if carry:
        x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*carry).alias("carry"))
        x = x.select(common.hash_chunk(n_chunks, F.col("doc_id"), F.col("text")).alias("chunk"), "doc_id", "text", "carry")

    def opened(table: pa.Table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        ids = np.array([_NO_ID if v is None else v for v in table["doc_id"].to_pylist()], np.int64)
        # nulls sort last in Arrow; here they come first
        by = np.argsort(ids, kind="stable")
        if not np.array_equal(by, np.arange(len(by))):
            table, ids = table.take(pa.array(by)), ids[by]
        data, offsets = texthash.text_bytes(table["text"])
        return table, ids, data, offsets

    def runs(data: np.ndarray, offsets: np.ndarray):
        for a, b in texthash.blocks(offsets):
            lo = offsets[a]
            start, size, h = super_windows(data[lo : offsets[b]], offsets[a : b + 1] - lo, match, kmer)
            yield lo, data[lo : offsets[b]], start, size, h

    def minimizers(table: pa.Table) -> pa.Table:
        chunk, (_, _, data, offsets) = table["chunk"][0].as_py(), opened(table)
        found = list(runs(data, offsets))
        values, counts = np.unique(np.concatenate([h for *_, h in found]) if found else np.zeros(0, np.uint64), return_counts=True)
        # only the first of equal super-windows is sent; below the floor all chunks together stay under hot
        many = values[counts > max(1, hot // n_chunks)]
        if len(many):
            mins, hashes = [], []
            for _, part, start, size, h in found:
                chosen = np.flatnonzero(many[np.minimum(np.searchsorted(many, h), len(many) - 1)] == h)
                if len(chosen):
                    p = texthash.prefix(texthash.byte_values(part), texthash.BASE_A)
                    mins.append(h[chosen])
                    hashes.append(texthash.span_hash(p, texthash.BASE_A, start[chosen], (start + size)[chosen] + match - 1))
            _, first = np.unique(np.concatenate(hashes), return_index=True)
            which, different = np.unique(np.concatenate(mins)[first], return_counts=True)
            # a minimizer seen twice stays known as such
            counts[np.searchsorted(values, which)] = np.maximum(different, 2)
        rows = []
        for bucket, at in _sliced((values % np.uint64(n_hashes)).astype(np.int64)):
            rows.append(_row(bucket, chunk, 0, values[at], counts[at].astype(np.uint32).tobytes()))
        return _sent(rows)

    def recurring(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(v.as_buffer(), np.uint64) for v in table["head"]]
        values = np.concatenate(blobs)
        chunks = np.repeat(np.array(table["chunk"]), [len(v) for v in blobs])
        counts = np.concatenate([np.frombuffer(v.as_buffer(), np.uint32) for v in table["body"]])
        _, group = np.unique(values, return_inverse=True)
        total = np.bincount(group, weights=counts)[group]
        keep = total > 1
        values, is_hot, rows = values[keep], total[keep] > hot, []
        for chunk, at in _sliced(chunks[keep]):
            rows.append(_row(0, chunk, 0, values[at], is_hot[at].tobytes()))
        return _sent(rows)

    def to_buckets(table: pa.Table, back: pa.Table) -> pa.Table:
        if not len(table):
            return _sent([])
        chunk, (_, ids, data, offsets) = table["chunk"][0].as_py(), opened(table)
        if not len(back):
            return _sent([])
        known = np.concatenate([np.frombuffer(v.as_buffer(), np.uint64) for v in back["head"]])
        is_hot = np.concatenate([np.frombuffer(v.as_buffer(), bool) for v in back["body"]])
        by = np.argsort(known)
        known, is_hot = known[by], is_hot[by]
        starts, sizes, mins, ones, twos, singles = [], [], [], [], [], []
        for lo, part, start, size, h in runs(data, offsets):
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            keep = known[at] == h
            single = np.repeat(is_hot[at[keep]], np.where(is_hot[at[keep]], size[keep], 1))
            start, size, h, often = start[keep], size[keep], h[keep], is_hot[at[keep]]
            if often.any():  # one entry for each window
                each = np.where(often, size, 1)
                inner = _spread(np.zeros(len(start), np.int64), each)
                start, h = np.repeat(start, each) + inner, np.repeat(h, each)
                size = np.where(single, 1, np.repeat(size, each))
            end = start + size + match - 1
            for base_, out in ((texthash.BASE_A, ones), (texthash.BASE_B, twos)):
                out.append(texthash.span_hash(texthash.prefix(texthash.byte_values(part), base_), base_, start, end))
            starts.append(start + lo)
            sizes.append(size)
            mins.append(h)
            singles.append(single)
        start, size, h, one, two, single = (np.concatenate(v) for v in (starts, sizes, mins, ones, twos, singles))
        # the first of equal super-windows is sent; the windows of the others all start earlier there
        by = np.lexsort((start, size, two, one))
        same = np.zeros(len(by), bool)
        same[1:] = (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1]) & (size[by][1:] == size[by][:-1])
        later = np.zeros(len(by), bool)
        later[by] = same
        row = np.searchsorted(offsets, start, "right") - 1
        inner = start - offsets[row]
        rows = []
        if later.any():
            rows.append(_row(chunk % n_buckets, chunk, _DONE, _ranges(row[later], inner[later], size[later]), None))
        place = np.empty(len(start), _PLACE)
        place["doc"], place["row"], place["start"], place["size"] = ids[row], row, inner, size
        for kind, chosen, by in ((_BYTES, ~later & ~single, h), (_SINGLE, ~later & single, one)):
            chosen = np.flatnonzero(chosen)
            for bucket, at in _sliced((by[chosen] % np.uint64(n_buckets)).astype(np.int64)):
                at = chosen[at]
                if kind == _BYTES:
                    body = pa.compress(data[_spread(start[at], size[at] + match - 1)].tobytes(), "zstd", asbytes=True)
                else:
                    body = np.rec.fromarrays([one[at], two[at]], dtype=_HASH).tobytes()
                rows.append(_row(bucket, chunk, kind, place[at], body))
        return _sent(rows)

    def sort_bucket(table: pa.Table) -> pa.Table:
        rows, places, chunks, bodies, hashes = [], {_BYTES: [], _SINGLE: []}, {_BYTES: [], _SINGLE: []}, [], []
        for chunk, kind, head, body in zip(table["chunk"].to_pylist(), table["kind"].to_pylist(), table["head"], table["body"], strict=True):
            if kind == _DONE:
                rows.append((0, chunk, _DONE, head.as_py(), None))
                continue
            place = np.frombuffer(head.as_buffer(), _PLACE)
            places[kind].append(place)
            chunks[kind].append(np.full(len(place), chunk))
            if kind == _BYTES:
                size = int((place["size"] + match - 1).sum())
                bodies.append(pa.decompress(body.as_buffer(), size, "zstd", asbytes=True))
            else:
                hashes.append(np.frombuffer(body.as_buffer(), _HASH))
        found = []
        if places[_BYTES]:
            place, chunk = np.concatenate(places[_BYTES]), np.concatenate(chunks[_BYTES])
            found.append(_from_bytes(place, chunk, b"".join(bodies), match))
        if places[_SINGLE]:
            place, chunk, h = np.concatenate(places[_SINGLE]), np.concatenate(chunks[_SINGLE]), np.concatenate(hashes)
            by = np.lexsort((place["start"], place["row"], chunk, place["doc"], h["b"], h["a"]))
            later = np.zeros(len(by), bool)
            later[by[1:]] = h[by][1:] == h[by][:-1]
            found.append((chunk[later], _ranges(place["row"][later], place["start"][later], place["size"][later])))
        for chunk, ranges in found:
            rows += [_row(0, c, _DONE, ranges[at], None) for c, at in _sliced(chunk)]
        return _sent(rows)

    result = StructType().add("doc_id", "long").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("text", "string")
    result = result.add(x.schema["carry"]) if carry else result

    def cut(table: pa.Table, back: pa.Table) -> pa.Table:
        table, _, data, offsets = opened(table) if len(table) else (table, None, np.zeros(0, np.uint8), np.zeros(1, np.int64))
        edge = np.zeros(len(data) + 1, np.int32)
        for head in back["head"]:
            r = np.frombuffer(head.as_buffer(), _RANGE)
            np.add.at(edge, offsets[r["row"]] + r["start"], 1)
            np.add.at(edge, offsets[r["row"]] + r["end"] + match - 1, -1)
        gone = np.cumsum(edge, dtype=np.int32)[:-1] > 0
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        first = offsets[:-1][offsets[:-1] < len(gone)]
        rise[first] = gone[first]
        removed, spans = (np.concatenate([np.zeros(1, np.int32), np.cumsum(v, dtype=np.int32)]) for v in (gone, rise))
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        out = {
            "doc_id": table["doc_id"],
            "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array((removed[offsets[1:]] - removed[offsets[:-1]]).astype(np.int64)),
            "n_spans": pa.array((spans[offsets[1:]] - spans[offsets[:-1]]).astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(v).hexdigest() for v in kept], pa.string()),
            "text": pa.array([v.decode(errors="ignore") for v in kept], pa.string()),
        }
        return pa.table(out | ({"carry": table["carry"]} if carry else {}))

    known = base.groupBy("chunk").applyInArrow(workers.giving_back(minimizers), _SENT).groupBy("bucket").applyInArrow(workers.giving_back(recurring), _SENT)
    sent = base.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(workers.giving_back(to_buckets), _SENT)
    ranges = sent.groupBy("bucket").applyInArrow(workers.giving_back(sort_bucket), _SENT)
    out = x.groupBy("chunk").cogroup(ranges.groupBy("chunk")).applyInArrow(workers.giving_back(cut), result)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", *(["carry.*"] if carry else []))


def _from_bytes(place: np.ndarray, chunk: np.ndarray, body: bytes, match: int) -> tuple[np.ndarray, np.ndarray]:
    """(chunk, range) of the windows of one bucket that have an earlier equal one."""
    size = place["size"] + match - 1
    start = np.cumsum(size) - size
    by = np.lexsort((place["start"], place["row"], chunk, place["doc"]))
    seen: dict[bytes, int] = {}
    earliest = []
    for k in by.tolist():
        text = body[start[k] : start[k] + size[k]]
        if seen.setdefault(text, k) == k:
            earliest.append(k)
    first = np.array(earliest)
    later = np.ones(len(place), bool)
    later[first] = False
    out = [(chunk[later], _ranges(place["row"][later], place["start"][later], place["size"][later]))]
    # one order of documents, then positions, for the earliest of each class
    new = np.ones(len(by), bool)
    p = place[by]
    new[1:] = (p["doc"][1:] != p["doc"][:-1]) | (chunk[by][1:] != chunk[by][:-1]) | (p["row"][1:] != p["row"][:-1])
    document = np.empty(len(by), np.int64)
    document[by] = np.cumsum(new)
    data = np.frombuffer(body + bytes(2 * match + 64), np.uint8)
    windows = place["size"][first]
    owner = np.repeat(first, windows)
    inner = _spread(np.zeros(len(first), np.int64), windows)
    at = start[owner] + inner
    order, new = suffix_classes(data, at, match)
    key = (document[owner] << 40) | (place["start"][owner] + inner)
    begin = np.flatnonzero(new)
    least = np.minimum.reduceat(key[order], begin)
    gone = np.zeros(len(at), bool)
    gone[order] = key[order] != np.repeat(least, np.diff(np.r_[begin, len(at)]))
    edge, until = gone.copy(), gone.copy()
    border = np.r_[True, owner[1:] != owner[:-1]]
    edge[1:] &= ~gone[:-1] | border[1:]
    until[:-1] &= ~gone[1:] | border[1:]
    a, b = np.flatnonzero(edge), np.flatnonzero(until) + 1
    k = owner[a]
    out.append((chunk[k], _ranges(place["row"][k], place["start"][k] + inner[a], b - a)))
    return np.concatenate([c for c, _ in out]), np.concatenate([r for _, r in out])
