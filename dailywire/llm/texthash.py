"""Vectorised hashing of byte and word spans inside one Arrow block of texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xD1342543DE82EF95
#: Bytes that separate words.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(BLANKS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One odd-looking 64-bit value per byte, so that sums of powers do not cancel on plain text.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE_A))
_BYTE_LOWER = _BYTE[_LOWER]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        m = max(n, 1 << 20)
        inverse = pow(base, -1, 1 << 64)
        ups, downs = np.full(m, base, np.uint64), np.full(m, inverse, np.uint64)
        ups[0] = downs[0] = 1
        have = _POWERS[base] = (np.cumprod(ups), np.cumprod(downs))
    return have


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """P with P[e] - P[s] the polynomial of values[s:e], scaled by base**s (mod 2**64)."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hash(p: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values in [start, end), equal for equal value sequences anywhere in the block."""
    down = _powers(base, len(p))[1]
    return mix((p[ends] - p[starts]) * down[starts])


def byte_values(data: np.ndarray, lower: bool = False) -> np.ndarray:
    return (_BYTE_LOWER if lower else _BYTE)[data]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = 1 << 20) -> list[tuple[int, int]]:
    """Runs [a, b) of documents with about ``limit`` bytes each, one document at least."""
    out, a, n = [], 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        out.append((a, b := min(n, max(a + 1, b))))
        a = b
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words and, per document, its first word's index.

    A word is a run of bytes outside BLANKS within one document; ``first`` has one entry more than
    there are documents.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    is_word = _IS_WORD[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1] | cut[1:n]
    stops = is_word.copy()
    stops[:-1] &= ~is_word[1:] | cut[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """(number of each word among the block's distinct words, the distinct words). ``starts`` and ``ends``
    are all the words of ``data``."""
    letters = (_LOWER[data] if lower else data)[_IS_WORD[data]]
    cuts = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=cuts[1:])
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(letters))])
    coded = column.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary


#: Words of more bytes than this are hashed one by one.
LONG_WORD = 64
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Two independent 64-bit hashes of each word, as (words, 2).

    A word's bytes enter eight at a time, each lane through a mixing step, so that no two words meet by
    the structure of their bytes; very long words take their BLAKE2b digest.
    """
    letters = np.zeros(len(data) + 8, np.uint8)
    letters[: len(data)] = _LOWER[data] if lower else data
    size = ends - starts
    out = mix(size.astype(np.uint64)[:, None] * np.array([BASE_A, BASE_B], np.uint64))
    lanes = np.ndarray((len(data) + 1,), "<u8", letters, 0, (1,))  # the eight bytes from each place on
    live = np.arange(len(starts))
    for at in range(0, LONG_WORD, 8):
        live = live[size[live] > at] if at else live
        if not len(live):
            break
        lane = lanes[starts[live] + at] & _KEEP[np.minimum(size[live] - at, 8)]
        out[live, 0] = mix(out[live, 0] * np.uint64(BASE_A) + lane)
        out[live, 1] = mix((out[live, 1] + lane) * np.uint64(BASE_B))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = np.frombuffer(hashlib.blake2b(letters[starts[i] : ends[i]].tobytes(), digest_size=16).digest(), "<u8")
    return out


def run_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` values from each place on (for the places where so many are left).

    Halves are joined by a mixing step each, so that no sum over the run can cancel.
    """
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    piece, length, at, out = values, 1, 0, None
    while True:
        if size & length:
            out = piece[:n] if out is None else mix(out * np.uint64(BASE_A) + piece[at : at + n])
            at += length
        if 2 * length > size:
            return mix(out + np.uint64(size))
        piece = mix(piece[:-length] * np.uint64(BASE_B) + piece[length:])
        length *= 2
