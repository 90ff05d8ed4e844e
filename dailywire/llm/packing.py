"""Hierarchical multi-length packing of tokenised documents.

A document is its token ids and an end id. Whole windows of the longest context are cut off first.
What remains (or a short document) is routed to the tier of the smallest context that holds it. Each
tier packs its windows: the longest piece opens a window, pieces of the shorter tiers fill its gap,
longest first, and where none fits one is cut to fill it exactly. So every sequence is full; its length
is a context size, a power of two, and has no padding. At the end of a partition the rest is cut into
sequences of falling powers of two. Sequences of one context form step groups of ``step_tokens``
tokens each, so all steps cost the same.

Packing runs inside the input's own partitions, without a shuffle; ``sequence_id`` holds the partition
number in its upper bits. It holds one block of texts and about ``pool`` waiting tokens.

Defined cases: null text has no ids but the end id; null doc_id is kept; rows that repeat a doc_id are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import texthash, workers

CONTEXTS = (256, 512, 1024, 2048)
STEP_TOKENS = 1 << 17
POOL = 1 << 18
#: Marks that end a word as one more piece (an apostrophe may be part of a piece).
MARKS = ".,;:!?*&%$#"
#: Distinct words whose ids a task remembers, and text bytes that it encodes at once.
WORDS, BLOCK = 1 << 20, 2 << 20

_RESULT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, context int, step long"


class Encoder:
    """Ids of whole texts by a tokenizer that never joins characters across a blank or line feed.

    Each distinct word is encoded once and its ids are gathered by word number.
    """

    def __init__(self, path: str, end: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        """Word number by word; the words' places among the ids follow one another."""
        self.known: dict[str, int] = {}
        self.starts, self.ids = [np.zeros(1, np.int64)], []
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many to a text: a word of letters closes with one token, one of letters and
        marks after them with two. Where the count differs, and for all other words, one by one."""
        one = [w for w in words if w.isalpha()]
        two = [w for w in words if not w.isalpha() and w.rstrip(MARKS).isalpha()]
        alone = [w for w in words if not w.isalpha() and not w.rstrip(MARKS).isalpha()]
        order, ids, sizes = [], [], []
        for closing, plain in ((1, one), (2, two)):
            texts = [plain[i : i + 256] for i in range(0, len(plain), 256)]
            for part, e in zip(texts, self.tokenizer.encode_batch_fast([" ".join(t) for t in texts], add_special_tokens=False), strict=True):
                own = np.array(e.ids, np.uint32)
                ends = np.flatnonzero(self.closes[own]) + 1
                if len(ends) == closing * len(part) and ends[-1] == len(own):
                    order += part
                    ids.append(own)
                    sizes.append(np.diff(ends[closing - 1 :: closing], prepend=0))
                else:
                    alone += part
        for i in range(0, len(alone), 4096):
            part = alone[i : i + 4096]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            order += part
            ids.append(np.array([x for f in found for x in f], np.uint32))
            sizes.append(np.array([len(f) for f in found], np.int64))
        self.known.update(zip(order, range(len(self.known), len(self.known) + len(order)), strict=True))
        self.ids += ids
        for n in sizes:
            self.starts.append(self.used + np.cumsum(n))
            self.used += int(n.sum())

    def _places(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) in the ids learnt of each word's ids."""
        if len(self.known) > WORDS:
            self._forget()
        known = self.known
        if new := [w for w in words if w not in known]:
            self._learn(new)
            self.starts, self.ids = [np.concatenate(self.starts)], [np.concatenate(self.ids)]
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return self.starts[0][at], self.starts[0][at + 1] - self.starts[0][at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id after it; offsets)"""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        starts, sizes = self._places(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        number = np.asarray(words.indices)
        starts, sizes = starts[number], sizes[number]
        until = np.concatenate([[0], np.cumsum(sizes)])
        cut = until[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
        total = int(until[-1])
        place = np.repeat((starts - until[:-1]).astype(np.int32), sizes)
        place += np.arange(total, dtype=np.int32)
        flat = self.ids[0][place] if total else np.zeros(0, np.uint32)
        n = len(texts)
        offsets = cut + np.arange(n + 1)
        out = np.full(total + n, self.end, np.uint32)
        keep = np.ones(total + n, bool)
        keep[offsets[1:] - 1] = False
        out[keep] = flat
        return out, offsets


class _Piece:
    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, total: int, start: int, ids: np.ndarray):
        self.doc, self.total, self.start, self.ids = doc, total, start, ids

    def cut(self, n: int) -> tuple[_Piece, _Piece]:
        return _Piece(self.doc, self.total, self.start, self.ids[:n]), _Piece(self.doc, self.total, self.start + n, self.ids[n:])


class Packer:
    """The open tiers of one partition. ``rows`` are the pieces of finished sequences."""

    def __init__(self, partition: int, contexts: Sequence[int], step_tokens: int):
        self.contexts, self.step_tokens = sorted(contexts), step_tokens
        self.tiers: list[list[_Piece]] = [[] for _ in self.contexts]
        self.waiting, self.rows = 0, []
        self.base, self.sequences = partition << 32, 0
        self.made = dict.fromkeys(self.contexts, 0)

    def add(self, doc, ids: np.ndarray) -> None:
        longest = self.contexts[-1]
        whole = len(ids) - len(ids) % longest
        for at in range(0, whole, longest):
            self._finish([_Piece(doc, len(ids), at, ids[at : at + longest])])
        if whole < len(ids):
            self._route(_Piece(doc, len(ids), whole, ids[whole:].copy()))

    def _route(self, piece: _Piece) -> None:
        tier = bisect.bisect_left(self.contexts, len(piece.ids))
        bisect.insort(self.tiers[tier], piece, key=lambda p: len(p.ids))
        self.waiting += len(piece.ids)

    def _take(self, tier: int, at: int) -> _Piece:
        piece = self.tiers[tier].pop(at)
        self.waiting -= len(piece.ids)
        return piece

    def pack(self, rest: int) -> None:
        """Full windows, longest tier first, until about ``rest`` tokens wait."""
        while self.waiting > max(rest, 2 * self.contexts[-1]):
            tier = max(t for t, pieces in enumerate(self.tiers) if pieces)
            room = self.contexts[tier]
            window = [self._take(tier, -1)]
            room -= len(window[0].ids)
            while room:
                window.append(self._filler(tier, room))
                room -= len(window[-1].ids)
            self._finish(window)

    def _filler(self, tier: int, room: int) -> _Piece:
        """The longest piece that fits, from the tier of the gap downwards; else the start of a longer one."""
        for t in range(min(bisect.bisect_left(self.contexts, room), tier), -1, -1):
            at = bisect.bisect_right(self.tiers[t], room, key=lambda p: len(p.ids))
            if at:
                return self._take(t, at - 1)
        t = next(t for t, pieces in enumerate(self.tiers) if pieces)
        first, after = self._take(t, 0).cut(room)
        self._route(after)
        return first

    def close(self) -> None:
        """The rest, cut into sequences of falling powers of two."""
        self.pack(0)
        rest = [p for tier in reversed(self.tiers) for p in reversed(tier)]
        left = self.waiting
        while left:
            room = min(self.contexts[-1], 1 << (left.bit_length() - 1))
            left -= room
            window = []
            while room:
                piece = rest.pop(0)
                if len(piece.ids) > room:
                    piece, after = piece.cut(room)
                    rest.insert(0, after)
                window.append(piece)
                room -= len(piece.ids)
            self._finish(window)
        self.tiers, self.waiting = [[] for _ in self.contexts], 0

    def _finish(self, window: list[_Piece]) -> None:
        size = sum(len(p.ids) for p in window)
        made = self.made[size] = self.made.get(size, 0) + 1
        step = self.base | size.bit_length() << 24 | (made - 1) * size // self.step_tokens
        offset = 0
        for p in window:
            self.rows.append((p.doc, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.total, self.base | self.sequences, offset, size, step))
            offset += len(p.ids)
        self.sequences += 1


def pack_documents(docs: DataFrame, tokenizer: str, end: int = 1, contexts: Sequence[int] = CONTEXTS, step_tokens: int = STEP_TOKENS, pool: int = POOL) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset, context, step): a row per piece.

    ``ids`` are little-endian unsigned 32-bit; ``tokenizer`` names a file of the tokenizers library
    whose pre-tokenizer drops white space, there on every executor.
    """
    if any(c & (c - 1) for c in contexts):
        raise ValueError("contexts must be powers of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder(tokenizer, end)
        packer = Packer(TaskContext.get().partitionId(), contexts, step_tokens)

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True))
            packer.rows = []
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            _, offsets = texthash.text_bytes(texts)
            for a, b in texthash.blocks(offsets, BLOCK):
                tokens, cuts = encoder.encode(texts.slice(a, b - a))
                for d in range(b - a):
                    packer.add(ids[a + d], tokens[cuts[d] : cuts[d + 1]])
                packer.pack(pool)
                if packer.rows:
                    yield out()
        packer.close()
        if packer.rows:
            yield out()

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(workers.giving_back(run), _RESULT)
