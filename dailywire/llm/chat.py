"""Chat formatting with a loss mask aligned by character offsets.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its assistant
texts are intersected with the token spans by binary search: a token is under the loss mask if it
shares a character with such a span, and ``loss_start``/``loss_end`` are the span's part of it (a
character that several tokens share is counted with the first).

The template opens a conversation with ``<s>``; a turn of the loss role is ``[OUT]text</s>``, any
other is ``[INST]role[TEXT]text[/INST]``. Inside roles and texts a backslash is doubled and one is set
after the first character of each control string, so that none is left and ``unescape`` restores
the input.

Conversations are dealt by id and sorted by turn; a task streams over them and holds one segment.
A conversation of more than ``segment`` characters is encoded in several rows, cut between turns, so
that one of any length needs bounded memory.

Defined cases: null text and null role are empty; rows of one conversation that share a turn go by
role, then text; null turns come first; a null conv_id is a conversation of its own kind (null); an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[TEXT]", "[OUT]")
LOSS_ROLE = "assistant"
SEGMENT = 1 << 20

_SEGMENT = "conv_id long, segment int, turns int, text string, ids array<int>, loss_start array<int>, loss_end array<int>"
_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for c in CONTROL:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]], begin: bool, loss_role: str = LOSS_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """(text, spans of the loss role's texts) of some turns; ``begin`` opens the conversation."""
    parts, spans, at = [], [], 0

    def put(s: str) -> None:
        nonlocal at
        parts.append(s)
        at += len(s)

    if begin:
        put("<s>")
    for role, text in turns:
        text = escape(text)
        put("[OUT]" if role == loss_role else f"[INST]{escape(role)}[TEXT]")
        if role == loss_role:
            spans.append((at, at + len(text)))
        put(text)
        put("</s>" if role == loss_role else "[/INST]")
    return "".join(parts), spans


_TURN = re.compile(r"\[OUT\](.*?)</s>|\[INST\](.*?)\[TEXT\](.*?)\[/INST\]", re.DOTALL)


def parse(text: str, loss_role: str = LOSS_ROLE) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered text."""
    return [(loss_role, unescape(m[1])) if m[1] is not None else (unescape(m[2]), unescape(m[3])) for m in _TURN.finditer(text)]


def mask(offsets: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each token's part of the span it meets first, without characters that an earlier
    token has; start = end for a token outside the mask."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), np.int32), np.zeros(len(offsets), np.int32)
    first = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")
    at = np.minimum(first, len(spans) - 1)
    before = np.maximum.accumulate(np.concatenate([[0], offsets[:-1, 1]]))
    start = np.maximum(np.maximum(offsets[:, 0], spans[at, 0]), before)
    end = np.minimum(offsets[:, 1], spans[at, 1])
    hit = (first < len(spans)) & (start < end)
    return np.where(hit, start, 0).astype(np.int32), np.where(hit, end, 0).astype(np.int32)


def format_conversations(conversations: DataFrame, tokenizer: str, loss_role: str = LOSS_ROLE, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, segment, turns, text, ids, loss_start, loss_end): nearly always one row a conversation.

    ``tokenizer`` names a file of the tokenizers library, there on every executor. Rows of one
    conversation stay together and in order within their partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True  # their strings inside a text are ordinary text
        rows: list[tuple] = []

        load = 0  # characters of the rows that wait

        def add(conv, number: int, turns: list[tuple[str, str]]) -> None:
            nonlocal load
            text, spans = render(turns, number == 0, loss_role)
            rows.append((conv, number, len(turns), text, spans))
            load += len(text)

        def out() -> pa.RecordBatch:
            nonlocal load
            load = 0
            encoded = encoder.encode_batch([r[3] for r in rows], add_special_tokens=False)
            masks = [mask(np.array(e.offsets, np.int64).reshape(-1, 2), np.array([s for s in r[4] if s[0] < s[1]], np.int64).reshape(-1, 2)) for e, r in zip(encoded, rows, strict=True)]
            lists = pa.list_(pa.int32())
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.string()),
                    pa.array([e.ids for e in encoded], lists), pa.array([m[0] for m in masks], lists), pa.array([m[1] for m in masks], lists),
                ],
                names=["conv_id", "segment", "turns", "text", "ids", "loss_start", "loss_end"],
            )
            rows.clear()
            return batch

        conv, number, turns, held = None, 0, [], -1
        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if held >= 0 and (c != conv or held > segment):
                    add(conv, number, turns)
                    number, turns, held = (number + 1 if c == conv else 0), [], 0
                conv, held = c, max(held, 0) + len(role) + len(text)
                turns.append((role, text))
                if len(rows) >= 256 or load > segment:
                    yield out()
        if held >= 0:
            add(conv, number, turns)
        if rows:
            yield out()

    width = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return turns.repartition(width, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _SEGMENT)


def digests(formatted: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """What can be read back from ``format_conversations``' rows, one row a conversation.

    A streaming pass over the same partitions: the turns are parsed out of the text, the loss text is
    gathered token by token from the masked spans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None

        def done() -> tuple:
            return state["conv"], state["turns"], state["all"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"], state["tokens"], state["masked"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            names = [x.split()[0] for x in _DIGEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if "sha256" in n else pa.int64()) for i, n in enumerate(names)], names=names)

        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                if r["segment"] == 0:
                    if state is not None:
                        rows.append(done())
                    state = {"conv": r["conv_id"], "turns": 0, "all": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0, "tokens": 0, "masked": 0}
                for role, text in parse(r["text"], loss_role):
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{text}\n".encode())
                text, spans = r["text"], [(a, b) for a, b in zip(r["loss_start"], r["loss_end"], strict=True) if a < b]
                loss = unescape("".join(text[a:b] for a, b in spans))
                state["loss_chars"] += len(loss)
                state["loss"].update(loss.encode())
                state["chars"] += len(text)
                state["tokens"] += len(r["ids"])
                state["masked"] += len(spans)
            if rows:
                yield out(rows)
        if state is not None:
            yield out([done()])

    return formatted.mapInArrow(run, _DIGEST)
