"""Plain-Python versions of the operators, and small tables with the awkward cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, chunk string, bucket int, key string, score string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["ba", "né", "tor", "li", "ßu", "x", "gan"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(seed: int = 7, n: int = 40) -> list[tuple]:
    """Rows of DOCS: shared passages, copies, near copies, periodic, blank, empty and null texts, a long
    text, a repeated row, and columns whose names the operators use themselves."""
    rng = random.Random(seed)
    passage, other = prose(rng, 60), prose(rng, 25)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(n)]
    texts[3] = texts[30] = passage
    texts[5] = f"{texts[5]} {passage}"
    texts[8] = f"{passage} {texts[8]} {other}"
    texts[11] = f"{other}\n{texts[11]}\t{passage} {other}"
    words = texts[12].split(" ") + prose(rng, 60).split(" ")
    texts[12] = " ".join(words)
    for i in (13, 14, 15):
        words = list(words)
        words[rng.randrange(len(words))] = "changed"
        texts[i] = " ".join(words)
    texts[17], texts[18], texts[19], texts[20] = "", None, " \n\t ", "a" * 450
    texts[21], texts[22], texts[23] = "ab" * 130, "one", "ONE"
    texts[24], texts[25] = "one two", "One Two"
    texts[26] = prose(rng, 4000)
    texts[27] = "\n".join([other] * 4)
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["src0", "src0", "src1", "web", None]), 0, "c", 1, "k", "s") for i, t in enumerate(texts)]
    return rows


def find(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def near_duplicates(rows: list[tuple[int, str | None]], k: int, percent: int = 80) -> dict[int, tuple]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, parent = {}, {i: i for i, _ in rows}
    for i, text in rows:
        w = WORD.findall((text or "").translate(lower))
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    return {i: (i, len(s), find(parent, i), find(parent, i) == i) for i, s in sets.items()}


def repeated_bytes(rows: list[tuple[int, str | None]], match: int = 100) -> dict[int, tuple]:
    first: dict[bytes, tuple[int, int]] = {}
    out = {}
    for i, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - match + 1):
            if first.setdefault(b[a : a + match], (i, a)) != (i, a):
                gone[a : a + match] = b"\1" * match
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for a in range(len(b)) if gone[a] and (a == 0 or not gone[a - 1]))
        out[i] = (i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeated_windows(rows: list[tuple[int, str | None]], size: int = 13) -> dict[int, tuple]:
    first: dict[tuple, int] = {}
    out = {}
    for i, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for a in range(len(w) - size + 1):
            if first.setdefault(tuple(w[a : a + size]), i) < i:
                gone[a : a + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def conversation_digests(rows: list[tuple]) -> dict[int, tuple]:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, v in turns.items():
        v.sort()
        loss = "".join(t for _, r, t in v if r == "assistant")
        sha = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in v).encode()).hexdigest()
        out[conv] = (conv, len(v), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def packed_wrong(rows: list, tokens: dict[int, list[int]], longest: int = 2048) -> list[str]:
    """What is wrong with the pieces: every id in one piece, sequences gapless and full."""
    import zlib

    import numpy as np

    wrong, by_doc, by_sequence = [], defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, ids in tokens.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            crc = zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            if (r.start, r.doc_tokens, r.ids_crc32) != (at, len(ids), crc):
                wrong.append(f"document {i} at {at}")
            at += r.length
        if at != len(ids):
            wrong.append(f"document {i} ends at {at}")
    for s, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            if r.offset != at:
                wrong.append(f"sequence {s} at {at}")
            at += r.length
        if at > longest or at & (at - 1):
            wrong.append(f"sequence {s} has {at}")
    return wrong


def rows_of(df, *columns) -> Counter:
    return Counter(tuple(r) for r in df.select(*columns).collect())
