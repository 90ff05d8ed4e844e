"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier.

1. Voters. One holds a list of common insults; the others hold patterns (whole words, and word starts
   of 3 to 7 bytes) that are far more frequent in toxic than in clean texts of a labelled sample
   (``sample`` rows of each label with texts of at most ``longest`` bytes, out of an eighth more drawn; of
   each kind the ``patterns`` that tell most); the last one fires if a
   hundredth of the words match. Each votes toxic on a text or abstains.
2. Label model. The votes on all documents, counted by vote pattern, are explained by a hidden label:
   expectation maximisation estimates each voter's rates on both labels and, from what the labels leave
   unexplained, which voters depend on each other (a tree of pairwise correlations).
   Documents with a label to learn from keep it there. This gives each vote pattern a posterior.
3. Classifier. Logistic regression on hashed words and word starts (share of the text's words), with
   the log ratio of their document rates as scale, is trained on the posteriors of at most ``sample``
   documents of each side, and scores every whole text.

Labels come only from rows for which ``learn`` holds; lang, source and doc_id are no inputs. The
samples are the documents of smallest hash, so they are the same in every run.

Defined cases: null or empty text has the score of a text without features, that is the clean side's;
null labels are skipped, and a doc_id labelled twice is toxic if one label says so; a null doc_id is
scored but never sampled; without toxic labels only the fixed list votes; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dailywire.session import checkpoint

from . import texthash, workers

INSULTS = ("idiot", "moron", "stupid", "dumb", "loser", "pathetic", "worthless", "trash", "scum", "disgusting", "clown", "imbecile", "vermin", "filth", "bastard", "scumbag", "dumbass", "garbage")
STARTS = (3, 4, 5, 6, 7)
SAMPLE = 2000
LONGEST = 1 << 16
PATTERNS = 2000
BITS = 18
ROUNDS = 200
DENSE = 0.01
#: Standard errors by which log ratios are drawn to 0 and the documents added to each side for them, of
#: the patterns and of the classifier's features.
PATTERN_ERRORS, FEATURE_ERRORS = (2.0, 0.5), (4.0, 1.0)
#: Features are log ratios times shares of words; this brings a share of one in a hundred near 1.
SCALE = 100.0

_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,!?;:\"'()[]*&%$#|<>-_~`"]] = True


def features(column) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first document, its number for each feature, kind, hash) per block: kind 0 is the whole word in
    lower case without punctuation at its edges, kind k > 0 its first STARTS[k - 1] bytes."""
    data, offsets = texthash.text_bytes(column)
    for a, b in texthash.blocks(offsets):
        part = data[offsets[a] : offsets[b]]
        starts, ends, first = texthash.words(part, offsets[a : b + 1] - offsets[a])
        doc = np.repeat(np.arange(a, b), np.diff(first))
        for _ in range(3):
            ends = ends - ((ends - starts > 1) & _EDGE[part[ends - 1]])
            starts = starts + ((ends - starts > 1) & _EDGE[part[starts]])
        p = texthash.prefix(texthash.byte_values(part, lower=True), texthash.BASE_A)
        docs, kinds, hashes = [doc], [np.zeros(len(doc), np.int8)], [texthash.span_hash(p, texthash.BASE_A, starts, ends)]
        for kind, n in enumerate(STARTS, 1):
            long = np.flatnonzero(ends - starts > n)
            docs.append(doc[long])
            kinds.append(np.full(len(long), kind, np.int8))
            hashes.append(texthash.span_hash(p, texthash.BASE_A, starts[long], starts[long] + n))
        kind = np.concatenate(kinds)
        # a word start is another feature than the word of the same letters
        yield a, np.concatenate(docs), kind, texthash.mix(np.concatenate(hashes) + kind.astype(np.uint64))


def _insult_hashes() -> np.ndarray:
    (_, _, kind, h), = features(pa.array([" ".join(INSULTS)]))
    return np.sort(h[kind == 0])


def _counted(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs and how often each occurs."""
    by = np.lexsort((hashes, docs))
    docs, hashes = docs[by], hashes[by]
    new = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])]) if len(docs) else np.zeros(0, np.int64)
    return docs[new], hashes[new], np.diff(np.r_[new, len(docs)])


_ROWS = "target double, words long, kinds binary, hashes binary, counts binary"


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sampled document: its distinct features."""
    for batch in batches:
        targets, out = batch.column("target"), {k: [] for k in ("target", "words", "kinds", "hashes", "counts")}
        n = batch.num_rows
        seen = np.zeros(n, bool)
        for _, doc, kind, h in features(batch.column("text")):
            words = np.bincount(doc[kind == 0], minlength=n)
            d, hh, c = _counted(doc, h)
            by = np.argsort(h, kind="stable")
            kinds = kind[by[np.searchsorted(h[by], hh)]]
            cuts = np.searchsorted(d, np.arange(n + 1))
            for i in np.unique(d):
                lo, hi = cuts[i], cuts[i + 1]
                seen[i] = True
                for k, v in (("target", targets[int(i)].as_py()), ("words", int(words[i])), ("kinds", kinds[lo:hi].tobytes()), ("hashes", hh[lo:hi].tobytes()), ("counts", c[lo:hi].astype(np.int32).tobytes())):
                    out[k].append(v)
        for i in np.flatnonzero(~seen):
            for k, v in (("target", targets[int(i)].as_py()), ("words", 0), ("kinds", b""), ("hashes", b""), ("counts", b"")):
                out[k].append(v)
        types = [pa.float64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(out, types, strict=True)], names=list(out))


def _gathered(table: pa.Table):
    """(target of each document, words of each, document, kind, hash, count of each feature)."""
    hashes = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
    sizes = [len(x) for x in hashes]
    join = lambda name, t: np.frombuffer(b"".join(table[name].to_pylist()), t)
    return np.array(table["target"], float), np.array(table["words"], float), np.repeat(np.arange(len(sizes)), sizes), join("kinds", np.int8), join("hashes", np.uint64), join("counts", np.int32)


def _ratio(hits: np.ndarray, clean: np.ndarray, n: float, m: float, errors: float, pseudo: float) -> np.ndarray:
    """Log ratio of a feature's document rates on the two sides, drawn to 0 by so many standard errors
    (with ``pseudo`` documents more on each side)."""
    ratio = np.log((hits + 0.5) / (n + 1)) - np.log((clean + 0.5) / (m + 1))
    error = np.sqrt(1 / (hits + pseudo) + 1 / (clean + pseudo))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - errors * error, 0)


def _mine(limit: int):
    """Patterns of the labelled sample: kind and hash."""

    def run(table: pa.Table) -> pa.Table:
        target, _, doc, kind, h, _ = _gathered(table)
        toxic = target > 0.5
        n, m = toxic.sum(), (~toxic).sum()
        unique, first, group = np.unique(h, return_index=True, return_inverse=True)
        hits = np.bincount(group, weights=toxic[doc], minlength=len(unique))
        clean = np.bincount(group, minlength=len(unique)) - hits
        ratio = _ratio(hits, clean, n, m, *PATTERN_ERRORS)
        good = np.flatnonzero(ratio > np.log(5))
        kept = [good[kind[first[good]] == k] for k in range(len(STARTS) + 1)]
        kept = np.concatenate([g[np.argsort(-hits[g] * ratio[g], kind="stable")][:limit] for g in kept]).astype(np.int64)
        return pa.table({"voter": pa.array(kind[first[kept]].astype(np.int32)), "hash": pa.array(unique[kept].view(np.int64))})

    return run


class Voters:
    """Bit j of a vote is voter j: kinds of mined patterns, the fixed list, and the share of matches."""

    def __init__(self, mined: list[tuple[int, int]]):
        self.fixed, self.dense = len(STARTS) + 1, len(STARTS) + 2
        entries = [(np.uint64(h % (1 << 64)), v) for v, h in mined] + [(h, self.fixed) for h in _insult_hashes()]
        entries.sort()
        self.hashes = np.array([h for h, _ in entries], np.uint64)
        self.voter = np.array([v for _, v in entries], np.int64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    @property
    def count(self) -> int:
        return self.dense + 1

    def votes(self, column) -> np.ndarray:
        out = np.zeros(len(column), np.int64)
        for _, doc, kind, h in features(column):
            near = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
            words = np.bincount(doc[kind == 0], minlength=len(out))
            matched = np.zeros(len(out), np.int64)
            for shift in (0, 1):  # a mined pattern may be on the fixed list too
                at = np.searchsorted(self.hashes, h[near]) + shift
                ok = at < len(self.hashes)
                at, rows = at[ok], near[ok]
                ok = self.hashes[at] == h[rows]
                np.bitwise_or.at(out, doc[rows[ok]], np.int64(1) << self.voter[at[ok]])
                if not shift:
                    matched += np.bincount(doc[rows[ok]], minlength=len(out))
            out[(matched > 0) & (matched >= DENSE * words)] |= np.int64(1) << self.dense
        return out


def _tree(joint: np.ndarray, mass: np.ndarray) -> list[tuple[int, int]]:
    """(voter, the voter it depends on, -1 for the first) along the spanning tree of greatest mutual
    information given the label. ``joint[y, j, k]`` is the rate at which j and k both fire on side y."""
    n = joint.shape[1]
    one = np.diagonal(joint, axis1=1, axis2=2)
    a, b = one[:, :, None], one[:, None, :]
    info = np.zeros((n, n))
    for p, q in ((joint, a * b), (a - joint, a * (1 - b)), (b - joint, (1 - a) * b), (1 - a - b + joint, (1 - a) * (1 - b))):
        p = np.maximum(p, 1e-12)
        info += (mass[:, None, None] * p * np.log(p / np.maximum(q, 1e-12))).sum(axis=0)
    order, left = [(0, -1)], set(range(1, n))
    while left:
        j, k = max(((j, k) for j in left for k, _ in order), key=lambda e: (info[e], -e[0], -e[1]))
        order.append((j, k))
        left.remove(j)
    return order


def label_model(patterns: np.ndarray, counts: np.ndarray, known: np.ndarray, voters: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of each vote pattern, (2, voters) rates, (2, voters, voters) rates of pairs).

    Given the label, each voter depends on one other along a tree, chosen anew in each round, so what
    a voter repeats of another counts once. ``known`` is the label of the documents that a row counts,
    NaN where they have none; known labels stay as they are, so the two sides keep their meaning. The
    posterior is that of the votes alone.
    """
    v = (patterns[:, None] >> np.arange(voters) & 1).astype(float)
    free = np.isnan(known)
    posterior = np.clip(v.mean(axis=1) * 1.5, 0.01, 0.99)
    for _ in range(rounds):
        side = np.where(free, posterior, known)
        weight = np.stack([(1 - side) * counts, side * counts])
        mass = weight.sum(axis=1)
        joint = np.stack([(w[:, None] * v).T @ v for w in weight])
        rates = (np.diagonal(joint, axis1=1, axis2=2) + 0.1) / (mass[:, None] + 0.2)
        pairs = joint / np.maximum(mass, 1e-9)[:, None, None]
        prior = np.clip(mass[1] / mass.sum(), 1e-4, 0.5)
        logit = np.full(len(patterns), np.log(prior / (1 - prior)))
        for j, k in _tree(pairs, mass / mass.sum()):
            if k < 0:
                p = np.broadcast_to(rates[:, j][:, None], (2, len(patterns)))
            else:  # rate of j where k fires and where it does not, drawn to the plain rate
                both, base = joint[:, j, k], np.stack([mass - joint[:, k, k], joint[:, k, k]])
                hit = np.stack([joint[:, j, j] - both, both])
                given = (hit + 0.5 * rates[:, j]) / (base + 0.5)
                p = given[v[:, k].astype(int), :].T
            p = np.clip(np.where(v[:, j] > 0, p, 1 - p), 1e-4, 1)
            logit = logit + np.log(p[1]) - np.log(p[0])
        # a text on which no voter fires is no evidence of toxicity
        logit = np.where(v.any(axis=1), logit, np.minimum(logit, -2.0))
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return posterior, rates, pairs


def _train(bits: int, rounds: int = 600):
    """Weights (the last one the intercept) of the classifier, from one task's bounded sample."""

    def run(table: pa.Table) -> pa.Table:
        y, words, doc, _, h, count = _gathered(table)
        cell = (h >> np.uint64(64 - bits)).astype(np.int64)
        d, cell, group = (lambda u, g: (u >> bits, u & ((1 << bits) - 1), g))(*np.unique((doc.astype(np.int64) << bits) | cell, return_inverse=True))
        share = SCALE * np.bincount(group, weights=count, minlength=len(d)) / np.maximum(words[d], 1)
        hits, clean = (np.bincount(cell, weights=t[d], minlength=1 << bits) for t in (y, 1 - y))
        ratio = _ratio(hits, clean, y.sum(), (1 - y).sum(), *FEATURE_ERRORS)
        live = ratio[cell] != 0
        d, cell, x = d[live], cell[live], (share * ratio[cell])[live]
        n = max(len(y), 1)
        w, bias = np.zeros(1 << bits), float(np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5)))
        if 0.5 < y.sum() < n - 0.5:
            square, square_b, rate, decay = np.full(1 << bits, 1e-8), 1e-8, 0.05, 1e-4
            for _ in range(rounds):
                z = bias + np.bincount(d, weights=x * w[cell], minlength=len(y))
                r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
                g = np.bincount(cell, weights=x * r[d], minlength=1 << bits) + decay * w / n
                square, square_b = square + g * g, square_b + r.sum() ** 2
                w, bias = w - rate * g / np.sqrt(square), bias - rate * r.sum() / np.sqrt(square_b)
        weights = np.concatenate([w * ratio, [bias]]).astype(np.float32)
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary())})

    return run


def score_texts(column, weights: np.ndarray, bits: int) -> np.ndarray:
    total, words = np.zeros(len(column)), np.zeros(len(column))
    for _, doc, kind, h in features(column):
        total += np.bincount(doc, weights=weights[(h >> np.uint64(64 - bits)).astype(np.int64)], minlength=len(total))
        words += np.bincount(doc[kind == 0], minlength=len(total))
    z = weights[-1] + SCALE * total / np.maximum(words, 1)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, patterns: int = PATTERNS, bits: int = BITS, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted, *carry). ``labels`` has doc_id and toxic (0 or 1);
    ``carry`` names columns of ``docs`` to hand through."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def smallest(rows: DataFrame) -> DataFrame:
        """An eighth more than needed, for those whose texts are too long or missing."""
        return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample + sample // 8)

    def in_one_task(chosen: DataFrame, run, schema: str) -> list:
        """``run`` on the sampled documents' features: the ids drawn, 9 / 4 * sample rows at most, are broadcast, and
        the first ``sample`` of each side that have a text within ``longest`` are used."""
        rows = texts.where((F.octet_length("text") <= longest) & F.col("doc_id").isNotNull()).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
        turn = Window.partitionBy(F.col("target") >= 0.5).orderBy(F.xxhash64("doc_id"), "doc_id")
        # dealt out anew: the turns lie in two tasks
        rows = rows.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= sample).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")
        return rows.select("text", "target").mapInArrow(workers.giving_back(_feature_rows), _ROWS).groupBy().applyInArrow(workers.giving_back(run), schema).collect()

    marked = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("double").alias("target"))
    marked = marked.where(~held_out(F.col("doc_id")))
    chosen = smallest(marked.where("target > 0")).union(smallest(marked.where("target = 0")))
    voters = Voters([tuple(r) for r in in_one_task(chosen, _mine(patterns), "voter int, hash long")])

    def vote(batches):
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(voters.votes(batch.column("text"))), size], names=["doc_id", "votes", "size"])

    votes = checkpoint(texts.mapInArrow(workers.giving_back(vote), "doc_id long, votes long, size long"))
    # a row per vote pattern and label: at most 3 * 2 ** voters
    seen = votes.join(marked, "doc_id", "left").groupBy("votes", "target").count().collect()
    if not seen:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(False).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), *carry)
    posterior, _, _ = label_model(np.array([r[0] for r in seen], np.int64), np.array([r[2] for r in seen], float), np.array([r[1] for r in seen], float), voters.count)
    of_pattern = dict(zip([r[0] for r in seen], posterior.tolist(), strict=True))

    # the sample as pattern by pattern: the posterior is looked up by the pattern
    table = F.create_map(*[F.lit(x) for item in sorted(of_pattern.items()) for x in item])
    soft = votes.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & (F.col("size") <= longest)).groupBy("doc_id").agg(F.max("votes").alias("votes")).select("doc_id", table[F.col("votes")].alias("target"))
    chosen = smallest(soft.where("target >= 0.5")).union(smallest(soft.where("target < 0.5")))
    (trained,) = in_one_task(chosen, _train(bits), "weights binary") or [(np.concatenate([np.zeros(1 << bits), [-2.0]]).astype(np.float32).tobytes(),)]
    weights = np.frombuffer(trained[0], np.float32).astype(float)

    def score(batches):
        for batch in batches:
            scores = pa.array(score_texts(batch.column("text"), weights, bits))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores, *([batch.column("carry")] if carry else [])], names=names)

    extra = [F.struct(*carry).alias("carry")] if carry else []
    names = ["doc_id", "score"] + ["carry"] * bool(carry)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
    schema = StructType().add("doc_id", "long").add("score", "double")
    schema = schema.add(rows.schema["carry"]) if carry else schema
    scored = rows.mapInArrow(workers.giving_back(score), schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *(["carry.*"] if carry else []))
