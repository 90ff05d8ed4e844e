"""Filter audit, Merkle manifest, n-gram join and word hashing against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dailywire.llm import audit, manifest, minhash, prefix_join, substring, texthash, verify

from . import brute

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def rows():
    """Odd rows beside ``documents``: null and repeated ids, an equal row, capitals, signs, a shared text."""
    base = brute.documents()
    more = [
        (None, base[3][1], None, "src0", 0), (None, base[3][1], None, "src0", 0), (None, "null id", "fr", "web", None),
        (3, base[3][1], base[3][2], base[3][3], base[3][4]), (3, "another text of id 3", "en", "src1", 5), (3, "and one more", "en", "src1", 5),
        (-70_000, "ABC DEF & co", "en", "", 3), (1 << 40, "far $ away", "de", "src9", 1), (600, base[26][1], "fr", None, 2), (601, base[5][1] + "!", "zz", "src1", 1),
    ]
    return base + [(*r, "c", 1, "k", "s") for r in more]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.DOCS).repartition(3).cache()


def audited(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(r[0], first.get(r[1] or "", r[0]))
    counted = defaultdict(Counter)
    for i, text, _, source, *_ in rows:
        t = text or ""
        w = brute.WORD.findall(t)
        fails = frozenset(
            x for x, bad in zip("ABCDE", [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                                          any(c in t for c in "#$%&*|"), i is not None and i > first[t]], strict=True) if bad)
        counted[source or ""][fails, i in good, i in toxic] += 1
    out = {}
    for part, docs in counted.items():
        n = lambda keep, docs=docs: sum(c for k, c in docs.items() if keep(k))
        share = Counter()
        for order in permutations("ABCDE"):
            for s, x in enumerate(order):
                share[x] += n(lambda k: x in k[0] and not k[0] & set(order[:s]))
        for order in permutations("ABCDE"):
            for s, x in enumerate(order):
                before = set(order[:s])
                here = lambda k: x in k[0] and not k[0] & before
                out[part, "".join(order), s + 1] = (
                    n(lambda k: not k[0] & (before | {x})), n(here), n(lambda k: x in k[0] and k[0] & before), n(lambda k: k[0] == {x}),
                    n(lambda k: here(k) and k[1]), n(lambda k: here(k) and k[2]), share[x])
    return out


def test_audit(spark, docs, rows):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(30)] + [(3, 1, 1), (None, 1, 1), (7, None, None), (601, 1, 0)]
    got = audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == audited(rows, labels)


def test_audit_of_an_empty_table(spark):
    empty = spark.createDataFrame([], brute.DOCS)
    assert audit.audit(empty, spark.createDataFrame([], LABELS)).collect() == []


def test_positional_counts():
    words = np.random.default_rng(0).integers(0, 1 << 32, 1001, dtype=np.uint64).astype(np.uint32)
    for n in (0, 1, 2, 3, 1001):
        expected = [(int(sum(words[:n].astype(int) >> b & 1))) for b in range(32)]
        assert audit.positional_counts(words[:n]).tolist() == expected


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def proven(rows, tampered):
    """Counter of (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    def leaf(i, source, lang, n, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))

    by_lang = defaultdict(list)
    for i, text, lang, source, n, *_ in rows:
        other = leaf(i, source, lang, n, tampered(text)) if i is not None and text is not None and zlib.crc32(str(i).encode()) % 3 == 0 else None
        by_lang[lang].append((i is not None, i or 0, leaf(i, source, lang, n, text), i, other))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][a : a + 8])) for a in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, at):
        out = []
        for level in levels[:-1]:
            a = at // 8 * 8
            out.append(("".join(level[a:at]), "".join(level[at + 1 : a + 8])))
            at //= 8
        return out

    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([x[2] for x in sorted(by_lang[lang], key=lambda x: x[:3])]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    out = Counter()
    for g, lang in enumerate(langs):
        for at, (_, _, own, i, other) in enumerate(sorted(by_lang[lang], key=lambda x: x[:3])):
            path = way(trees[lang], at) + way(top, g)
            node = other or own
            for a, b in path:
                node = h(a + node + b)
            out[i, own, trees[lang][-1][0], top[-1][0], h("".join(a + b for a, b in path)), node, node == top[-1][0]] += 1
    return out


LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def proofs(docs, **options):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return manifest.proofs(docs, F.when(third, F.translate("text", letters, letters.lower())), **options)


def test_manifest(docs, rows):
    out = proofs(docs, with_siblings=True).cache()
    got = Counter(tuple(r) for r in out.select(*COLUMNS).collect())
    # which of the rows with one id and different texts comes first is a matter of their leaves
    assert got == proven(rows, lambda t: t.translate(LOWER))
    for r in out.collect():
        assert hashlib.sha256("".join(r.siblings).encode()).hexdigest() == r.proof_sha256 and len(r.slots) == len(r.siblings)


def test_manifest_of_many_levels(spark):
    rng = random.Random(5)
    ids = rng.sample(range(5_000), 1100)  # three passes of blocks in one lang, one leaf in another
    rows = [(i, f"T{i}" if i % 2 else None, "xx", None, i) for i in ids] + [(7, "Alone", None, "s", 1)] + [(i, "x", f"l{i}", "s", 1) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = Counter(tuple(r) for r in proofs(docs).select(*COLUMNS).collect())
    assert got == proven(rows, lambda t: t.translate(LOWER))


@pytest.mark.parametrize("n", [0, 1, 8])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "T", "en", "s", 1) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(tuple(r) for r in proofs(docs).select(*COLUMNS).collect()) == proven(rows, lambda t: t.translate(LOWER))


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("options", [{}, {"block": 2, "block_shingles": 150}, {"shingle": 2}, {"percent": 50}])
def test_join(spark, options, monkeypatch):
    rows = pairs(brute.documents(11, 60))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = {i: v[:3] for i, v in brute.near_duplicates(rows, options.get("shingle", 5), options.get("percent", 80)).items()}
    assert {r[0]: tuple(r) for r in prefix_join.similar_documents(docs, **options).collect()} == expected


def test_join_with_frequent_shingles_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_join, "HOT", 4)
    rows = pairs(brute.documents(13, 50))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = {i: v[:3] for i, v in brute.near_duplicates(rows, 5).items()}
    assert {r[0]: tuple(r) for r in prefix_join.similar_documents(docs, block=3).collect()} == expected


def test_join_null_ids_repeats_and_empty(spark):
    x = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, "a B c"), (9, "z"), (4, "z")], "doc_id long, text string")
    got = brute.rows_of(prefix_join.similar_documents(x), "doc_id", "n_shingles", "component_id")
    assert got == {(None, 1, None): 1, (4, 1, 2): 2, (2, 1, 2): 1, (9, 1, 4): 1, (4, 1, 4): 1}
    assert prefix_join.similar_documents(spark.createDataFrame([], brute.DOCS)).collect() == []


def colliding():
    """Two 1,024-byte words whose polynomial hashes modulo 2**64 agree for every odd base."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_different_words_stay_different(spark):
    one, two = colliding()
    text = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{text} {one}"), (2, f"{text} {two}")], "doc_id long, text string")
    assert [r.n_removed for r in substring.remove_repeated_windows(docs).collect()] == [0, 0]
    single = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert sorted(r.component_id for r in minhash.near_duplicates(single, 2).collect()) == [1, 2]
    assert sorted(r.component_id for r in prefix_join.similar_documents(single).collect()) == [1, 2]
    lines = spark.createDataFrame([(i, " ".join([t] * 1)) for i, t in ((1, one[:60]), (2, two[:60]))], "doc_id long, text string")
    assert sorted(r.component_id for r in minhash.near_duplicates(lines, 2).collect()) == [1, 2]


def test_word_digests():
    words = ["a", "b", "ab", "ba", "a\0", "aaaaaaaa", "aaaaaaaaa", "x" * 64, "x" * 65, "y" * 200, *colliding()]
    data, offsets = texthash.text_bytes(pa.array([" ".join(words), words[-1]]))
    starts, ends, _ = texthash.words(data, offsets)
    d = texthash.word_digests(data, starts, ends)
    assert len({tuple(x) for x in d.tolist()}) == len(words) and (d[len(words)] == d[len(words) - 1]).all()
    assert len(set(d.ravel().tolist())) == 2 * len(words)


def test_run_hashes_follow_the_order():
    x = texthash.mix(np.arange(1, 40, dtype=np.uint64))
    twice = np.concatenate([x, x])
    for size in (1, 2, 5, 7, 13):
        out = texthash.run_hashes(twice, size)
        assert len(out) == len(twice) - size + 1 and out[0] == out[len(x)] and len(set(out[: len(x)].tolist())) == len(x)
    assert len(texthash.run_hashes(x[:3], 5)) == 0


def test_shingle_numbers_are_exact():
    texts = ["a b c d e f", "A b c d e f a b c d e", None, "", "a b", "a  B", "b a", "a b c d e"]
    sets = verify.shingle_numbers(pa.array(texts), 5)
    own = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for w in ((t or "").lower().split() for t in texts)]
    for i, a in enumerate(own):
        for j, b in enumerate(own):
            assert len(set(sets[i].tolist()) & set(sets[j].tolist())) == len(a & b)


def test_percent_below_the_bands_is_refused(spark):
    with pytest.raises(ValueError):
        minhash.near_duplicates(spark.createDataFrame([], brute.DOCS), percent=50)
