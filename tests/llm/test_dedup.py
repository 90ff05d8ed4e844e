"""Near-dedup, suffix dedup and substring dedup against brute force."""

import numpy as np
import pytest

from dailywire.llm import graph, minhash, substring, suffix

from . import brute


@pytest.fixture(scope="module")
def rows():
    return brute.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.DOCS).repartition(3).cache()


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(docs, rows, shingle):
    expected = brute.near_duplicates(pairs(rows), shingle)
    assert {r[0]: tuple(r) for r in minhash.near_duplicates(docs, shingle).collect()} == expected


def test_near_duplicates_in_blocks(docs, rows):
    """Keys and clusters split into blocks give the same components."""
    expected = brute.near_duplicates(pairs(rows), 2)
    assert {r[0]: tuple(r) for r in minhash.near_duplicates(docs, 2, block=2, block_shingles=150).collect()} == expected


def test_near_duplicates_null_ids_and_repeats(spark):
    x = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, "a B c"), (9, "z")], "doc_id long, text string")
    got = brute.rows_of(minhash.near_duplicates(x, 2), "doc_id", "n_shingles", "component_id", "kept")
    assert got == {(None, 2, None, True): 1, (4, 2, 2, False): 2, (2, 2, 2, True): 1, (9, 1, 9, True): 1}


def test_estimate_is_close():
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2))
    a, b = np.sort(h[:2500]), np.sort(h[500:])
    r = [minhash.registers(x, np.zeros(len(x), int), 1) for x in (a, b)]
    j, filled = minhash.estimate(r[0], np.array([len(a)]), r[1][0], len(b))
    assert filled[0] == 128 and abs(j[0] - 2000 / len(h)) < 0.15


def test_band_keys_agree_on_equal_sets():
    h = np.sort(np.random.default_rng(1).integers(0, 2**63, 7, dtype=np.uint64))
    both = minhash.registers(np.concatenate([h, h]), np.repeat([0, 1], len(h)), 2)
    keys = minhash.band_keys(both)
    assert (keys[0] == keys[1]).all() and len(set(keys[0].tolist())) == keys.shape[1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 30), (40, 50), (7, 7)] + [(100, i) for i in range(101, 140)]
    got = {r.a: r.b for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 21)} | {40: 30, 50: 30} | {i: 100 for i in range(101, 140)}


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 3000, "suffixes": 4000}, {"chunk_bytes": 3000, "hot": 0}])
def test_repeated_bytes(docs, rows, options):
    expected = brute.repeated_bytes(pairs(rows))
    out = suffix.remove_repeats(docs, carry=["lang", "chunk"], **options).collect()
    assert {r.doc_id: (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == expected
    assert all(r.chunk == "c" and r.lang == rows[r.doc_id][2] for r in out)


def test_phrase_larger_than_a_bucket_is_split(spark, monkeypatch, tmp_path):
    """A short phrase in ever new contexts, 110,000 times: with the defaults its super-windows make more
    than a bucket, and no bucket may get them all. Planted copies are still cut, and nothing else is."""
    import hashlib

    def body(i):
        return hashlib.sha512(str(i).encode()).hexdigest()

    phrase = "Licensed under the terms that the file beside this one states."
    rows = [(i, f"{body(i)} {phrase} {body(-i - 1)}") for i in range(110_000)]
    rows += [(200_000 + i, f"{i:06d}#{rows[i][1][60:230]}#") for i in range(0, 110_000, 1000)]
    inner, seen = suffix._from_bytes, str(tmp_path / "bytes")

    def measured(place, chunk, data, match):
        with open(seen, "a") as f:
            print(len(data), file=f)
        return inner(place, chunk, data, match)

    monkeypatch.setattr(suffix, "_from_bytes", measured)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix.remove_repeats(docs).where("n_removed > 0").select("doc_id", "n_removed").collect()
    assert {tuple(r) for r in got} == {(200_000 + i, 170) for i in range(0, 110_000, 1000)}
    with open(seen) as f:
        assert max(map(int, f)) < suffix.SUFFIXES // 2


def test_repeated_bytes_null_ids_and_repeats(spark):
    text = "".join(chr(97 + i * i % 23) + str(i) for i in range(60))
    x = spark.createDataFrame([(3, text), (3, text), (None, text), (5, text[:99])], "doc_id long, text string")
    n = len(text)
    assert brute.rows_of(suffix.remove_repeats(x), "doc_id", "n_removed") == {(None, 0): 1, (3, n): 2, (5, 0): 1}


def test_suffix_classes_are_exact():
    rng = np.random.default_rng(0)
    piece = rng.integers(0, 2, 400, dtype=np.uint8)
    data = np.concatenate([piece, rng.integers(0, 2, 100, dtype=np.uint8), piece[:250], piece[30:380], np.zeros(300, np.uint8)])
    at = np.arange(len(data) - 400)
    order, new = suffix.suffix_classes(data, at, 100)
    group = np.empty(len(at), int)
    group[order] = np.cumsum(new)
    seen = {}
    for i in at:
        assert seen.setdefault(data[i : i + 100].tobytes(), group[i]) == group[i]
    assert len(seen) == group.max()


def test_covers():
    for period, cover in ((suffix.PERIOD, suffix.COVER), (substring.PERIOD, substring.COVER)):
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    with pytest.raises(ValueError):
        suffix._shifts(7, (1, 2))


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 3000, "bucket": 100}])
def test_repeated_windows(docs, rows, options):
    out = substring.remove_repeated_windows(docs, **options).collect()
    assert {r[0]: tuple(r)[:4] for r in out} == brute.repeated_windows(pairs(rows))


def test_repeated_windows_null_ids_and_repeats(spark):
    text = " ".join(f"w{i}" for i in range(14))
    x = spark.createDataFrame([(3, text), (3, text), (None, text), (2, "w1")], "doc_id long, text string")
    assert brute.rows_of(substring.remove_repeated_windows(x), "doc_id", "n_removed") == {(None, 0): 1, (3, 14): 2, (2, 0): 1}


@pytest.mark.parametrize("run", [minhash.near_duplicates, suffix.remove_repeats, substring.remove_repeated_windows])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], brute.DOCS)).collect() == []
