"""Mixing against its SQL, WARC round trips, and toxicity on planted texts."""

import gzip
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow.fs as fs
import pytest
from pyspark.sql import functions as F

from dailywire.llm import mixing, mixing_sql, queries, toxicity, warc

from . import brute


def by_sql(rows, sql):
    documents = pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "text", "lang", "source"])  # noqa: F841 - read by name
    return Counter(duckdb.sql(sql).fetchall())


@pytest.mark.parametrize(("epochs", "part"), [(2, "total div 2"), (1, "total * 9 div 10"), (3, "total * 5"), (1, "0")])
def test_mix_equals_its_sql(spark, epochs, part):
    rows = brute.documents()
    got = brute.rows_of(queries.mix(spark.createDataFrame(rows, brute.DOCS), epochs, part), "doc_id", "domain", "lang", "source", "epoch", "tokens", "take")
    assert got == by_sql(rows, mixing_sql.mix(queries.WEIGHTS, epochs, part.replace(" div ", " // ")))
    total = sum(len(brute.WORD.findall(r[1] or "")) for r in rows)
    budget = {"total div 2": total // 2, "total * 9 div 10": total * 9 // 10, "total * 5": total * 3, "0": 0}[part]
    assert sum(k[-1] * n for k, n in got.items()) == budget


def test_shortages_go_to_siblings_first(spark):
    """x/a is short of its share: x/b takes that, y stays at its own share."""
    docs = [(i, "w " * 10, "a", "x") for i in range(2)] + [(i + 10, "w " * 10, "b", "x") for i in range(30)] + [(i + 100, "w " * 10, "a", "y") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = mixing.mixed(df, F.col("source"), F.lit(400), tokens=F.lit(10).cast("long")).groupBy("domain", "lang").agg(F.sum("take")).collect()
    assert {(a, b): n for a, b, n in got} == {("x", "a"): 20, ("x", "b"): 180, ("y", "a"): 200}


def test_shortage_of_a_subtree_goes_to_the_ancestors_children(spark):
    docs = [(1, "w", "a", "x"), (2, "w", "b", "x")] + [(i + 10, "w", "a", "y") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = mixing.mixed(df, F.col("source"), F.lit(20)).groupBy("domain").agg(F.sum("take")).collect()
    assert {a: n for a, n in got} == {"x": 2, "y": 18}


def test_epochs_repeat_whole_documents_and_end_in_a_prefix(spark):
    df = spark.createDataFrame([(i, "w w w", "a", "x") for i in range(10)], "doc_id long, text string, lang string, source string")
    got = mixing.mixed(df, F.col("source"), F.lit(70), epochs=3).collect()
    by_epoch = Counter(r.epoch for r in got)
    assert by_epoch == {0: 10, 1: 10, 2: 4} and sorted(r.take for r in got if r.epoch == 2) == [1, 3, 3, 3]


def test_mix_of_odd_rows(spark):
    rows = [(None, "a b", None, None), (None, "a b", None, None), (1, None, "x", "y"), (2, "", "x", "y"), (3, "c", "x", "src3")]
    got = queries.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 1, "total")
    assert brute.rows_of(got, "doc_id", "domain", "lang", "source", "take") == {(None, "other", "", "", 2): 2, (3, "domain3", "x", "src3", 1): 1}
    assert queries.mix(spark.createDataFrame([], brute.DOCS)).collect() == []


PAGES = [(1, "http://a/\r\nX: y", "p" * 100), (2, None, "p" * 100), (3, "http://c/100%", "short"), (4, "u", "short"), (5, "u", None), (6, "u", "é" * 50), (7, "u", "é" * 50), (7, "u", "é" * 50), (None, "u", "p" * 100), (9, "u", "x\r\n\r\nWARC/1.1\r\n" * 20)]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    path = f"file://{tmp_path}/archive"
    warc.export_pages(pages, path)
    got = warc.read(spark, path).collect()
    responses = Counter((r.page_id, r.target_uri, r.payload.decode()) for r in got if r.record_type == "response")
    assert responses == Counter([(1, "http://a/\r\nX: y", "p" * 100), (3, "http://c/100%", "short"), (4, "u", "short"), (5, "u", ""), (6, "u", "é" * 50), (None, "u", "p" * 100), (9, "u", "x\r\n\r\nWARC/1.1\r\n" * 20)])
    revisits = Counter((r.page_id, r.refers_to, r.payload_bytes, r.payload) for r in got if r.record_type == "revisit")
    assert revisits == Counter([(2, 1, 100, None), (7, 6, 100, None), (7, 6, 100, None)])


def test_warc_predicates_and_skipped_payloads(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    warc.export_pages(spark.createDataFrame(PAGES, "page_id long, url string, html string"), path)
    back = warc.read(spark, path)
    filtered = back.where("record_type = 'revisit' and page_id in (2, 3, 7)")
    assert brute.rows_of(filtered, "page_id", "refers_to") == {(2, 1): 1, (7, 6): 2}
    assert brute.rows_of(back.where("record_type = 'response' and page_id > 4 and target_uri = 'u'"), "page_id") == {(5,): 1, (6,): 1, (9,): 1}
    assert all(r.payload is None for r in warc.read(spark, path, payload=False).collect())


def test_warc_reader_skips_without_inflating(tmp_path):
    row = {"record_type": "response", "page_id": 1, "target_uri": "u" * 6000, "payload_digest": "d", "payload_bytes": 9, "refers_to": None, "payload": b"z" * 50_000}
    (tmp_path / "x.warc.gz").write_bytes(b"".join(warc.encode_record(row | {"page_id": i}) for i in range(5)))
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "x.warc.gz")) as f:
        got = list(warc.read_records(f, {"page_id": (3,)}, True))
    assert [(r["page_id"], len(r["payload"]), r["target_uri"]) for r in got] == [(3, 50_000, "u" * 6000)]

    assert gzip.decompress((tmp_path / "x.warc.gz").read_bytes()).count(b"WARC/1.1\r\n") == 5


def test_warc_rolls_and_lists_committed_files_only(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    warc.register(spark)
    rows = spark.createDataFrame([("response", i, "u", "d", 5, None, None, None, bytearray(b"abcde")) for i in range(20)], warc.SCHEMA).coalesce(1)
    rows.write.format("warc").option("roll", "600").mode("append").save(path)
    (tmp_path / "archive" / "part-left-by-a-failed-task.warc.gz").write_bytes(b"junk")
    assert len(list((tmp_path / "archive").glob("part-*.warc.gz"))) > 3 and warc.read(spark, path).count() == 20


def test_warc_appends_add_up_and_overwrite_replaces(spark, tmp_path):
    path, schema = str(tmp_path / "archive"), "page_id long, url string, html string"
    warc.export_pages(spark.createDataFrame([(1, "u", "one")], schema), path)
    warc.export_pages(spark.createDataFrame([(2, "v", "two")], schema), path)
    assert sorted(r.page_id for r in warc.read(spark, path).collect()) == [1, 2]
    (tmp_path / "archive" / "other.warc").write_bytes(FOREIGN[0])
    assert warc.read(spark, path).count() == 3
    rows = spark.createDataFrame([("response", 9, "u", "d", 1, None, None, None, bytearray(b"x"))], warc.SCHEMA)
    rows.write.format("warc").mode("overwrite").save(path)
    assert [r.page_id for r in warc.read(spark, path).collect()] == [9]


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>h\xc3\xa9</p>"
FOREIGN = [
    b"WARC/1.0\r\nwarc-type:warcinfo\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 9\r\n\r\nsoft: one\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/%0Ab\r\nWARC-Record-ID: <urn:uuid:2>\r\nX-Folded: a\r\n  b\r\nno colon\r\n"
    b"Content-Type: application/http;msgtype=response\r\nContent-Length: " + str(len(HTTP)).encode() + b"\r\n\r\n" + HTTP + b"\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: http://b\r\nWARC-Record-ID: <urn:uuid:3>\r\nContent-Length: 20000\r\n\r\n" + b"x\r\n\r\n" * 4000 + b"\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://c\r\nWARC-Record-ID: <urn:uuid:4>\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
]


@pytest.mark.parametrize("kind", ["plain", "members", "whole"])
def test_warc_reads_foreign_archives(spark, tmp_path, kind):
    data = {"plain": b"".join(FOREIGN), "members": b"".join(gzip.compress(r) for r in FOREIGN), "whole": gzip.compress(b"".join(FOREIGN))}[kind]
    (tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")).write_bytes(data)
    (tmp_path / "notes.txt").write_text("not an archive")
    back = warc.read(spark, str(tmp_path))
    got = {r.record_id: (r.record_type, r.target_uri, r.payload_bytes, r.page_id, None if r.payload is None else bytes(r.payload)) for r in back.collect()}
    assert got == {
        "<urn:uuid:1>": ("warcinfo", None, 9, None, b"soft: one"), "<urn:uuid:2>": ("response", "http://a/%0Ab", 10, None, "<p>hé</p>".encode()),
        "<urn:uuid:3>": ("resource", "http://b", 20000, None, b"x\r\n\r\n" * 4000), "<urn:uuid:4>": ("response", "http://c", 0, None, b"")}
    assert back.where("record_type = 'response' and target_uri = 'http://c'").count() == 1
    assert sorted(r.record_id for r in warc.read(spark, str(tmp_path), payload=False).where("record_type in ('resource', 'warcinfo')").collect()) == ["<urn:uuid:1>", "<urn:uuid:3>"]


def test_warc_records_have_the_mandatory_headers():
    for page in (5, None):
        record = gzip.decompress(warc.encode_record({"record_type": "response", "page_id": page, "target_uri": None, "payload": b"", "payload_digest": "d", "payload_bytes": 0, "refers_to": None}))
        for name in (b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"):
            assert b"\r\n" + name + b": " in record


def test_warc_empty(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    warc.export_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).collect() == []


def planted(n: int = 600) -> tuple[list, list]:
    """Texts of which every fifth holds words on a hidden stem or common insults."""
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        words = brute.prose(rng, 80).split(" ")
        toxic = i % 5 == 0
        if toxic:
            for _ in range(6):
                words[rng.randrange(80)] = rng.choice(["vroq" + rng.choice("abcdef"), "vroqim", "IDIOT,"]) if i % 10 else rng.choice(["moron", "scum", "clown"])
        docs.append((i, " ".join(words), 0.0, 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_texts(spark):
    docs, labels = planted()
    odd = [(10_000, None, 0.0, 1), (10_001, "", 0.0, 1), (None, "moron scum idiot", 0.0, 1), (10_002, "ba né " * 30_000, 0.0, 1), (10_001, "", 0.0, 1)]
    got = toxicity.score_documents(spark.createDataFrame(docs + odd, "doc_id long, text string, score double, votes int"), spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int"), carry=["votes"]).collect()
    assert len(got) == len(docs) + 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.votes == 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    right = [by_id[i].predicted == y for i, _, y in labels if by_id[i].held_out]
    assert len(right) > 80 and np.mean(right) > 0.97
    assert by_id[10_000].predicted == by_id[10_001].predicted == by_id[10_002].predicted == 0 and by_id[10_000].score == by_id[10_001].score


def test_toxicity_never_learns_from_held_out_labels(spark):
    docs, labels = planted(200)
    import zlib

    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double, votes int")
    one, two = ({r.doc_id: r.score for r in toxicity.score_documents(df, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()} for x in (labels, turned))
    assert one == two


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "idiot moron scum"), (2, "fine words"), (3, None)], "doc_id long, text string")
    assert len(toxicity.score_documents(docs, none).collect()) == 3
    assert toxicity.score_documents(docs.where("doc_id < 0"), none).collect() == []


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.2
    hit, false = np.array([0.9, 0.9, 0.7, 0.8]), np.array([0.02, 0.02, 0.05, 0.1])
    v = rng.random((len(y), 4)) < np.where(y[:, None], hit, false)
    v[:, 1] = v[:, 0]  # a voter that repeats another
    known = np.where(rng.random(len(y)) < 0.2, y, 2)  # a fifth has labels
    rows, counts = np.unique((v @ (1 << np.arange(4))) * 4 + known.astype(int), return_counts=True)
    patterns, known = rows // 4, np.where(rows % 4 == 2, np.nan, rows % 4)
    posterior, rates, pairs = toxicity.label_model(patterns, counts.astype(float), known, 4)
    assert np.abs(rates[1] - hit).max() < 0.06 and np.abs(rates[0] - false).max() < 0.03
    assert np.abs(pairs[1, 0, 1] - rates[1, 0]) < 0.01
    of = dict(zip(patterns.tolist(), posterior, strict=True))
    # two equal voters weigh as one: with both others silent they do not settle the label as four would
    assert of[0b0011] < 0.9 and of[0b1111] > 0.99
