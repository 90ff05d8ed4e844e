"""The stages on a small table, the pipeline as a whole, and the registered queries."""

import ast
import pathlib
import random

import pytest

import corpus_pipeline
from dailywire.llm import pipeline_stages, queries

from . import brute

ROOT = pathlib.Path(__file__).resolve().parents[2]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rng = random.Random(1)
    toxic = [(500 + i, f"{brute.prose(rng, 20)} moron {brute.prose(rng, 5)} scum idiot", "en", "src1", 0) for i in range(30)]
    docs = [r[:5] for r in brute.documents()] + toxic + [(None, "no id at all", None, None, None)]
    labels = [(i, 1, int(i >= 500)) for i in range(600)]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), docs


def test_near_dedup_stage_keeps_one_of_each_group(spark, tables):
    folder, docs = tables
    named = [(r[0], r[1]) for r in docs if r[0] is not None]
    expected = {i for i, r in brute.near_duplicates(named, 5).items() if r[3]} | {None}
    twice = spark.createDataFrame(docs + docs[:3], COLUMNS)
    got = pipeline_stages.near_dedup(spark, twice, folder).collect()
    assert {r.doc_id for r in got} == expected and len(got) == len(expected)


def test_suffix_stage_cuts_the_text(spark, tables):
    folder, docs = tables
    expected = brute.repeated_bytes([(r[0], r[1]) for r in docs if r[0] is not None])
    got = pipeline_stages.suffix_dedup(spark, spark.createDataFrame(docs, COLUMNS), folder).collect()
    assert {r.doc_id: r.text for r in got if r.doc_id == 3} and len(got) == len(docs)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.doc_id is not None and expected[r.doc_id][2] == 0:
            assert r.text == ({d[0]: d[1] for d in docs}[r.doc_id] or "")


def test_mixing_stage_keeps_whole_documents(spark, tables):
    folder, docs = tables
    got = pipeline_stages.mix_sources(spark, spark.createDataFrame(docs, COLUMNS), folder).collect()
    of = {d[0]: d[1] for d in docs}
    assert 0 < len(got) < len(docs) and all(r.text == of[r.doc_id] for r in got)


def test_mixing_stage_takes_rows_without_an_id_one_by_one(spark, tables):
    """150 rows of one leaf have no id, 50 of them are equal: four fifths of the tokens, to the row."""
    rows = [(None, f"w{i} a b c", "en", "src0", 0) for i in range(100)] + [(None, "the same four words", "en", "src0", 0)] * 50
    rows += [(None, None, "en", "src0", 0), (7, " ", "en", "src0", 0)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = [tuple(r) for r in pipeline_stages.mix_sources(spark, docs, tables[0]).collect()]
    assert len(got) == 120 and set(got) <= set(rows)
    assert all(got.count(r) <= rows.count(r) for r in got) and (None, None, "en", "src0", 0) not in got


def test_pipeline(spark, tables):
    folder, docs = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "mixing", "packing"]
    got = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in got}
    assert not [i for i in ids if i is not None and i >= 500] and 30 not in ids and ids <= {d[0] for d in docs}
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        size = sum(r.length for r in pieces)
        assert size & (size - 1) == 0 and size <= 2048 and sorted(r.offset for r in pieces)[0] == 0


def test_pipeline_on_an_empty_table(spark, tables):
    folder, _ = tables
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == pipeline_stages.COLUMNS and docs.collect() == []


def test_thirteen_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "dailywire").rglob("*.py"):
        if "llm" in path.relative_to(ROOT / "dailywire").parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path
