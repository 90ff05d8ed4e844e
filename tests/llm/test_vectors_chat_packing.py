"""Exact and approximate search, chat masks and packing."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dailywire.llm import chat, hnsw, packing, topk

from . import brute

VECTORS = "vec_id long, embedding array<float>, shard int, block string, score double"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 0.3, (400, 16)).astype(np.float32)
    x[100:140] = x[0]
    rows = [(i, [float(c) for c in v], 0, "b", 0.0) for i, v in enumerate(x)]
    odd = [(1000, None, 0, "b", 0.0), (1050, [1.0, None], 0, "b", 0.0), (1100, [float("nan")] * 16, 0, "b", 0.0), (1150, [float("inf")] * 16, 0, "b", 0.0), (1200, [], 0, "b", 0.0), (None, [1.0] * 16, 0, "b", 0.0), (1250, [0.5, 0.5], 0, "b", 0.0), (1251, [0.25, -0.5], 0, "b", 0.0)]
    return x, spark.createDataFrame(rows + odd, VECTORS).repartition(4).cache()


def best(scores: dict[int, float], k: int = 5) -> list:
    return sorted(((-s, i) for i, s in scores.items()))[:k]


@pytest.mark.parametrize("options", [{}, {"shard": 50, "queries": 3, "step": 3}])
def test_exact_top_k(vectors, options):
    x, table = vectors
    ints = np.floor(256 * x.astype(np.float64)).astype(int)
    expected = {(q, r): (i, -s) for q in range(0, 400, 50) for r, (s, i) in enumerate(best({i: int(ints[i] @ ints[q]) for i in range(400) if i != q}), 1)}
    expected[1250, 1] = (1251, 128 * 64 - 128 * 128)
    got = topk.exact_top_k(table, F.col("vec_id") % 50 == 0, **options).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == expected


def test_exact_top_k_of_large_components(spark):
    x = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 3.0]), (2, [-1e30, 0.0]), (3, [1e-3, 1e5])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.exact_top_k(x, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert [i for i, _ in got] == [1, 3, 2] and got[0][1] == 2**63 - 1 and got[2][1] == -(2**63)


def test_search_keeps_ties():
    columns = np.array([[1.0, 1.0, 0.0, 1.0], [0.0, 0.0, 9.0, 0.0]])
    live, score = topk.search(np.array([2.0, 0.0]), columns, columns**2, np.arange(4), 2, 1)
    assert set(live[score == 2]) == {0, 1, 3}


@pytest.mark.parametrize("options", [{}, {"shard": 60, "queries": 3}])
def test_nearest_neighbours(vectors, options):
    x, table = vectors
    v = x.astype(np.float64)
    norm = np.linalg.norm(v, axis=1)
    rows = hnsw.approximate_top_k(table, F.col("vec_id") % 50 == 0, **options).where("query_id < 400").collect()
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    hits = 0
    for q in range(0, 400, 50):
        cosine = v @ v[q] / norm / norm[q]
        ranked = [found[q, r] for r in range(1, 6)]
        assert q not in [i for i, _ in ranked] and ranked == sorted(ranked, key=lambda e: (-e[1], e[0]))
        assert all(abs(s - cosine[i]) < 1e-12 for i, s in ranked)
        hits += len({i for i, _ in ranked} & {i for _, i in best({i: cosine[i] for i in range(400) if i != q})})
    assert hits >= 0.9 * 40


def test_copies_are_found_in_order(vectors):
    _, table = vectors
    got = hnsw.approximate_top_k(table, F.col("vec_id") == 0, shard=60).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [100, 101, 102, 103, 104]


@pytest.mark.parametrize("run", [topk.exact_top_k, hnsw.approximate_top_k])
def test_search_in_an_empty_table(spark, run):
    assert run(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).collect() == []


CONVERSATIONS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <s> [INST] \\n there"), (1, 2, "assistant", "né 😀 [OUT]x</s>"), (1, 3, "user", None), (1, 4, "assistant", "second\\"),
    (2, 0, "assistant", ""), (2, 0, "assistant", "tie b"), (2, 0, "assistant", "tie a"), (2, None, None, "first"),
    (3, 0, "[TEXT]", "[\\TEXT] [TEXT] \\\\ <|endoftext|>"), (4, 0, "assistant", "long " * 3000), (4, 1, "user", "x"), (4, 2, "assistant", "y" * 500),
]


@pytest.mark.parametrize("segment", [chat.SEGMENT, 10])
def test_chat_masks(spark, segment):
    rows = [(c, -1 if t is None else t, r, x) for c, t, r, x in CONVERSATIONS]
    table = spark.createDataFrame([(*r, "extra") for r in CONVERSATIONS], "conv_id long, turn long, role string, text string, segment string").repartition(3)
    made = chat.format_conversations(table, public_tokenizers.path("byte_bpe_50k.json"), segment=segment)
    got = {r.conv_id: tuple(r)[:5] for r in chat.digests(made).collect()}
    assert got == brute.conversation_digests(rows)
    for r in made.collect():
        parts = [r.text[a:b] for a, b in zip(r.loss_start, r.loss_end, strict=True) if a < b]
        assert "".join(parts) == "".join(chat.escape(t) for role, t in chat.parse(r.text) if role == "assistant")
        assert len(r.ids) == len(r.loss_start) == len(r.loss_end)


def test_chat_escape_is_reversible():
    for text in ("", "\\", "\\\\[INST]", "[\\INST]", "<s></s>[/INST]\\<", "[[INST]INST]", "</s>[INST] ok [/INST]"):
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROL)


def test_chat_empty(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(table, public_tokenizers.path("byte_bpe_50k.json"))).collect() == []


@pytest.mark.parametrize("pool", [0, packing.POOL])
def test_packing(spark, pool):
    rows = brute.documents()
    path = public_tokenizers.path("word_bpe_49k.json")
    table = spark.createDataFrame(rows, brute.DOCS).repartition(2)
    pieces = packing.pack_documents(table, path, pool=pool).withColumn("ids_crc32", F.crc32("ids")).collect()
    tokenizer = Tokenizer.from_file(path)
    tokens = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    assert brute.packed_wrong(pieces, tokens) == []
    steps = {}
    for r in pieces:
        assert r.context <= 2048
        steps.setdefault(r.step, set()).add(r.context)
    assert all(len(c) == 1 for c in steps.values())


def test_encoder_equals_the_tokenizer():
    import pyarrow as pa

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["It's <|endoftext|> ok", "a\n\nb  c\t d e f", "Éa é ́x ΑΣ Σ", "", None, " lead", "x" * 300, "<|startoftext|>a b<|endoftext|>", "a\r\nb\x1cc\x85d", "don't we'll 12 345!!"]
    ids, cuts = packing.Encoder(path, 1).encode(pa.array(texts))
    tokenizer = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        assert ids[cuts[i] : cuts[i + 1]].tolist() == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], t


def test_packing_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], brute.DOCS), public_tokenizers.path("word_bpe_49k.json")).collect() == []
