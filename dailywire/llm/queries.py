"""The registered query of each operator, over whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailywire.session import ensure_checkpoint_dir

from . import audit, audit_sql, chat, hnsw, join_sql, manifest, manifest_sql, minhash, mixing, mixing_sql, packing, prefix_join, substring, suffix, topk, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A file of the public tokenizers installed beside the library."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Both sides say the template's own control strings.
CONTROL_CONVERSATION = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@registered("op1_chat_formatting")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.union(spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.format_conversations(turns, tokenizer_path("byte_bpe_50k.json")))


@registered("op2_exact_top_k")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


#: Weights of the registered mix, by path; what is not listed has weight 1.
WEIGHTS = [("domain", "domain0", 4), ("domain", "domain1", 3), ("domain", "domain2", 2), ("lang", "domain0/en", 3), ("lang", "domain1/en", 2), ("lang", "domain1/de", 2), ("source", "domain0/en/src0", 2)]
EPOCHS = 2


def mix(docs: DataFrame, epochs: int = EPOCHS, part: str = "total div 2", row: Column | None = None) -> DataFrame:
    rows = ", ".join(f"('{level}', '{path}', {weight}L)" for level, path, weight in WEIGHTS)
    weights = docs.sparkSession.sql(f"select * from values {rows} as w(level, path, weight)")
    return mixing.mixed(docs, mixing.domain_of(F.col("source")), F.expr(part), weights, epochs, row=row)


@registered("op3_source_mixing", mixing_sql.mix(WEIGHTS, EPOCHS, "total // 2"))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@registered("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@registered("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("text")


@registered(
    "op6_warc",
    """
with x as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select payload_digest, min(page_id) as first from x where payload_bytes >= 100 group by payload_digest
)
select x.page_id, x.payload_bytes, x.payload_digest,
  case when x.page_id > f.first then 'revisit' else 'response' end as record_type,
  case when x.page_id > f.first then f.first end as refers_to
from x left join f on x.payload_digest = f.payload_digest and x.payload_bytes >= 100
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = os.path.join(ensure_checkpoint_dir(spark), f"warc-{uuid.uuid4().hex}")
    warc.export_pages(table(spark, sf_dir, "pages"), path)
    # responses are measured anew on the payload read back, revisits by their headers
    back = warc.read(spark, path)
    whole = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


@registered("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@registered("op8_minhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@registered("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.approximate_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@registered("op11_filter_audit", audit_sql.AUDIT)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered("op12_ngram_jaccard_join", join_sql.similar_documents(5, 80))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.similar_documents(table(spark, sf_dir, "documents"))


@registered("op13_merkle_manifest", manifest_sql.MANIFEST)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = manifest.proofs(table(spark, sf_dir, "documents"), F.when(third, F.translate("text", letters, letters.lower())))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
