"""Stages of the corpus pipeline: each calls one operator and lets its decisions take effect.

A stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``. Rows with a
null doc_id or text pass the stages up to the mix. The mix chooses among the rows that have a word, so null
and blank texts end there; a row with a null doc_id is chosen by its content, each of its copies for
itself. Rows with one doc_id and equal columns are one document. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import minhash, packing, queries, suffix, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Tokens that the mix keeps, each document at most once.
KEPT = "total * 4 div 5"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under 0.5 stay."""
    scored = toxicity.score_documents(docs, queries.table(spark, sf_dir, "labels"), carry=COLUMNS[1:])
    return scored.where("predicted = 0").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates by five words and 0.8: the smallest doc_id of each group stays, once."""
    docs = docs.select(COLUMNS)
    kept = minhash.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id")
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    once = named.withColumn("hash", F.xxhash64("text")).dropDuplicates(["doc_id", "hash"]).select(COLUMNS)
    return once.union(docs.where("doc_id is null"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that start earlier; a text may become empty."""
    cut = suffix.remove_repeats(docs, carry=["lang", "source"])
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the registered weights choose, whole; those without a word are not chosen."""
    docs = docs.select(*COLUMNS, F.concat_ws(":", F.xxhash64("text").cast("string"), F.xxhash64(F.lit(1), *COLUMNS[1:]).cast("string")).alias("row"))
    chosen = queries.mix(docs, epochs=1, part=KEPT, row=F.col("row"))
    chosen = chosen.groupBy(F.col("doc_id").alias("chosen"), F.col("row").alias("chosen_row")).agg(F.count("*").cast("int").alias("times"))
    # copies without an id are told apart by their number only
    docs = docs.where("doc_id is not null").union(docs.where("doc_id is null").distinct())
    whole = docs.join(chosen, (docs["row"] == chosen["chosen_row"]) & docs["doc_id"].eqNullSafe(chosen["chosen"]))
    times = F.when(F.col("doc_id").isNull(), F.col("times")).otherwise(1)
    return whole.select(*COLUMNS, F.explode(F.sequence(F.lit(1), times)).alias("time")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their ids."""
    return packing.pack_documents(docs, queries.tokenizer_path("word_bpe_49k.json"))
