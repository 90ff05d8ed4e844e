"""The corpus pipeline: stages over ``documents``, each written as Parquet and read as the next one's input."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from dailywire.llm import pipeline_stages as stages
from dailywire.session import ensure_checkpoint_dir

#: (name, function of (spark, docs, sf_dir)), in order.
STAGES = [
    ("toxicity", stages.drop_toxic),
    ("near_dedup", stages.near_dedup),
    ("suffix_dedup", stages.suffix_dedup),
    ("mixing", stages.mix_sources),
    ("packing", stages.pack),
]

#: Sketches, suffix sorting and tokenizers have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is a stage table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
