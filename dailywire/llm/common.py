"""Shared Spark helpers of the llm operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailywire.session import checkpoint

#: Text bytes of one chunk of documents (the unit that one Python call holds).
CHUNK_BYTES = 8 << 20


def text_total(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one scan of that column, a sum per task."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def parts(total: int, each: int, least: int = 1) -> int:
    """How many pieces of about ``each`` bytes ``total`` bytes make."""
    return max(least, -(-total // each))


def hash_chunk(n: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def chunked(docs: DataFrame, n: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(chunk, doc_id, text): documents dealt into ``n`` chunks by a hash of the whole row's id and
    text, so that neither a hot source nor a repeated id gathers in one chunk."""
    return docs.select(hash_chunk(n, F.col(doc_id), F.col(text)).alias("chunk"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def running_total(rows: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the rows before it in ``order``.

    Range partitions are summed one by one and shifted by the sums of those before, one row a partition.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = checkpoint(rows.repartitionByRange(width, *order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    shift = x.groupBy("_part").agg(F.sum(value).alias("_sum")).withColumn("_shift", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    # at most one row for each partition
    x = x.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(F.broadcast(shift), "_part")
    return x.withColumn(name, F.col(name) + F.col("_shift")).drop("_part", "_shift")
