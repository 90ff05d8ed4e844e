"""Structured Streaming forms of the hourly collection loop (ST1) and of the daily aggregates (ST2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dailywire.operators import extract as E
from dailywire.streaming.daily import bucket_of, earlier_batches, in_buckets

PAGES_SCHEMA = "page_id BIGINT, url STRING, html STRING"
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def ingest_batch(store: str):
    """foreachBatch body of ST1: drop the pages whose URL is stored, then parse and extract the others.

    The store lies in hash buckets of the URL: a batch reads the URLs of its own buckets only, and a page
    that is already stored is dropped on its raw row, before the parse. The batch goes into its own
    ``_batch=<id>`` folder of each bucket with overwrite, so a retried batch is idempotent.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pages = batch.withColumn("_bucket", bucket_of("url"))
        prior = earlier_batches(spark, store, batch_id)
        if prior is not None:
            pages = E.new_links(pages, in_buckets(prior, pages).select("url"), "url")
        arts = E.extract_articles(E.parse_pages(pages))
        # one row per URL within the batch
        arts = E.assemble_articles(arts, "url", "page_id").withColumn("_bucket", bucket_of("url")).withColumn("_batch", F.lit(batch_id))
        # one file a bucket
        arts.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_batch").parquet(store)

    return run


def incremental_ingest(spark: SparkSession, source_dir: str, store: str, checkpoint: str,
                       files_per_trigger: int = 1, processing_time: str | None = None) -> StreamingQuery:
    """ST1: new page files -> articles appended to the store, each URL once.

    ``processing_time="1 hour"`` replaces the reference's sleep-until-next-hour loop; by default
    the query drains what is available now and stops.
    """
    stream = spark.readStream.schema(PAGES_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    w = stream.writeStream.foreachBatch(ingest_batch(store)).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def dedupe_within_watermark(spark: SparkSession, source_dir: str, sink: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """ST1, bounded-state variant: drop repeated URLs seen within the watermark delay (append to Parquet)."""
    stream = spark.readStream.schema(PAGES_SCHEMA).parquet(source_dir).withColumn("arrival", F.current_timestamp())
    deduped = stream.withWatermark("arrival", delay).dropDuplicatesWithinWatermark(["url"])
    return (deduped.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def add_daily(table_path: str):
    """foreachBatch body of ST2: the batch's own counts and sums, in its own ``_batch=<id>`` partition
    (a retried batch overwrites it)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(F.to_date("ts").alias("datetime"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"))
        (part.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_batch").parquet(table_path))

    return run


def daily_totals(spark: SparkSession, table_path: str) -> DataFrame:
    """The daily table of ST2: the batches' counts and sums added up."""
    return spark.read.parquet(table_path).groupBy("datetime", "event_type").agg(F.sum("n").alias("n"), F.sum("value_sum").alias("value_sum"))


def streaming_daily_aggregate(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str,
                              files_per_trigger: int = 1) -> StreamingQuery:
    """ST2: per day and type, count and sum of the readings (mean = sum / n), kept current as files arrive.

    Each micro-batch adds its partial sums (one row per day and type it holds), and ``daily_totals``
    adds these up, so a reading counts however late it arrives and no state is kept.
    """
    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    return (stream.writeStream.foreachBatch(add_daily(table_path)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
