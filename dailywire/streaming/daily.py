"""ST2 over all sources: the merged daily table (A5 over A1, A3, A4) kept current as files arrive.

Each source has a table of day states. A state holds the day's counts and sums and replaces its predecessor:
a batch reads the states of the days it touches, adds its own part and writes only these days. A day
has two slots, and a new state goes to the one that does not hold its predecessor, so a retried batch finds
what it started from, and the table never holds more than two rows of a day.

An article counts with its latest version only (E13): a batch compares its URLs with the versions stored in
their hash buckets, takes back the flags of the version that is replaced from its day and adds the
new ones; a version that arrives after a later one changes nothing.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dailywire.operators.daily import daily_ratios, merge_daily_sources
from dailywire.session import checkpoint

#: Hash buckets of the stored URLs; a batch reads those that its URLs fall into.
BUCKETS = 64
#: A1 counts of an article's flags.
FLAGS = (("covid_flag", "total_articles_about_covid"), ("negative_flag", "total_negative_articles"))


def bucket_of(url: Column | str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def earlier_batches(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Rows committed by earlier batches only (a retried batch must not see its own partial output)."""
    try:
        prior = spark.read.parquet(path)
    except AnalysisException as e:
        # no committed batch yet; any other failure must not look like an empty store
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return prior.where(F.col("_batch") < batch_id)


def in_buckets(prior: DataFrame, batch: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The stored rows of the buckets that the batch's URLs fall into (at most ``buckets`` numbers)."""
    touched = [r[0] for r in batch.select("_bucket").distinct().limit(buckets).collect()]
    return prior.where(F.col("_bucket").isin(touched))


def _write(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def add_to_days(parts: DataFrame, path: str, batch_id: int) -> None:
    """Add ``parts`` (day, sums...) to the day states in ``path``; only these days are written."""
    spark = parts.sparkSession
    sums = [c for c in parts.columns if c != "day"]
    parts = checkpoint(parts.groupBy("day").agg(*[F.sum(c).alias(c) for c in sums]))
    prior = earlier_batches(spark, path, batch_id)
    if prior is None:
        states = parts.withColumn("_slot", F.lit(0))
    else:
        # one row for each day of the batch
        days = [r[0] for r in parts.select(F.col("day").cast("string")).collect()]
        before = prior.where(F.col("_day").isin(days)).groupBy("day").agg(F.max_by(F.struct("_slot", *sums), "_batch").alias("_s"))
        states = parts.join(before, "day", "left").select(
            "day", *[(F.col(c) + F.coalesce(F.col(f"_s.{c}"), F.lit(0))).alias(c) for c in sums], F.coalesce(1 - F.col("_s._slot"), F.lit(0)).alias("_slot"))
    # a day's rows are read before they are overwritten
    states = checkpoint(states.withColumn("_day", F.col("day").cast("string")).withColumn("_batch", F.lit(batch_id)))
    _write(states, path, ["_day", "_slot"])


def day_states(spark: SparkSession, path: str) -> DataFrame:
    """(day, sums...): the latest state of every day."""
    states = spark.read.parquet(path)
    sums = [c for c in states.columns if c not in ("day", "_day", "_slot", "_batch")]
    return states.groupBy("day").agg(F.max_by(F.struct(*sums), "_batch").alias("_s")).select("day", "_s.*")


def article_batch(base: str, features: Callable[[DataFrame], DataFrame], version_col: str = "version"):
    """foreachBatch body for articles. ``features`` turns the batch's pages into (url, date, flags...)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cols = [c for c in batch.columns if c not in ("url", version_col)]
        # the latest version of each URL in the batch, and only those are worked on
        batch = batch.where("url is not null").groupBy("url").agg(F.max_by(F.struct(version_col, *cols), version_col).alias("_r")).select("url", "_r.*")
        batch = checkpoint(batch.withColumn("_bucket", bucket_of("url")))
        versions = os.path.join(base, "versions")
        prior = earlier_batches(spark, versions, batch_id)
        if prior is None:
            former = None
        else:
            kept = ["date", version_col, *[f for f, _ in FLAGS]]
            former = in_buckets(prior, batch).groupBy("url").agg(F.max_by(F.struct(*kept), version_col).alias("_f"))
            batch = batch.join(former, "url", "left").where(f"_f is null or _f.{version_col} < {version_col}")
        named = batch.select("url", version_col, "_bucket", *(["_f"] if former is not None else []))
        new = features(batch.select("url", *cols)).join(named, "url")
        new = checkpoint(new)
        flags = [F.col(f).isNotNull().cast("long").alias(name) for f, name in FLAGS]
        parts = new.select(F.col("date").alias("day"), F.lit(1).cast("long").alias("total_number_of_articles"), *flags)
        if former is not None:
            back = [(-F.col(f"_f.{f}").isNotNull().cast("long")).alias(name) for f, name in FLAGS]
            parts = parts.union(new.where("_f is not null").select(F.col("_f.date"), F.lit(-1).cast("long"), *back))
        add_to_days(parts, os.path.join(base, "news"), batch_id)
        # one file a bucket
        kept_cols = ["url", "date", version_col, *[f for f, _ in FLAGS], "_bucket"]
        _write(new.select(*kept_cols).withColumn("_batch", F.lit(batch_id)).repartition("_bucket"), versions, ["_bucket", "_batch"])

    return run


def reading_batch(base: str, source: str, day: Column, values: dict[str, Column]):
    """foreachBatch body for readings: per day the number and sum of each value."""

    def run(batch: DataFrame, batch_id: int) -> None:
        cols = [x.alias(n) for n, v in values.items() for x in (v.isNotNull().cast("long"), F.coalesce(v.cast("double"), F.lit(0.0)))]
        names = [x for n in values for x in (f"{n}_n", f"{n}_sum")]
        add_to_days(batch.select(day, *cols).toDF("day", *names), os.path.join(base, source), batch_id)

    return run


def merged_daily(spark: SparkSession, base: str, means: dict[str, Sequence[str]]) -> DataFrame:
    """The daily table: A1 / A2 of the articles, the means of each source of readings, outer-merged by day.

    ``means`` names the value columns of each source. A day whose articles were all taken back has no row.
    """
    news = day_states(spark, os.path.join(base, "news")).where("total_number_of_articles > 0").withColumnRenamed("day", "datetime")
    tables = [daily_ratios(news)]
    for source, names in means.items():
        states = day_states(spark, os.path.join(base, source))
        tables.append(states.select(F.col("day").alias("datetime"), *[F.try_divide(F.col(f"{n}_sum"), F.col(f"{n}_n")).alias(n) for n in names]))
    return merge_daily_sources(*tables)


def start(stream: DataFrame, body, checkpoint_dir: str, processing_time: str | None = None) -> StreamingQuery:
    """Run ``body`` on every micro-batch; by default drain what is there and stop."""
    w = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_dir)
    return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()
