"""Source readers (S1, S2, S3, S5, S6) and dictionary preparation (N6) over files that Spark derives
from the driver tables: each query writes the file in the original format into the shared
checkpoint folder, reads it back with the operator, and returns what the operator produced."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailywire.functions import lexicons as L
from dailywire.operators.enrich import prepare_sentiment_dictionary
from dailywire.plans.registry import query, rounded
from dailywire.session import ensure_checkpoint_dir
from dailywire.sources import readers as R

NTZ_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"src-{name}-{uuid.uuid4().hex}")


@query(
    "S1_read_delimited",
    """SELECT ts AS "Datetime", 'Daily Index' AS "Index Name", format('{:,.2f}', value) AS "Index Value"
       FROM events WHERE event_type = 'purchase'""",
)
def s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index readings written as ';' text with blanks in the column names, read back with a declared schema."""
    ev = R.table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    raw = ev.select(F.col("ts").alias("Datetime"), F.lit("Daily Index").alias("Index Name"),
                    F.format_number("value", 2).alias("Index Value"))
    path = _folder(spark, "index")
    raw.write.option("header", True).option("sep", ";").option("timestampNTZFormat", NTZ_TEXT).csv(path)
    return R.read_delimited(spark, path, R.INDEX_READINGS_SCHEMA)


_DICT_ROWS_SQL = """SELECT d.doc_id, upper(d.lang) || '_' || d.source AS "Word", l.toxic AS "Negative", l.quality AS "Positive",
       CASE WHEN d.n_chars > 5000 THEN 2009 ELSE 0 END AS "Uncertainty", 0 AS "Litigious", 0 AS "Constraining", 1 AS "Other"
       FROM documents d JOIN labels l USING (doc_id)"""


def _dictionary_file(spark: SparkSession, sf_dir: str) -> str:
    docs = R.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = R.table(spark, sf_dir, "labels")
    rows = docs.join(lab, "doc_id").select(
        "doc_id",
        F.concat(F.upper("lang"), F.lit("_"), F.col("source")).alias("Word"),
        F.col("toxic").alias("Negative"), F.col("quality").alias("Positive"),
        F.when(F.col("n_chars") > 5000, F.lit(2009)).otherwise(F.lit(0)).alias("Uncertainty"),
        F.lit(0).alias("Litigious"), F.lit(0).alias("Constraining"), F.lit(1).alias("Other"),
    )
    path = _folder(spark, "dictionary")
    # as many files as the range sort makes, in doc_id order: file path and place are the row order
    rows.orderBy("doc_id").drop("doc_id").write.option("header", True).csv(path)
    return path


@query(
    "S2_read_dictionary",
    f"""SELECT CAST("Negative" AS VARCHAR) AS negative, CAST("Positive" AS VARCHAR) AS positive,
       CAST("Uncertainty" AS VARCHAR) AS uncertainty, CAST("Litigious" AS VARCHAR) AS litigious,
       CAST("Constraining" AS VARCHAR) AS constraining, "Word" AS word FROM ({_DICT_ROWS_SQL})""",
)
def s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.read_dictionary(spark, _dictionary_file(spark, sf_dir), list(L.SENTIMENT_CATEGORIES))


@query(
    "N6_prepare_sentiment_dictionary",
    f"""WITH r AS ({_DICT_ROWS_SQL}),
    f AS (SELECT doc_id, lower("Word") AS w, "Negative" <> 0 AS negative, "Positive" <> 0 AS positive, "Uncertainty" <> 0 AS uncertainty,
          "Litigious" <> 0 AS litigious, "Constraining" <> 0 AS constraining FROM r),
    k AS (SELECT * FROM f WHERE negative OR positive OR uncertainty OR litigious OR constraining),
    m AS (SELECT k.*, CASE WHEN ends_with(w, '0') THEN w ELSE coalesce(t.lemma, w) END AS word FROM k
      LEFT JOIN (SELECT DISTINCT lower(lang || '_' || source) AS sw, lower(lang) || '_' || right(lower(source), 1) AS lemma FROM documents) t ON t.sw = k.w),
    o AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY doc_id) AS rn FROM m)
    SELECT negative, positive, uncertainty, litigious, constraining, word FROM o WHERE rn = 1""",
)
def n6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary file -> lower-case, verb lemma from a (word, lemma) table, keep flagged, first per word.

    The lemma table, derived from the data, has the words of all sources whose names do not end in 0.
    """
    raw = R.read_dictionary(spark, _dictionary_file(spark, sf_dir), list(L.SENTIMENT_CATEGORIES))
    word = F.lower(F.concat(F.col("lang"), F.lit("_"), F.col("source")))
    lemma = F.concat(F.lower("lang"), F.lit("_"), F.right(F.lower("source"), F.lit(1)))
    docs = R.table(spark, sf_dir, "documents").where(~F.col("source").endswith("0"))
    lemmas = docs.select(word.alias("word"), lemma.alias("lemma")).where("word is not null").distinct()
    out = prepare_sentiment_dictionary(raw, lemmas, order=R.file_position())
    return out.select(*L.SENTIMENT_CATEGORIES, "word")


@query("S3_read_wordlist", "SELECT DISTINCT source AS word FROM documents UNION ALL SELECT DISTINCT lang AS word FROM documents")
def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word list (sources, then languages) written one per line under '#' comment lines, read back."""
    docs = R.table(spark, sf_dir, "documents")
    words = docs.select(F.col("source").alias("value")).distinct().unionByName(docs.select(F.col("lang").alias("value")).distinct())
    header = spark.createDataFrame([("#",), ("#  word list",), ("#  generated from documents",)], "value string")
    path = _folder(spark, "words")
    header.unionByName(words).write.text(path)
    return R.read_wordlist(spark, path).select("word")


@query(
    "S5_read_ohlcv",
    """SELECT CAST(ts AS DATE) AS "Date", round(arg_min(value, ts), 6) AS "Open", round(max(value), 6) AS "High",
       round(min(value), 6) AS "Low", round(arg_max(value, ts), 6) AS "Close", round(arg_max(value, ts), 6) AS "Adj Close",
       count(*) AS "Volume" FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def s5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV of the index readings written with M/d/yyyy dates, read back with S5."""
    ev = R.table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    daily = ev.groupBy(F.to_date("ts").alias("d")).agg(
        F.min_by("value", "ts").alias("Open"), F.max("value").alias("High"), F.min("value").alias("Low"),
        F.max_by("value", "ts").alias("Close"), F.count(F.lit(1)).alias("Volume"))
    out = daily.select(F.date_format("d", "M/d/yyyy").alias("Date"), "Open", "High", "Low", "Close",
                       F.col("Close").alias("Adj Close"), "Volume")
    path = _folder(spark, "ohlcv")
    out.write.option("header", True).csv(path)
    return rounded(R.read_ohlcv(spark, path))


@query(
    "S6_read_daily_weather",
    """SELECT CAST(ts AS DATE) AS datetime, round(avg(value), 6) AS temp,
       array_to_string(list_sort(list_distinct(list(event_type))), '|') AS preciptype,
       array_to_string(list_sort(list_distinct(list(strftime(ts, '%H')))), '|') AS stations
       FROM events WHERE event_type IN ('view', 'click') GROUP BY 1""",
)
def s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather rows with stringified Python lists ("['a', 'b']") in the 37-column layout, read back."""
    ev = R.table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click"))

    def py_list(c):
        return F.concat(F.lit("['"), F.array_join(F.array_sort(F.collect_set(c)), "', '"), F.lit("']"))

    daily = ev.groupBy(F.to_date("ts").alias("datetime")).agg(
        F.avg("value").alias("temp"), py_list(F.col("event_type")).alias("preciptype"),
        py_list(F.date_format("ts", "HH")).alias("stations"))  # bounded lists: <= 5 types, <= 24 hours
    fields = [f.split()[0].strip("`") for f in R.DAILY_WEATHER_RAW_SCHEMA.split(", ")]
    cols = []
    for name in fields:
        if name in ("datetime", "temp", "preciptype", "stations"):
            cols.append(F.col(name))
        elif name == "_c0":
            cols.append(F.lit(0).alias(""))
        else:
            cols.append(F.lit(None).cast("string").alias(name))
    path = _folder(spark, "weather")
    daily.select(*cols).write.option("header", True).csv(path)
    back = R.read_daily_weather(spark, path)
    return rounded(back.select("datetime", "temp", F.array_join("preciptype", "|").alias("preciptype"),
                               F.array_join("stations", "|").alias("stations")))
