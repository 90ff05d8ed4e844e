"""Projection / filter / typing queries (C1-C12) and source round trips."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailywire.functions import text as TX
from dailywire.operators import clean as C
from dailywire.plans.registry import query, rounded
from dailywire.session import ensure_checkpoint_dir
from dailywire.sources.readers import append_records, explode_json_records, table
from dailywire.sources.writers import append_sink, write_table


@query(
    "C1_drop_nulls",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
       WHERE d.doc_id IS NOT NULL AND d.lang IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
)
def c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return C.drop_nulls(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


@query(
    "C2_to_timestamp",
    """SELECT event_id, date_trunc('second', ts) AS parsed,
       (CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') || '+08:00' AS TIMESTAMPTZ) AT TIME ZONE 'UTC') AS parsed_utc,
       CAST(NULL AS TIMESTAMP) AS junk FROM events""",
)
def c2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings rendered as text (with and without an offset, plus junk) parsed back."""
    ev = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("txt"))
    return ev.select(
        "event_id",
        C.to_timestamp("txt", "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        C.to_timestamp(F.concat("txt", F.lit("+08:00")), "yyyy-MM-dd HH:mm:ssXXX", utc=True).alias("parsed_utc"),
        C.to_timestamp(F.concat(F.lit("no date "), "txt"), "yyyy-MM-dd HH:mm:ss").alias("junk"),
    )


@query(
    "C3_calendar_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
       CAST(month(ts) AS INTEGER) AS month, CAST(ts AS DATE) AS date FROM events""",
)
def c3(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return C.calendar_parts(ev, "ts").drop("ts")


@query(
    "C4_parse_grouped_number",
    """SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price_text,
       round(CAST(replace(format('{:,.2f}', o_totalprice), ',', '') AS DOUBLE), 6) AS price FROM orders""",
)
def c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.format_number("o_totalprice", 2).alias("price_text"))
    return rounded(o.withColumn("price", TX.parse_grouped_number("price_text")))


@query(
    "C5_select_rename_drop",
    "SELECT event_id, ts AS datetime, event_type AS condition, round(value, 6) AS value FROM events",
)
def c5(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return rounded(C.select_rename_drop(ev, {"ts": "datetime", "event_type": "condition"}, drop=["props", "user_id"]))


@query("C6_date_range_filter", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def c6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.date_range_filter(table(spark, sf_dir, "events"), "ts", "2024-01-15").select("event_id", "ts")


@query("C7_first_n", "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def c7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return C.first_n(docs, 10, [F.desc("n_chars"), F.asc("doc_id")])


@query("C8_distinct_values", "SELECT DISTINCT lang FROM documents")
def c8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.distinct_values(table(spark, sf_dir, "documents"), "lang")


@query(
    "C9_drop_duplicates_first",
    """SELECT doc_id, lang, source FROM (SELECT doc_id, lang, source,
       row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def c9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return C.drop_duplicates_first(docs, ["lang", "source"], [("n_chars", False), "doc_id"]).drop("n_chars")


@query(
    "C10_conditional_label",
    "SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' ELSE 'positive' END AS type FROM labels",
)
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", TX.conditional_label("toxic").alias("type"))


@query(
    "C11_any_flag_filter",
    "SELECT doc_id, CAST(quality AS BOOLEAN) AS quality, CAST(toxic AS BOOLEAN) AS toxic FROM labels WHERE CAST(quality AS BOOLEAN) OR CAST(toxic AS BOOLEAN)",
)
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.any_flag_filter(table(spark, sf_dir, "labels"), ["quality", "toxic"])


@query(
    "C12_table_profile",
    """SELECT * FROM (VALUES ('doc_id', 'bigint', (SELECT count(doc_id) FROM documents)),
       ('text', 'string', (SELECT count(text) FROM documents)), ('lang', 'string', (SELECT count(lang) FROM documents)),
       ('source', 'string', (SELECT count(source) FROM documents)), ('n_chars', 'bigint', (SELECT count(n_chars) FROM documents)))
       AS t(column_name, type, non_null)""",
)
def c12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table_profile(table(spark, sf_dir, "documents"))


@query(
    "S4_explode_json_records",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def s4(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return explode_json_records(ev, "props", "k BIGINT")


@query(
    "S4_append_records",
    """SELECT event_id, event_type, round(value, 6) AS value, NULL::VARCHAR AS props FROM events WHERE event_id % 3 = 0
       UNION ALL SELECT event_id, event_type, NULL::DOUBLE AS value, props FROM events WHERE event_id % 3 = 1
       UNION ALL SELECT event_id, NULL::VARCHAR, round(value, 6), props FROM events WHERE event_id % 3 = 2 OR event_id IS NULL""",
)
def s4_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts with different columns, together every event, appended by name."""
    ev, part = table(spark, sf_dir, "events"), F.coalesce(F.col("event_id") % 3, F.lit(2))
    a = ev.where(part == 0).select("event_id", "event_type", "value")
    b = ev.where(part == 1).select("event_id", "event_type", "props")
    c = ev.where(part == 2).select("event_id", "value", "props")
    return rounded(append_records([a, b, c])).select("event_id", "event_type", "value", "props")


@query("S4_array_replies", "SELECT CAST(ts AS DATE) AS day, event_id, event_type, round(value, 6) AS value FROM events")
def s4_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that hold an array of records, one reply for each day and hour, exploded; the replies of two spans
    of days are appended."""
    day = F.to_date("ts").alias("day")
    reply = F.to_json(F.struct(F.collect_list(F.struct("event_id", "event_type", "value")).alias("records"))).alias("reply")
    replies = table(spark, sf_dir, "events").groupBy(day, F.hour("ts").alias("hour")).agg(reply).drop("hour")
    early = F.col("day") < F.lit("2024-01-15").cast("date")
    parts = [explode_json_records(r, "reply", "struct<event_id:bigint,event_type:string,value:double>", "records") for r in (replies.where(early), replies.where(~early))]
    return rounded(append_records(parts))


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@query("S7_append_sink", "SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events")
def s7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends (first creates, second adds) into a day-partitioned table, read back."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    path = _scratch(spark, "append")
    cut = F.lit("2024-01-15").cast("date")
    append_sink(ev.where(F.col("day") < cut), path, partition_by=["day"])
    append_sink(ev.where(F.col("day") >= cut), path, partition_by=["day"])
    return spark.read.parquet(path).select("event_id", "event_type", "day")


@query("S8_write_table", "SELECT doc_id, lang, source, n_chars FROM documents")
def s8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a ';' CSV stage table and a Parquet stage table, read back the CSV with its schema."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    csv_path, pq_path = _scratch(spark, "csv"), _scratch(spark, "parquet")
    write_table(docs, csv_path, fmt="csv")
    write_table(docs, pq_path)
    back = spark.read.schema("doc_id BIGINT, lang STRING, source STRING, n_chars BIGINT").option("header", True).option("sep", ";").csv(csv_path)
    return back
