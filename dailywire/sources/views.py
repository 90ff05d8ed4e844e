"""Driver tables seen as the pipeline's inputs.

* documents -> news articles: ``doc_id`` is the URL key, ``source`` the news site and the
  publish day is ``2024-01-01 + doc_id % 30`` (lines up with ``events.ts``).
* events -> index readings (``purchase``) and weather readings (``view`` = wind, ``click`` =
  precipitation, ``props.k`` = humidity).
* orders -> daily series: ``series_id = o_orderpriority``, ``ds = day``, ``y = sum(o_totalprice)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEWS_EPOCH = "2024-01-01"
NEWS_DAYS = 30


def news_from_documents(docs: DataFrame) -> DataFrame:
    """(url, datetime, date, text, newssite) from ``documents``; only the needed columns are read."""
    day = F.date_add(F.lit(NEWS_EPOCH).cast("date"), (F.col("doc_id") % NEWS_DAYS).cast("int"))
    return docs.select(
        F.col("doc_id").alias("url"),
        day.cast("timestamp").alias("datetime"),
        day.alias("date"),
        F.col("text"),
        F.col("source").alias("newssite"),
    )


def index_readings(events: DataFrame, event_type: str = "purchase") -> DataFrame:
    """(datetime, index_name, index_value); the type filter pushes into the parquet scan."""
    return events.where(F.col("event_type") == event_type).select(
        F.col("ts").alias("datetime"), F.col("event_type").alias("index_name"), F.col("value").alias("index_value")
    )


def weather_readings(events: DataFrame, wind_type: str = "view", precip_type: str = "click") -> DataFrame:
    """(datetime, condition, wind_kmh, humidity_pct, precipitation_mm) from two event types."""
    et = F.col("event_type")
    return events.where(et.isin(wind_type, precip_type)).select(
        F.col("ts").alias("datetime"),
        et.alias("condition"),
        F.when(et == wind_type, F.col("value")).alias("wind_kmh"),
        F.get_json_object("props", "$.k").cast("double").alias("humidity_pct"),
        F.when(et == precip_type, F.col("value")).alias("precipitation_mm"),
    )


def daily_order_series(orders: DataFrame) -> DataFrame:
    """(series_id, ds, y): one row per priority and day; pre-aggregated before any per-series work."""
    return orders.groupBy(
        F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("ds")
    ).agg(F.sum("o_totalprice").alias("y"))


def daily_lineitem_regressor(lineitem: DataFrame) -> DataFrame:
    """(ds, x): daily shipped quantity, a regressor for the order series."""
    return lineitem.groupBy(F.to_date("l_shipdate").alias("ds")).agg(F.sum("l_quantity").alias("x"))
