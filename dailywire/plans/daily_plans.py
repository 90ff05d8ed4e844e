"""Daily table plans: the flagship query (text features + readings merged per day) and A1-A5, A11, A12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailywire.functions import text as TX
from dailywire.operators import daily as D
from dailywire.operators.enrich import score_documents
from dailywire.operators.text import preprocess
from dailywire.plans import sqltext as S
from dailywire.plans.driver_words import STOPWORDS
from dailywire.plans.registry import query, rounded
from dailywire.plans.text_chain import PROCESSED_CTES
from dailywire.plans.text_chain import tags as driver_tags
from dailywire.sources.readers import table, text_table
from dailywire.sources.views import index_readings, news_from_documents, weather_readings

# Parameters of the registered runs on the driver tables: the synthetic prose has no
# covid words, so key terms / negative terms / polarity words are ones that occur in it.
DRIVER_KEY_TERMS = ("thth", "rewh", "thon")
DRIVER_NEGATIVE_TERMS = ("orre", "inoran", "hehely")
DRIVER_POLARITY = {"the": 0.1, "of": -0.05, "rewh": -0.4, "thatin": 0.3, "le": 0.2, "der": -0.1, "que": 0.05, "ononst": -0.3}
START_DATE = "2024-01-02"


def article_features(news: DataFrame, key_terms=DRIVER_KEY_TERMS, negative_terms=DRIVER_NEGATIVE_TERMS,
                     polarity=DRIVER_POLARITY, stopwords=STOPWORDS, tags: DataFrame | None = None) -> DataFrame:
    """T1 -> T2 -> T3 -> T4 -> N1, N2, N3: the cleaned text is exploded once and joined to the polarity table
    (of any size); one small row per article leaves its task. ``tags`` is T3's (word, tag, pos, lemma, plural)
    table, by default that of the registered runs."""
    with_text = preprocess(news, "url", "text", stopwords, driver_tags(news.sparkSession) if tags is None else tags)
    lexicon = news.sparkSession.createDataFrame(list(polarity.items()), "word string, score double") if isinstance(polarity, dict) else polarity
    scored = score_documents(with_text, "url", "processed_text", polarity=lexicon, negative_terms=negative_terms,
                             carry={"date": F.col("date"), "covid_flag": TX.keyterm_flag("processed_text", key_terms)})
    return scored.select("url", "date", "covid_flag", "negative_flag")


def daily_table(spark: SparkSession, sf_dir: str, start: str = START_DATE) -> DataFrame:
    docs = text_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    news = news_from_documents(docs).where(F.col("date") >= F.lit(start).cast("date"))
    counts = D.daily_ratios(D.daily_article_counts(article_features(news)))
    events = table(spark, sf_dir, "events").where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    index = D.daily_index_mean(index_readings(events))
    weather = D.daily_weather_mean(weather_readings(events))
    return rounded(D.merge_daily_sources(counts, weather, index))


def _features_sql(start: str | None = START_DATE) -> str:
    where = f"WHERE {S.news_day()} >= DATE '{start}'" if start else ""
    p = "p"
    return f"""
{PROCESSED_CTES},
news AS (SELECT doc_id AS url, {S.news_day()} AS date, p FROM p {where}),
flags AS (SELECT url, date, {S.keyterm_flag(p, DRIVER_KEY_TERMS)} AS covid_flag,
          {S.negative_flag(p, DRIVER_POLARITY, DRIVER_NEGATIVE_TERMS)} AS negative_flag FROM news),
counts AS (SELECT date AS datetime, count(url) AS total_number_of_articles, count(covid_flag) AS total_articles_about_covid,
           count(negative_flag) AS total_negative_articles FROM flags GROUP BY 1)"""


def _daily_sql(start: str | None = START_DATE) -> str:
    ts = f"ts >= TIMESTAMP '{start}'" if start else "true"
    return f"""WITH {_features_sql(start)},
c2 AS (SELECT *, round(total_articles_about_covid::DOUBLE / total_number_of_articles, 6) AS ratio_articles_about_covid,
       round(total_negative_articles::DOUBLE / total_number_of_articles, 6) AS ratio_negative_articles FROM counts),
wea AS (SELECT CAST(ts AS DATE) AS datetime, round(avg(CASE WHEN event_type = 'view' THEN value END), 6) AS wind_kmh,
        round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS precipitation_mm
        FROM events WHERE event_type IN ('view', 'click') AND {ts} GROUP BY 1),
idx AS (SELECT CAST(ts AS DATE) AS datetime, round(avg(value), 6) AS index_value FROM events WHERE event_type = 'purchase' AND {ts} GROUP BY 1)
SELECT * FROM c2 FULL OUTER JOIN wea USING (datetime) FULL OUTER JOIN idx USING (datetime) ORDER BY datetime"""


def all_days_sql() -> str:
    """A5 over A1 / A2, A4 and A3 of all rows."""
    return _daily_sql(None)


query("daily_news_readings", _daily_sql())(daily_table)


@query("A1_daily_article_counts", f"WITH {_features_sql(None)} SELECT * FROM counts")
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = news_from_documents(text_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))
    return D.daily_article_counts(article_features(news))


@query(
    "A2_daily_ratios",
    f"""WITH {_features_sql(None)} SELECT datetime,
    round(total_articles_about_covid::DOUBLE / total_number_of_articles, 6) AS ratio_articles_about_covid,
    round(total_negative_articles::DOUBLE / total_number_of_articles, 6) AS ratio_negative_articles FROM counts""",
)
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = news_from_documents(text_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))
    r = D.daily_ratios(D.daily_article_counts(article_features(news)))
    return rounded(r.select("datetime", "ratio_articles_about_covid", "ratio_negative_articles"))


@query(
    "A3_daily_index_mean",
    "SELECT CAST(ts AS DATE) AS datetime, round(avg(value), 6) AS index_value FROM events WHERE event_type = 'purchase' GROUP BY 1",
)
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.daily_index_mean(index_readings(table(spark, sf_dir, "events"))))


@query(
    "A4_daily_weather_mean",
    """SELECT CAST(ts AS DATE) AS datetime, round(avg(CASE WHEN event_type = 'view' THEN value END), 6) AS wind_kmh,
       round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS precipitation_mm
       FROM events WHERE event_type IN ('view', 'click') GROUP BY 1""",
)
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.daily_weather_mean(weather_readings(table(spark, sf_dir, "events"))))


@query(
    "A5_merge_daily_sources",
    """WITH a AS (SELECT CAST(ts AS DATE) AS datetime, count(*) AS n_signup FROM events WHERE event_type = 'signup' GROUP BY 1),
    b AS (SELECT CAST(ts AS DATE) AS datetime, round(avg(value), 6) AS index_value FROM events WHERE event_type = 'purchase' GROUP BY 1),
    c AS (SELECT (DATE '2024-01-01' + CAST(doc_id % 45 AS INTEGER)) AS datetime, count(doc_id) AS total_number_of_articles FROM documents GROUP BY 1)
    SELECT * FROM a FULL OUTER JOIN b USING (datetime) FULL OUTER JOIN c USING (datetime) ORDER BY datetime""",
)
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three day-keyed tables with different day coverage (sign-ups, index, news over 45 days), full
    outer merged."""
    ev = table(spark, sf_dir, "events")
    a = ev.where(F.col("event_type") == "signup").groupBy(F.to_date("ts").alias("datetime")).agg(
        F.count(F.lit(1)).alias("n_signup"))
    b = D.daily_index_mean(index_readings(ev))
    docs = table(spark, sf_dir, "documents")
    c = docs.groupBy(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 45).cast("int")).alias("datetime")).agg(
        F.count("doc_id").alias("total_number_of_articles"))
    return rounded(D.merge_daily_sources(a, b, c))


@query(
    "A11_rescale_to_range",
    """WITH d AS (SELECT CAST(ts AS DATE) AS datetime, avg(CASE WHEN event_type = 'purchase' THEN value END) AS index_value,
                         avg(CASE WHEN event_type = 'view' THEN value END) AS wind_kmh FROM events GROUP BY 1),
    s AS (SELECT min(wind_kmh) cmin, max(wind_kmh) cmax, min(index_value) tmin, max(index_value) tmax FROM d)
    SELECT datetime, round(index_value, 6) AS index_value, round(wind_kmh, 6) AS wind_kmh,
      round(CASE WHEN cmax - cmin = 0 THEN (tmin + tmax) / 2 ELSE (wind_kmh - cmin) / (cmax - cmin) * (tmax - tmin) + tmin END, 6) AS scaled
    FROM d, s""",
)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    d = ev.groupBy(F.to_date("ts").alias("datetime")).agg(
        F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("index_value"),
        F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("wind_kmh"),
    )
    return rounded(D.rescale_to_range(d, "wind_kmh", "index_value"))


@query(
    "A12_select_variable_series",
    """WITH d AS (SELECT CAST(ts AS DATE) AS datetime, avg(CASE WHEN event_type = 'purchase' THEN value END) AS index_value,
                  count(*)::DOUBLE AS n_events FROM events GROUP BY 1)
    SELECT datetime, variable, round(value, 6) AS value FROM (
      SELECT datetime, 'index_value' AS variable, index_value AS value FROM d
      UNION ALL SELECT datetime, 'n_events' AS variable, n_events AS value FROM d)""",
)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    d = ev.groupBy(F.to_date("ts").alias("datetime")).agg(
        F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("index_value"),
        F.count(F.lit(1)).alias("n_events"),
    )
    return rounded(D.select_variable_series(d, "datetime", ["index_value", "n_events"]))
