"""End-to-end use of the library on the driver tables (a user's view, not a registered query).

    python examples/daily_report.py [/root/testdata/sf0.01]

1. extract articles from raw pages (E1-E13);
2. clean and enrich documents: T1 -> T2 -> T3 (lexicon) -> T4, then N2/N3/N5/N9 in one pass;
3. the daily table: article counts and ratios merged with index / weather readings (A1-A5);
4. a forecast of the daily order series with its test score (A9, F1, A6, A15).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from dailywire.operators import daily as D  # noqa: E402
from dailywire.operators import enrich as N  # noqa: E402
from dailywire.operators import extract as E  # noqa: E402
from dailywire.operators import forecast as FC  # noqa: E402
from dailywire.operators import series as X  # noqa: E402
from dailywire.operators import text as TO  # noqa: E402
from dailywire.plans import text_plans as P  # noqa: E402
from dailywire.plans.driver_words import STOPWORDS  # noqa: E402
from dailywire.session import get_spark  # noqa: E402
from dailywire.sources.readers import table, text_table  # noqa: E402
from dailywire.sources.views import daily_order_series, index_readings, news_from_documents, weather_readings  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]")

    articles = E.assemble_articles(E.extract_articles(E.parse_pages(text_table(spark, sf, "pages", ["page_id", "url", "html"]))))
    print("articles:", articles.count(), "without body:", articles.where(F.col("error").isNotNull()).count())

    lexicon = spark.createDataFrame(P.DRIVER_TAG_LEXICON, "word string, tag string, pos string, lemma string, plural string")
    docs = text_table(spark, sf, "documents", ["doc_id", "text"])
    processed = TO.preprocess(docs, "doc_id", "text", STOPWORDS, lexicon).select("doc_id", "processed_text")
    scores = N.score_documents(
        processed, "doc_id", "processed_text",
        polarity=spark.createDataFrame(list(P.DRIVER_POLARITY.items()), "word string, score double"),
        valence=spark.createDataFrame(list(P.DRIVER_VALENCE.items()), "word string, score double"),
        gazetteer=spark.createDataFrame(P.DRIVER_GAZETTEER, "term string, label string"),
        negative_terms=("orre", "inoran", "hehely"),
    )
    news = news_from_documents(table(spark, sf, "documents")).join(scores, F.col("url") == F.col("doc_id"))
    counts = D.daily_ratios(D.daily_article_counts(news.withColumn("covid_flag", F.lit(None).cast("int"))))
    events = table(spark, sf, "events")
    daily = D.merge_daily_sources(counts, D.daily_weather_mean(weather_readings(events)), D.daily_index_mean(index_readings(events)))
    daily.show(5)

    split = X.ordered_split(daily_order_series(table(spark, sf, "orders")), 0.75)
    fc = FC.forecast_trend_seasonal(split, periods=16).select("series_id", "ds", "yhat")
    test = split.where(F.col("set") == "test").select("series_id", "ds", "y")
    X.mae(X.join_actual_forecast(test, fc)).orderBy("series_id").show()


if __name__ == "__main__":
    main()
