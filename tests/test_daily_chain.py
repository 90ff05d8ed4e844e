"""The flagship's text chain with a tag table: T3 runs between T2 and T4."""

import datetime

from dailywire.functions import lexicons as L
from dailywire.plans.daily_plans import article_features


def test_article_features_with_tags(spark):
    day = datetime.date(2024, 1, 2)
    news = spark.createDataFrame(
        [(1, day, "many losses were reported"), (2, day, "nothing happened here today"), (3, day, "under covid rules again")],
        "url long, date date, text string")
    tags = spark.createDataFrame(
        [("losses", "NNS", "NOUN", "loss", None), ("covid", "IN", "ADP", "covid", None), ("reported", "VBD", "VERB", "reporte", None)],
        "word string, tag string, pos string, lemma string, plural string")
    options = dict(key_terms=("covid",), negative_terms=("reporte",), polarity={"nothing": -1.0}, stopwords=L.STOPWORDS_FIRST_100)

    def flags(**more):
        return {(r.url, r.date, r.covid_flag, r.negative_flag) for r in article_features(news, **options, **more).collect()}

    assert flags() == {(1, day, None, None), (2, day, None, 1), (3, day, 1, None)}
    # the verb becomes its lemma, the adposition is dropped
    assert flags(tags=tags) == {(1, day, None, 1), (2, day, None, 1), (3, day, None, None)}
