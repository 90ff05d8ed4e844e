"""Golden checks against the analysed pipeline's shipped data files (read-only)."""

import os

import pytest
from pyspark.sql import functions as F

from dailywire.operators import daily as D
from dailywire.sources import readers as R
from dailywire.sources.writers import append_sink, write_table
from tests.conftest import REFERENCE_DATA

pytestmark = pytest.mark.skipif(not os.path.isdir(REFERENCE_DATA), reason="reference data files not present")


def test_wordlist_counts(spark):
    words = R.read_wordlist(spark, f"{REFERENCE_DATA}/stopwords.txt")
    assert words.count() == 2099
    assert words.select("word").distinct().count() == 1308
    first = R.wordlist_terms(words, limit=5)
    assert first == ["about", "above", "across", "after", "again"]


def test_daily_means_reproduce_merged_file(spark):
    start = F.lit("2022-11-02").cast("timestamp_ntz")
    idx = R.read_delimited(spark, f"{REFERENCE_DATA}/index_data.csv", R.INDEX_READINGS_SCHEMA)
    idx = idx.select(F.col("Datetime").alias("datetime"), F.regexp_replace("Index Value", ",", "").try_cast("double").alias("Index Value"))
    idx_daily = D.daily_mean(idx.where(F.col("datetime") >= start), "datetime", ["Index Value"])
    wea = R.read_delimited(spark, f"{REFERENCE_DATA}/weather_data.csv", R.WEATHER_READINGS_SCHEMA).withColumnRenamed("time", "datetime")
    wea_daily = D.daily_weather_mean(wea.where(F.col("datetime") >= start), drop=["Humidity in %", "Visibility in km", "UV index"])
    merged = R.read_delimited(spark, f"{REFERENCE_DATA}/preprocessed_and_merged_datasets.csv", R.DAILY_MERGED_SCHEMA)
    got = D.merge_daily_sources(wea_daily, idx_daily).collect()
    want = {r["datetime"]: r for r in merged.collect()}
    assert len(want) == 15
    seen = 0
    for r in got:
        if r["datetime"] in want:
            w = want[r["datetime"]]
            assert abs(r["Index Value"] - w["Index Value"]) < 1e-6
            assert abs(r["Wind in km/h"] - w["Wind in km/h"]) < 1e-9
            assert abs(r["Precipitation in mm"] - w["Precipitation in mm"]) < 1e-9
            seen += 1
    assert seen == 15


def test_merged_ratios_follow_counts(spark):
    merged = R.read_delimited(spark, f"{REFERENCE_DATA}/preprocessed_and_merged_datasets.csv", R.DAILY_MERGED_SCHEMA)
    got = D.daily_ratios(merged.drop("ratio_articles_about_covid", "ratio_negative_articles")).collect()
    want = {r["datetime"]: r for r in merged.collect()}
    for r in got:
        assert abs(r.ratio_negative_articles - want[r["datetime"]].ratio_negative_articles) < 1e-12
        assert abs(r.ratio_articles_about_covid - want[r["datetime"]].ratio_articles_about_covid) < 1e-12


def test_ohlcv_and_daily_weather(spark):
    o = R.read_ohlcv(spark, f"{REFERENCE_DATA}/additionalData_1Month/index.csv")
    agg = o.agg(F.count(F.lit(1)).alias("n"), F.min("Date").alias("lo"), F.max("Date").alias("hi"), F.count(F.when(F.col("Volume") == 0, 1)).alias("z")).first()
    assert (agg.n, str(agg.lo), str(agg.hi), agg.z) == (248, "2021-11-15", "2022-11-14", 2)
    w = R.read_daily_weather(spark, f"{REFERENCE_DATA}/additionalData_1Month/weather.csv")
    assert w.count() == 30
    assert dict(w.dtypes)["stations"] == "array<string>"
    first = w.orderBy("datetime").first()
    assert "VHHH" in first.stations and first.sunrise == "06:20:06"


def test_append_and_write_round_trip(spark, tmp_path):
    idx = R.read_delimited(spark, f"{REFERENCE_DATA}/index_data.csv", R.INDEX_READINGS_SCHEMA)
    path = str(tmp_path / "idx")
    append_sink(idx.where(F.col("Datetime") < F.lit("2022-11-01").cast("timestamp_ntz")), path, fmt="csv")
    append_sink(idx.where(F.col("Datetime") >= F.lit("2022-11-01").cast("timestamp_ntz")), path, fmt="csv")
    back = R.read_delimited(spark, path, R.INDEX_READINGS_SCHEMA)
    assert back.count() == idx.count() == 390
    out = str(tmp_path / "pq")
    write_table(idx, out)
    assert spark.read.parquet(out).exceptAll(idx).count() == 0
