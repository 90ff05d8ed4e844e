import os

from pyspark.sql import functions as F

from dailywire.streaming import daily as SD
from dailywire.streaming import ingest as ST
from tests.conftest import SF_SMALL


def test_ingest_no_repeats_and_idempotent_retry(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    src = str(tmp_path / "src")
    pages.coalesce(1).write.parquet(os.path.join(src, "a=1"))
    pages.coalesce(1).write.parquet(os.path.join(src, "a=2"))
    store, ck = str(tmp_path / "store"), str(tmp_path / "ck")
    ST.incremental_ingest(spark, src + "/*", store, ck).awaitTermination()
    out = spark.read.parquet(store)
    assert out.count() == out.select("url").distinct().count() == pages.select("url").distinct().count()
    # replaying batch 0 rewrites only its own partition with the same rows
    before = out.where("_batch = 0").count()
    ST.ingest_batch(store)(pages, 0)
    assert spark.read.parquet(store).where("_batch = 0").count() == before


def test_streaming_daily_equals_batch(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = str(tmp_path / "src")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    ev.where(F.col("ts") < cut).coalesce(1).write.parquet(os.path.join(src, "p=1"))
    ev.where(F.col("ts") >= cut).coalesce(1).write.parquet(os.path.join(src, "p=2"))
    tbl, ck = str(tmp_path / "daily"), str(tmp_path / "ck")
    ST.streaming_daily_aggregate(spark, src + "/*", tbl, ck).awaitTermination()
    got = {(str(r.datetime), r.event_type): (r.n, round(r.value_sum, 6)) for r in spark.read.parquet(tbl).collect()}
    want = {(str(r.d), r.event_type): (r.n, round(r.s, 6)) for r in
            ev.groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")).collect()}
    assert got == want


def test_dedupe_within_watermark(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html")
    src = str(tmp_path / "src")
    pages.union(pages).coalesce(1).write.parquet(src)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    ST.dedupe_within_watermark(spark, src, sink, ck).awaitTermination()
    assert spark.read.parquet(sink).count() == pages.select("url").distinct().count()


def test_streaming_daily_counts_late_rows(spark, tmp_path):
    import datetime as dt

    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    batches = [
        [(1, dt.datetime(2024, 1, 10, 12), 1, "view", 1.0, "{}")],
        [(2, dt.datetime(2024, 1, 10, 13), 1, "view", 2.0, "{}")],
        [(3, dt.datetime(2024, 1, 1, 12), 1, "view", 5.0, "{}")],  # nine days late
    ]
    src = str(tmp_path / "src")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"p={i}"))
    tbl, ck = str(tmp_path / "daily"), str(tmp_path / "ck")
    ST.streaming_daily_aggregate(spark, src + "/*", tbl, ck).awaitTermination()
    got = {str(r.datetime): (r.n, r.value_sum) for r in ST.daily_totals(spark, tbl).collect()}
    assert got == {"2024-01-10": (2, 3.0), "2024-01-01": (1, 5.0)}
    # a retried batch replaces its own part
    again = spark.createDataFrame(batches[2], schema)
    ST.add_daily(tbl)(again, 2)
    assert {str(r.datetime): r.n for r in ST.daily_totals(spark, tbl).collect()} == {"2024-01-10": 2, "2024-01-01": 1}


def test_a_store_that_cannot_be_read_is_not_an_empty_store(spark, tmp_path):
    import pytest

    store = tmp_path / "store"
    assert SD.earlier_batches(spark, str(store), 1) is None
    store.mkdir()
    (store / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):  # noqa: B017
        SD.earlier_batches(spark, str(store), 1)


def test_a_stored_page_is_not_parsed_again(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"u{i}", f"<h1>T{i}</h1><p>b</p>") for i in range(40)], ST.PAGES_SCHEMA)
    store, parsed, inner = str(tmp_path / "store"), [], ST.E.parse_pages
    monkeypatch.setattr(ST.E, "parse_pages", lambda x: parsed.append(sorted(r.url for r in x.select("url").collect())) or inner(x))
    run = ST.ingest_batch(store)
    run(pages.where("page_id < 25"), 0)
    run(pages, 1)
    run(pages, 1)  # a retry sees what the first try saw
    run(pages, 2)
    late = sorted(f"u{i}" for i in range(25, 40))
    assert parsed[1:] == [late, late, []]
    assert sorted(r.url for r in spark.read.parquet(store).select("url").collect()) == sorted(f"u{i}" for i in range(40))


def test_a_later_version_takes_back_the_flags_of_the_former(spark, tmp_path):
    import datetime as dt

    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    schema = "url long, version int, date date, covid_flag int, negative_flag int"
    base = str(tmp_path / "daily")
    run = SD.article_batch(base, lambda x: x)

    def table(path):
        return {str(r.day): tuple(r)[1:] for r in SD.day_states(spark, f"{path}/news").collect()}

    run(spark.createDataFrame([(1, 1, one, 1, None), (2, 5, one, 1, 1), (3, 1, two, None, 1)], schema), 0)
    assert table(base) == {"2024-01-01": (2, 2, 1), "2024-01-02": (1, 0, 1)}
    second = spark.createDataFrame([(1, 2, two, None, 1), (2, 4, two, 1, 1), (4, 1, two, 1, None), (4, 2, two, None, None), (None, 9, two, 1, 1)], schema)
    expected = {"2024-01-01": (1, 1, 1), "2024-01-02": (3, 0, 2)}
    run(second, 1)  # url 1 moves to the second day, url 2's version is an old one, of url 4 the later one counts
    assert table(base) == expected
    run(second, 1)
    assert table(base) == expected
    days = spark.read.parquet(f"{base}/news")
    before = {r._batch for r in days.where("_day = '2024-01-01'").collect()}
    run(spark.createDataFrame([(9, 1, two, 1, None)], schema), 2)
    after = spark.read.parquet(f"{base}/news")
    assert {r._batch for r in after.where("_day = '2024-01-01'").collect()} == before  # an untouched day is not written
    assert after.groupBy("day").count().agg(F.max("count")).first()[0] <= 2
    assert table(base)["2024-01-02"] == (4, 1, 2)


def test_reading_states_add_up(spark, tmp_path):
    import datetime as dt

    schema = "datetime timestamp_ntz, index_value double"
    base, at = str(tmp_path / "d"), dt.datetime(2024, 1, 1, 9)
    run = SD.reading_batch(base, "index", F.to_date("datetime"), {"index_value": F.col("index_value")})
    for i, rows in enumerate([[(at, 1.0), (at, None)], [(at, 3.0)], []]):
        run(spark.createDataFrame(rows, schema), i)
    got = SD.day_states(spark, f"{base}/index").collect()
    assert [(r.index_value_n, r.index_value_sum) for r in got] == [(2, 4.0)]
