from pyspark.sql import functions as F

from dailywire.operators import extract as E

SITES = [("s1", "http://one.example.com", "div", "main"), ("s2", "http://two.example.com", None, None)]
PAGES = [
    (1, "http://one.example.com/list", "<div class='main extra'><a href='/news/1'>n</a><a href='/news/1'>dup</a>"
        "<a href='/video/news'>v</a><a href='/about'>x</a></div><a href='/news/outside'>o</a>"),
    (2, "http://two.example.com/list", "<a href='/2022/11/Story'>s</a><a href='/photo/2022'>p</a><a href='tel:2022'>t</a>"
        "<a href='https://x.example.com/2021/a'>abs</a>"),
    (3, "http://two.example.com/a", "<h2>Only h2 &amp; more</h2><li class='x-article-y'>Body “one”</li>"
        "<time datetime='2022-11-02T19:45:00+08:00'>x</time>"),
    (4, "http://two.example.com/b", "<h1>Archive of things</h1><p>para<p>inner</p>"),
    (5, "http://two.example.com/c", "<h1>Head</h1><h1>Second</h1><div class='someText'>div text</div>"
        "<div class='timestamp'>(Published 2 Nov 2022, 7:45pm)</div>"),
    (6, "http://two.example.com/d", "<h1>Head</h1><div class='heading'><span>junk</span><span>2022-11-03 HKT 12:10</span></div>"),
    (7, "http://two.example.com/e", "<p>no headline</p>"),
    (8, "http://two.example.com/f", "<h1>x</h1><div class='createddate'>Nov 1, 2022 10:00 am</div><div class='createddate'>bad</div>"
        "<script>var t='</p>';</script><div class='createddate'>Nov 3, 2022 1:05 pm</div>"),
]


def _parsed(spark):
    return E.parse_pages(spark.createDataFrame(PAGES, "page_id long, url string, html string"))


def test_links_primary_fallback_distinct_and_resolve(spark):
    p = _parsed(spark).where("page_id in (1, 2)")
    out = {r.page_id: r for r in p.select(
        "page_id", "url",
        E.page_links("nodes", "div", "main").alias("one"),
        E.page_links("nodes", None, None).alias("two")).collect()}
    assert out[1].one == ["/news/1"]                       # keep rule + video rule + distinct, section only
    assert out[2].two == ["/2022/11/story", "https://x.example.com/2021/a"]  # fallback: lower, 4 digits, no photo/tel:
    res = spark.createDataFrame([("/news/1", "http://one.example.com"), ("https://a.b/c", "http://one.example.com")], "l string, h string")
    assert [r.u for r in res.select(E.resolve_url(F.col("l"), F.col("h")).alias("u")).collect()] == [
        "http://one.example.com/news/1", "https://a.b/c"]


def test_headline_body_time_cascades(spark):
    out = {r.page_id: r for r in _parsed(spark).select(
        "page_id", E.headline("nodes").alias("h"), E.body_text("nodes").alias("b"), E.published_time("nodes").alias("t")).collect()}
    assert out[3].h == " Only h2 & more" and out[3].b == " Body 'one'" and str(out[3].t) == "2022-11-02 11:45:00"
    assert out[4].b == " parainner inner"                 # unclosed p nests, as in a lenient tree
    assert out[5].h == " Head Second" and out[5].b == " div text" and str(out[5].t) == "2022-11-02 19:45:00"
    assert str(out[6].t) == "2022-11-03 12:10:00" and out[6].b is None
    assert out[7].h is None
    assert str(out[8].t) == "2022-11-03 13:05:00"          # last parsable createddate; script text ignored


def test_extract_articles_drops_and_quarantines(spark):
    arts = {r.page_id: r for r in E.extract_articles(_parsed(spark)).collect()}
    assert 4 not in arts and 7 not in arts                  # Archive headline, no headline
    assert arts[6].error == "no text found" and arts[5].error is None


def test_assemble_latest_wins_and_new_links(spark):
    df = spark.createDataFrame([("u1", 1, "a"), ("u1", 3, "c"), ("u2", 2, "b")], "url string, page_id int, heading string")
    out = sorted((r.url, r.page_id, r.heading) for r in E.assemble_articles(df).collect())
    assert out == [("u1", 3, "c"), ("u2", 2, "b")]
    store = spark.createDataFrame([("u2",)], "url string")
    assert sorted(r.url for r in E.new_links(df, store).collect()) == ["u1", "u1"]


def test_fuzzy_dates(spark):
    rows = [("(Published 2 Nov 2022, 7:45pm)", "2022-11-02 19:45:00"), ("2022-11-02T19:45:59+08:00", "2022-11-02 11:45:00"),
            ("2022-11-03 HKT 12:10", "2022-11-03 12:10:00"), ("Updated local Nov 3rd, 2022 12:05 am", "2022-11-03 00:05:00"),
            ("junk", None), ("2022-02-30 10:00", None), ("11/15/2022 10:30", "2022-11-15 10:30:00"), ("15.11.2022", "2022-11-15 00:00:00"),
            ("20221115T1030", "2022-11-15 10:30:00"), ("Nov 15, 2022 4PM", "2022-11-15 16:00:00"), ("market 12, 2022", None),
            ("Sept 5, 2022 1:00", "2022-09-05 01:00:00"), ("September 5, 2022", "2022-09-05 00:00:00"), ("5 december 2022", "2022-12-05 00:00:00")]
    df = spark.createDataFrame(rows, "s string, want string")
    for r in df.select("want", E.parse_fuzzy_datetime("s").alias("got")).collect():
        assert (str(r.got) if r.got else None) == r.want


def test_weather_fields_and_last_text(spark):
    t = "Current condition Rain 19:56 HKT Wind: 18 km/h Humidity: 80% Precipitation: 1.5 mm Visibility: 6.44 km UV index: 0 Sunny"
    r = spark.createDataFrame([(t,)], "t string").select(E.weather_fields("t").alias("w")).first()
    assert [(x.metric, x.value, x.unit) for x in r.w] == [
        ("Wind", 18.0, "km/h"), ("Humidity", 80.0, "%"), ("Precipitation", 1.5, "mm"), ("Visibility", 6.44, "km"), ("UV index", 0.0, "")]
    long = spark.createDataFrame([(1, x.metric, x.value, x.unit) for x in r.w], "id int, metric string, value double, unit string")
    wide = E.weather_columns(long, "id").first().asDict()
    assert wide == {"id": 1, "Wind in km/h": 18.0, "Humidity in %": 80.0, "Precipitation in mm": 1.5,
                    "Visibility in km": 6.44, "UV index": 0.0}
    html = "<span class='priceText__x'>16,900.00</span><span class='priceText__x'>16,914.58</span><div class='companyName__y'>Main Index</div>"
    p = E.parse_pages(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))
    q = p.select(E.last_text("nodes", "span", "priceText").alias("v"), E.last_text("nodes", "div", "companyName").alias("n")).first()
    assert (q.v, q.n) == ("16,914.58", "Main Index")


def test_news_fixture_typing_dedupe_and_daily_counts(spark):
    from dailywire.operators import clean as C
    from dailywire.operators import daily as D

    news = spark.createDataFrame([
        ("u1", "2022-11-02T23:30:00+08:00", "h", "t", "s1"),   # 15:30 UTC on Nov 2
        ("u2", "2022-11-02T23:30:00-08:00", "h", "t", "s1"),   # 07:30 UTC on Nov 3
        ("u3", None, "h", "t", "s2"),                          # dropped by C1
        ("u1", "2022-11-02T10:00:00+00:00", "h2", "t2", "s1"), # repeated URL, later arrival wins
    ], "URL string, datetime string, heading string, text string, newssite string").withColumn("arrival", F.monotonically_increasing_id())
    typed = C.drop_nulls(news).withColumn("datetime", C.to_timestamp("datetime", utc=True))
    parts = {r.URL: r for r in C.calendar_parts(typed, "datetime").collect()}
    assert str(parts["u2"].date) == "2022-11-03" and parts["u2"].weekday == 3  # Thursday, Monday = 0
    latest = E.assemble_articles(typed.withColumnRenamed("URL", "url"), "url", "arrival")
    assert {r.url: r.heading for r in latest.collect()} == {"u1": "h2", "u2": "h"}
    counts = D.daily_article_counts(latest.withColumn("date", F.to_date("datetime")), flag_cols=())
    assert {str(r.datetime): r.total_number_of_articles for r in counts.collect()} == {"2022-11-02": 1, "2022-11-03": 1}


def test_published_time_twin_on_fixture_pages(spark):
    """The driver pages carry no time markers, so the SQL twin of E10 is also checked here."""
    import duckdb
    import pandas as pd

    from dailywire.plans import extract_plans as X

    got = {r.page_id: r.t for r in _parsed(spark).select("page_id", E.published_time("nodes").alias("t")).collect()}
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(PAGES, columns=["page_id", "url", "html"]))
    want = dict(con.execute(X._published_sql()).fetchall())
    assert got == want and sum(v is not None for v in got.values()) == 4


def test_weather_metric_that_is_missing_is_null(spark):
    df = spark.createDataFrame([("Wind: 12 km/h, Humidity: 60 %",), ("nothing here",)], "t string")
    got = [{m.metric: (m.value, m.unit) for m in r.f} for r in df.select(E.weather_fields("t").alias("f")).collect()]
    assert got[0]["Wind"] == (12.0, "km/h") and got[0]["Visibility"] == (None, "") and got[1]["Wind"][0] is None


def test_naive_text_is_utc(spark):
    from dailywire.operators import clean as C

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Asia/Hong_Kong"):
            spark.conf.set("spark.sql.session.timeZone", z)
            rows = [("2022-11-15 10:00:00",), ("2022-11-15T10:00:00+02:00",), ("2022-11-15T10:00:00Z",), ("2022-11-15",), ("x",)]
            got = [r.t for r in spark.createDataFrame(rows, "s string").select(C.to_timestamp("s", utc=True).cast("string").alias("t")).collect()]
            assert got == ["2022-11-15 10:00:00", "2022-11-15 08:00:00", "2022-11-15 10:00:00", "2022-11-15 00:00:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_parse_output_is_linear_in_the_page(spark):
    html = "<ul>" + "".join(f"<li>item {i}" for i in range(2000))
    nodes, error = E.html_nodes(html)
    assert error is None and len(nodes) == 4001 and sum(len(n["text"] or "") for n in nodes) < len(html)
    assert nodes[0]["end"] == 4001


def test_page_that_cannot_be_parsed_is_reported(spark, monkeypatch):
    def broken(self, data):
        raise ValueError("bad page")

    monkeypatch.setattr(E._NodeBuilder, "feed", broken)
    assert E.html_nodes("<p>x") == ([], "ValueError: bad page")
    parsed = spark.createDataFrame([(1, "u", [], "ValueError: bad page")], f"page_id long, url string, nodes {E.NODES_DDL}, parse_error string")
    assert [(r.page_id, r.error) for r in E.extract_articles(parsed).collect()] == [(1, "ValueError: bad page")]


def test_links_by_site(spark):
    html = "<div class='x main'><a href='/news/1'>a</a><a href='/news/video'>v</a></div><a href='/news/2'>b</a>"
    plain = "<a href='/2024/x'>c</a><a href='/photo/2024'>d</a>"
    pages = spark.createDataFrame([(1, "s1", html), (2, "s2", html), (3, "s1", plain), (4, "other", html)], "page_id long, site string, html string")
    sites = spark.createDataFrame([("s1", "One", "https://one", "div", "main"), ("s2", "Two", "https://two", None, None)], "site string, newssite string, homepage string, section_tag string, section_class string")
    got = {(r.page_id, r.newssite, r.pos, r.url) for r in E.site_links(E.parse_pages(pages, keep=["site"]), sites).collect()}
    assert got == {(1, "One", 0, "https://one/news/1"), (2, "Two", 0, "https://two/news/1"), (2, "Two", 1, "https://two/news/2"), (3, "One", 0, "https://one/2024/x")}


def test_reading_card(spark):
    import datetime as dt

    head = "UV index: 9 x Current condition and temperature \n Hong Kong, Hong Kong as of 19:56 HKT Mostly cloudy "
    whole = head + "27° Wind: 18 km/h Humidity: 80% Precipitation: 1.5 mm Visibility: 6.44 km UV index: 0 Sunny Wind: 99 km/h"
    rows = [(1, whole), (2, head), (3, whole.replace("18 km/h", "18 knots")), (4, whole.replace("19:56", "25:99")), (5, None), (6, "")]
    df = spark.createDataFrame([(i, t, dt.date(2024, 2, 3)) for i, t in rows], "id int, t string, day date")
    got = {r.id: r for r in df.select("id", *E.reading_card("t", "day", units={"Wind": ("km/h",), "Humidity": ("%",), "UV index": ("", "s")})).collect()}
    assert str(got[1].time) == "2024-02-03 19:56:00" and got[1].condition == " Mostly cloudy " and got[1].section.endswith("UV index: 0 S")
    assert (got[1]["Wind in km/h"], got[1]["Humidity in %"], got[1]["UV index"], got[1].other_units) == (18.0, 80.0, 0.0, [])
    assert got[3]["Wind in km/h"] is None and got[3].other_units == ["Wind"]
    assert got[4].time is None and got[4]["Wind in km/h"] == 18.0
    for i in (2, 5, 6):
        assert got[i].section is None and got[i].time is None and got[i].condition is None and got[i]["Wind in km/h"] is None


def test_index_quote(spark):
    import datetime as dt

    html = "<span class='a price'>1</span><span class='price'> 16,914.58 </span><span class='prices'>3</span><div class='name'>Main &amp; Co</div>"
    at = dt.datetime(2024, 1, 2, 3, 4)
    p = E.parse_pages(spark.createDataFrame([(1, "u", html), (2, "v", "<p>x</p>")], "page_id long, url string, html string"))
    rows = {r.page_id: tuple(r)[1:] for r in p.select("page_id", *E.index_quote("nodes", ("div", "name"), ("span", "price"), F.lit(at))).collect()}
    assert rows == {1: (at, "Main & Co", 16914.58), 2: (at, None, None)}


def test_scan_datetime(spark):
    rows = [
        ("Monday, 5th of September 2022 at 3:04 pm", "2022-09-05 15:04:00"), ("3 pm on Sept 5, 2022", "2022-09-05 15:00:00"), ("12:30 AM 5 Jan", "2024-01-05 00:30:00"),
        ("Jan 5, 10:30 HKT", "2024-01-05 02:30:00"), ("2022-09-05T10:00:30-05:00", "2022-09-05 15:00:00"), ("20220905", "2022-09-05 00:00:00"), ("9/5/2022 1:00", "2022-09-05 01:00:00"),
        ("5.9.2022, 13:37 CEST", "2022-09-05 11:37:00"), ("May 2022", None), ("31 February 2022", None), ("nothing here", None), ("", None), (None, None), ("25:00 5 May 2022", None),
        ("first 3, then 4 May 2022", "2022-05-03 00:00:00"), ("2021-2022 was 5 May", "2021-05-05 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "s string, want string")
    for r in df.select("s", "want", E.scan_datetime("s", 2024).alias("got")).collect():
        assert (str(r.got) if r.got else None) == r.want, r.s
    assert spark.range(1).select(E.scan_datetime(F.lit("5 May 10:00")).alias("x")).first().x is None
