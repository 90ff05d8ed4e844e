"""Extraction queries over ``pages``.

DuckDB twins read the same HTML with regexes; html entity decoding is stated for the five
XML entities, which are the ones the generated pages use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailywire.functions import lexicons as L
from dailywire.operators import extract as E
from dailywire.plans import sqltext as S
from dailywire.plans.registry import query, rounded
from dailywire.sources.readers import table, text_table

SECTION_TAG, SECTION_CLASS = "nav", None  # the link section of the generated pages


def _unescape(x: str) -> str:
    """Decode the XML entities; amp / lt / gt / quot also without ';' (HTML5 legacy rule), amp last."""
    x = f"replace({x}, '&#39;', {S.q(chr(39))})"
    for name, ch in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', {S.q(ch)}, 'g')"
    return x


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.parse_pages(text_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


# Pages with what the link and time rules look for, derived from ``pages`` by the page number: story links
# inside and outside the section, links that the rules drop, and the four kinds of publish times.
_DAY = "lpad(cast(page_id % 28 + 1 as string), 2, '0')"
_STORY_LINKS = """case when page_id % 3 = 0 then concat('<nav><a href="/news/', cast(page_id as string), '">a</a><a href="/news/video/', cast(page_id as string), '">b</a>') else '<nav>' end"""
_STORY_TAIL = f"""concat('<a href="/2024/Story/', cast(page_id as string), '">c</a><a href="/photo/2024/', cast(page_id as string), '">d</a>',
    case page_id % 5
      when 0 then concat('<time datetime="2024-01-', {_DAY}, 'T04:05:30+08:00">today</time>')
      when 1 then concat('<div class="a timestamp">', {_DAY}, ' Jan 2024, 4:05PM</div>')
      when 2 then concat('<div class="createddate">Created</div><div class="x createddate y">Jan ', {_DAY}, ', 2024 10:30</div><div class="createddate">no date</div>')
      when 3 then concat('<div class="the heading"><span>Mar ', {_DAY}, ', 2024 1:02am</span><span>none</span></div>')
      else '' end)"""
_STORY_SQL = f"stories AS (SELECT page_id, url, concat(replace(html, '<nav>', {_STORY_LINKS}), {_STORY_TAIL}) AS html FROM pages)"


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = text_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    html = F.expr(f"concat(replace(html, '<nav>', {_STORY_LINKS}), {_STORY_TAIL})")
    return E.parse_pages(pages.withColumn("html", html))


_NAV_LINKS_SQL = f"""{_STORY_SQL}, nl AS (SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), 'href="([^"]*)"', 1) AS links FROM stories),
    nx AS (SELECT page_id, url, {S.replace_chain(_unescape('unnest(links)'), L.LINK_REPLACEMENTS)} AS link, CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS pos FROM nl)"""


def _any_sql(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {S.q(w)})" for w in words) + ")"


_PRIMARY_SQL = f"{_NAV_LINKS_SQL}, pr AS (SELECT * FROM nx WHERE {_any_sql('link', L.LINK_KEEP_ANY)} AND NOT {_any_sql('link', L.LINK_DROP_ANY)})"


@query("E1_extract_links", f"WITH {_PRIMARY_SQL} SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS pos, link FROM pr")
def e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the section selector that the keep and drop rules leave."""
    links = E.primary_links(E.section_links("nodes", SECTION_TAG, SECTION_CLASS))
    return _stories(spark, sf_dir).select("page_id", F.posexplode(links).alias("pos", "link"))


_ALL_LINKS_SQL = f"""al AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages),
    ax AS (SELECT page_id, url, {S.replace_chain(_unescape('unnest(links)'), L.LINK_REPLACEMENTS)} AS link, generate_subscripts(links, 1) AS pos FROM al)"""


_FALLBACK_CTES = f"""sl AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM stories),
    sx AS (SELECT page_id, lower({S.replace_chain(_unescape('unnest(links)'), L.LINK_REPLACEMENTS)}) AS link, generate_subscripts(links, 1) AS pos FROM sl),
    fb AS (SELECT * FROM sx WHERE regexp_matches(link, '[0-9]{{4}}') AND NOT {_any_sql('link', L.FALLBACK_LINK_DROP_ANY)})"""


@query(
    "E2_extract_links_fallback",
    f"WITH {_STORY_SQL}, {_FALLBACK_CTES} SELECT page_id, link FROM fb",
)
def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stories(spark, sf_dir).select("page_id", F.explode(E.fallback_links("nodes")).alias("link"))


@query(
    "E2_page_links",
    f"""WITH {_PRIMARY_SQL}, {_FALLBACK_CTES},
    ch AS (SELECT page_id, link, pos FROM pr UNION ALL SELECT page_id, link, pos FROM fb WHERE page_id NOT IN (SELECT page_id FROM pr)),
    fs AS (SELECT page_id, link, min(pos) AS first_pos FROM ch GROUP BY page_id, link)
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first_pos) - 1 AS INTEGER) AS pos, link FROM fs""",
)
def e2_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The composed rule: section links, the fallback only where there are none, each link once."""
    links = E.page_links("nodes", SECTION_TAG, SECTION_CLASS)
    return _stories(spark, sf_dir).select("page_id", F.posexplode(links).alias("pos", "link"))


_DISTINCT_SQL = _ALL_LINKS_SQL + """,
    fd AS (SELECT page_id, url, link, min(pos) AS first_pos FROM ax GROUP BY page_id, url, link),
    dl AS (SELECT page_id, url, link, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first_pos) - 1 AS INTEGER) AS pos FROM fd)"""


@query("E3_distinct_links", f"WITH {_DISTINCT_SQL} SELECT page_id, pos, link FROM dl")
def e3(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.array_distinct(E.section_links("nodes", None, None))
    return _parsed(spark, sf_dir).select("page_id", F.posexplode(links).alias("pos", "link"))


_RESOLVED_SQL = _DISTINCT_SQL + """,
    rs AS (SELECT page_id, pos, CASE WHEN regexp_matches(link, '^https?://') THEN link
           ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || link END AS url FROM dl)"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    homepage = F.regexp_extract(F.col("url"), r"^(https?://[^/?#]+)", 1)
    x = p.select("page_id", homepage.alias("homepage"), F.posexplode(F.array_distinct(E.section_links("nodes", None, None))).alias("pos", "link"))
    return x.select("page_id", "pos", E.resolve_url(F.col("link"), F.col("homepage")).alias("url"))


@query("E5_resolve_url", f"WITH {_RESOLVED_SQL} SELECT page_id, pos, url FROM rs")
def e5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)


@query("E4_new_links", f"WITH {_RESOLVED_SQL} SELECT page_id, pos, url FROM rs WHERE url NOT IN (SELECT url FROM pages WHERE url IS NOT NULL)")
def e4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved links that are not yet in the store (the store = pages already fetched)."""
    store = table(spark, sf_dir, "pages").select("url")
    return E.new_links(_resolved(spark, sf_dir), store, "url").select("page_id", "pos", "url")


_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"


@query(
    "E5_site_links",
    f"""WITH {_STORY_SQL},
    sc AS (SELECT page_id, {_HOST} AS host, CASE WHEN page_id % 2 = 0 THEN regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) ELSE html END AS part, html FROM stories),
    l1 AS (SELECT page_id, host, regexp_extract_all(part, 'href="([^"]*)"', 1) AS links FROM sc),
    l2 AS (SELECT page_id, host, {S.replace_chain(_unescape('unnest(links)'), L.LINK_REPLACEMENTS)} AS link, generate_subscripts(links, 1) AS n FROM l1),
    pr AS (SELECT * FROM l2 WHERE {_any_sql('link', L.LINK_KEEP_ANY)} AND NOT {_any_sql('link', L.LINK_DROP_ANY)}),
    {_FALLBACK_CTES},
    ch AS (SELECT page_id, link, n FROM pr UNION ALL SELECT page_id, link, pos FROM fb WHERE page_id NOT IN (SELECT page_id FROM pr)),
    fs AS (SELECT page_id, link, min(n) AS first_n FROM ch GROUP BY page_id, link)
    SELECT fs.page_id, 'site ' || sc.host AS newssite, CAST(row_number() OVER (PARTITION BY fs.page_id ORDER BY first_n) - 1 AS INTEGER) AS pos,
      CASE WHEN regexp_matches(link, '^https?://') THEN link ELSE 'https://' || sc.host || link END AS url
    FROM fs JOIN sc USING (page_id) WHERE sc.host <> ''""",
)
def e5_site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links by each site's selector and homepage. The sites table is derived from ``pages``: one entry per
    host and parity of the page number, the even ones with the section selector."""
    pages = table(spark, sf_dir, "pages").select(F.expr(_HOST).alias("host"), (F.col("page_id") % 2).alias("odd")).where("host <> ''").distinct()
    sites = pages.select(
        F.concat_ws("#", "host", F.col("odd").cast("string")).alias("site"), F.concat(F.lit("site "), "host").alias("newssite"),
        F.concat(F.lit("https://"), "host").alias("homepage"), F.when(F.col("odd") == 0, F.lit(SECTION_TAG)).alias("section_tag"), F.lit(None).cast("string").alias("section_class"),
    )
    site = F.concat_ws("#", F.expr(_HOST), (F.col("page_id") % 2).cast("string"))
    return E.site_links(_stories(spark, sf_dir).withColumn("site", site), sites)


def _headline_sql(tag: str) -> str:
    parts = f"regexp_extract_all(html, '(?s)<{tag}[^>]*>(.*?)</{tag}>', 1)"
    piece = S.clean_html_text(_unescape("regexp_replace(h, '<[^>]*>', '', 'g')"))
    return f"list_reduce(list_prepend('', list_transform({parts}, lambda h: ' ' || {piece})), lambda a, b: a || b)"


_HEADLINE_SQL = f"""hd AS (SELECT page_id, url, CASE WHEN len(regexp_extract_all(html, '<h1[ >]')) > 0 THEN {_headline_sql('h1')}
      WHEN len(regexp_extract_all(html, '<h2[ >]')) > 0 THEN {_headline_sql('h2')} END AS heading FROM pages)"""


@query("E7_extract_headline", f"WITH {_HEADLINE_SQL} SELECT page_id, heading FROM hd WHERE heading IS NOT NULL")
def e7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("page_id", E.headline("nodes").alias("heading")).where(F.col("heading").isNotNull())


DROP_WORD = "The"  # a word that occurs in generated headlines (the reference word is "Archive")


@query(
    "E8_drop_archive",
    f"WITH {_HEADLINE_SQL} SELECT page_id, heading FROM hd WHERE heading IS NOT NULL AND NOT contains(heading, '{DROP_WORD}')",
)
def e8(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _parsed(spark, sf_dir).select("page_id", E.headline("nodes").alias("heading"))
    return h.where(F.col("heading").isNotNull() & E.not_archive(F.col("heading"), DROP_WORD))


def _body_sql() -> str:
    """E9 twin for pages whose paragraphs are closed ``<p>`` or unclosed section headers: a ``<p>``
    that is never closed holds every later text of its container (here the article), a closed one
    its own text; the li / div branches of the cascade are stated with lazy regexes."""
    clean = lambda x: S.clean_html_text(_unescape(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))
    joined = lambda parts: f"list_reduce(list_prepend('', list_transform({parts}, lambda h: ' ' || {clean('h')})), lambda a, b: a || b)"
    li = "regexp_extract_all(html, '(?s)<li[^>]*class=\"[^\"]*article[^\"]*\"[^>]*>(.*?)</li>', 1)"
    div = "regexp_extract_all(html, '(?s)<div[^>]*class=\"[^\"]*Text[^\"]*\"[^>]*>(.*?)</div>', 1)"
    parts = "string_split(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>')"
    ps = (f"list_transform(generate_series(2, len({parts})), lambda i: CASE WHEN starts_with({parts}[i], '<b>') "
          f"THEN array_to_string(list_slice({parts}, i, len({parts})), '<p>') ELSE split_part({parts}[i], '</p>', 1) END)")
    nz = lambda x: f"nullif({x}, '')"
    return f"""SELECT page_id, text, CASE WHEN text IS NULL THEN 'no text found' END AS error FROM (
      SELECT page_id, coalesce({nz(joined(li))}, {nz(joined(div))}, {nz(joined(ps))}) AS text FROM pages)"""


@query("E9_extract_body", _body_sql())
def e9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body cascade; pages without body text keep a reason in ``error`` (no abort)."""
    body = _parsed(spark, sf_dir).select("page_id", E.body_text("nodes").alias("text"))
    return body.withColumn("error", F.when(F.col("text").isNull(), F.lit("no text found")))


def _published_sql(pages: str = "pages") -> str:
    """E10 twin: first time[datetime]; first div.timestamp; last parsable div ~createddate; last
    parsable span inside a div ~heading (lazy regexes: no nested div inside those divs)."""
    clean = lambda x: S.clean_html_text(_unescape(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))
    fz = S.fuzzy_datetime
    q = "[\"'']"
    t_attrs = "regexp_extract(html, '<time([^>]*)>', 1)"
    first_time = (f"CASE WHEN regexp_matches(html, '<time[\\s>]') THEN "
                  f"{fz(_unescape(f'regexp_extract({t_attrs}, {S.q(f"datetime={q}([^{chr(34)}'']*)")}, 1)'))} END")
    stamp_rx = f"(?s)<div[^>]*class={q}(?:[^{chr(34)}'']*\\s)?timestamp(?:\\s[^{chr(34)}'']*)?{q}[^>]*>(.*?)</div>"
    first_stamp = f"CASE WHEN regexp_matches(html, {S.q(stamp_rx)}) THEN {fz(clean(f'regexp_extract(html, {S.q(stamp_rx)}, 1)'))} END"
    created_rx = f"(?s)<div[^>]*class={q}[^{chr(34)}'']*createddate[^{chr(34)}'']*{q}[^>]*>(.*?)</div>"
    last_of = lambda items: f"list_filter(list_transform({items}, lambda v: {fz(clean('v'))}), lambda d: d IS NOT NULL)[-1]"
    created = last_of(f"regexp_extract_all(html, {S.q(created_rx)}, 1)")
    heading_rx = f"(?s)<div[^>]*class={q}[^{chr(34)}'']*heading[^{chr(34)}'']*{q}[^>]*>(.*?)</div>"
    spans = f"flatten(list_transform(regexp_extract_all(html, {S.q(heading_rx)}, 1), lambda h: regexp_extract_all(h, '(?s)<span[^>]*>(.*?)</span>', 1)))"
    return f"SELECT page_id, coalesce({first_time}, {first_stamp}, {created}, {last_of(spans)}) AS datetime FROM {pages}"


@query("E10_extract_published", f"WITH {_STORY_SQL} {_published_sql('stories')}")
def e10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stories(spark, sf_dir).select("page_id", E.published_time("nodes").alias("datetime"))


@query("E12_parse_fuzzy_datetime", "SELECT event_id, date_trunc('minute', ts) AS parsed FROM events")
def e12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading times rendered as free text ('(Published 7 Jan 2024, 4:05PM) local'), parsed back to the minute."""
    ev = table(spark, sf_dir, "events")
    txt = F.concat(F.lit("(Published "), F.date_format("ts", "d MMM yyyy, h:mma"), F.lit(") local"))
    return ev.select("event_id", E.parse_fuzzy_datetime(txt).alias("parsed"))


#: Ways in which a time is written: weekdays, any order, no year, clock first, zones, offsets, ordinals.
_RENDERED = [
    "date_format(ts, 'EEEE, d MMMM yyyy, HH:mm')", "date_format(ts, 'MMM d, yyyy h:mm a')", "date_format(ts, 'HH:mm dd.MM.yyyy')", "date_format(ts, 'h:mm a EEE, MMM dd yyyy')",
    "date_format(ts, \"yyyyMMdd'T'HH:mm:ss'Z'\")", "concat(date_format(ts, 'MM/dd/yyyy'), ' at ', date_format(ts, 'H:mm'))", "date_format(ts, 'EEE d MMM HH:mm')",
    "concat('Posted on the ', date_format(ts, 'd'), 'th of ', date_format(ts, 'MMMM, HH:mm'), ' hours')", "concat(date_format(ts + interval 8 hours, 'HH:mm'), ' HKT, ', date_format(ts + interval 8 hours, 'MMMM d yyyy'))",
    "concat(date_format(ts - interval 5 hours, 'yyyy/M/d HH:mm'), ' -0500')", "concat(date_format(ts + interval 330 minutes, \"yyyy-MM-dd'T'HH:mm:ss\"), '+05:30')", "concat('2024, ', date_format(ts, 'd MMM'), ' by staff, ', date_format(ts, 'h:mma'), ' GMT')",
    "concat(date_format(ts, 'h a'), ', ', date_format(ts, 'MMMM d'))", "concat('no date: ', date_format(ts, 'HH:mm'), ', 40 ', date_format(ts, 'MMMM'))",
]


@query(
    "E12_scan_datetime",
    f"""SELECT event_id, CASE event_id % {len(_RENDERED)} WHEN 12 THEN date_trunc('hour', ts) WHEN 13 THEN NULL ELSE date_trunc('minute', ts) END AS parsed FROM events""",
)
def e12_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading times written in fourteen ways, two of them without a year, one without a day."""
    forms = " ".join(f"when {i} then {form}" for i, form in enumerate(_RENDERED))
    text = F.expr(f"case event_id % {len(_RENDERED)} {forms} end")
    return table(spark, sf_dir, "events").select("event_id", E.scan_datetime(text, 2024).alias("parsed"))


@query(
    "E13_assemble_articles",
    f"""WITH {_STORY_SQL}, {_HEADLINE_SQL}, tm AS ({_published_sql('stories')}), bd AS ({_body_sql()}),
    a AS (SELECT hd.url, page_id, heading, text, datetime, error, 'site ' || regexp_extract(hd.url, '^https?://([^/?#]+)', 1) AS newssite
      FROM hd JOIN tm USING (page_id) JOIN bd USING (page_id) WHERE heading IS NOT NULL AND NOT contains(heading, 'Archive'))
    SELECT url, max(page_id) AS page_id, arg_max(heading, page_id) AS heading, arg_max(coalesce(text, ''), page_id) AS text,
      max(CASE WHEN page_id = m THEN datetime END) AS datetime, max(CASE WHEN page_id = m THEN error END) AS error, arg_max(newssite, page_id) AS newssite
    FROM (SELECT *, max(page_id) OVER (PARTITION BY url) AS m FROM a) GROUP BY url""",
)
def e13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole article of every URL, from its latest page: heading, text, publish time, site, and why text is missing."""
    pages = _stories(spark, sf_dir).withColumn("newssite", F.concat(F.lit("site "), F.expr(_HOST)))
    arts = E.assemble_articles(E.extract_articles(pages), "url", "page_id")
    return arts.select("url", "page_id", "heading", F.coalesce("text", F.lit("")).alias("text"), "datetime", "error", "newssite")


def _reading_text() -> F.Column:
    v = F.col("value").cast("string")
    k = F.get_json_object("props", "$.k")
    return F.concat(F.lit("Current condition "), F.col("event_type"), F.lit(" 10:00 HKT Wind: "), v, F.lit(" km/h Humidity: "), k,
                    F.lit("% Precipitation: "), v, F.lit(" mm Visibility: 10 km UV index: "), k)


@query(
    "E14_extract_weather_fields",
    """SELECT event_id, metric, round(value, 6) AS value, unit FROM (
      SELECT event_id, 'Wind' AS metric, value, 'km/h' AS unit FROM events
      UNION ALL SELECT event_id, 'Humidity', CAST(json_extract(props, '$.k') AS DOUBLE), '%' FROM events
      UNION ALL SELECT event_id, 'Precipitation', value, 'mm' FROM events
      UNION ALL SELECT event_id, 'Visibility', 10.0, 'km' FROM events
      UNION ALL SELECT event_id, 'UV index', CAST(json_extract(props, '$.k') AS DOUBLE), '' FROM events)""",
)
def e14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather readings rendered as page text, then the five metrics read back with value and unit."""
    ev = table(spark, sf_dir, "events")
    fields = ev.select("event_id", F.explode(E.weather_fields(_reading_text())).alias("f"))
    return rounded(fields.select("event_id", F.col("f.metric").alias("metric"), F.col("f.value").alias("value"), F.col("f.unit").alias("unit")))


def _last_text_sql(tag: str) -> str:
    parts = f"regexp_extract_all(html, '(?s)<{tag}[^>]*>(.*?)</{tag}>', 1)"
    last = _unescape(f"regexp_replace({parts}[-1], '<[^>]*>', '', 'g')")
    return f"CASE WHEN len({parts}) > 0 THEN {S.clean_html_text(last)} END"


@query(
    "E15_extract_index_quote",
    f"SELECT page_id, {_last_text_sql('h1')} AS index_name, {_last_text_sql('li')} AS index_value FROM pages",
)
def e15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last matching name / value text of a page (here: the last ``li`` and the ``h1``)."""
    p = _parsed(spark, sf_dir)
    return p.select("page_id", E.last_text("nodes", "h1").alias("index_name"), E.last_text("nodes", "li").alias("index_value"))


_QUOTES = """concat(html, '<span class="x priceText__06f600fa3e">', cast(page_id as string), '</span><div class="companyName__1af0080d26 y">Index &amp; ', cast(page_id % 7 as string),
    '</div><span class="priceText">7</span>', case when page_id % 3 > 0 then concat('<span class="priceText__06f600fa3e"> ', cast(page_id % 9 + 1 as string), ',', lpad(cast(page_id % 1000 as string), 3, '0'), '.25 </span>') else '' end)"""
_QUOTE_CLASSES = ("div", "companyName__1af0080d26"), ("span", "priceText__06f600fa3e")


@query(
    "E15_index_quote",
    f"""WITH q AS (SELECT page_id, {_QUOTES} AS html FROM pages),
    v AS (SELECT page_id, trim(regexp_extract_all(html, '<span class="(?:[^"]* )?priceText__06f600fa3e(?: [^"]*)?">([^<]*)</span>', 1)[-1]) AS v,
      regexp_extract_all(html, '<div class="(?:[^"]* )?companyName__1af0080d26(?: [^"]*)?">([^<]*)</div>', 1)[-1] AS n FROM q)
    SELECT page_id, TIMESTAMP '2024-01-01 09:30:00' + to_minutes(CAST(page_id % 600 AS BIGINT)) AS datetime, replace(n, '&amp;', '&') AS index_name,
      CAST(replace(v, ',', '') AS DOUBLE) AS index_value FROM v""",
)
def e15_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes by class, with the reading time: pages with one or two prices, of which the last counts."""
    pages = text_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    parsed = E.parse_pages(pages.withColumn("html", F.expr(_QUOTES)))
    at = F.expr("timestamp_ntz'2024-01-01 09:30:00' + make_dt_interval(0, 0, cast(page_id % 600 as int))")
    return rounded(parsed.select("page_id", *E.index_quote("nodes", *_QUOTE_CLASSES, at)))


def _card_text() -> F.Column:
    """A card among other text: markers also before and after it, units that vary, every tenth one cut short."""
    v, k = F.col("value").cast("string"), F.get_json_object("props", "$.k")
    head = F.concat(F.lit("Wind: 1 km/h UV index: 3 x Current condition and temperature \n Hong Kong, Hong Kong as of "), F.date_format("ts", "H:mm"), F.lit(" HKT "), F.col("event_type"))
    rest = F.concat(F.lit(" 21° Wind: "), v, F.when(F.col("event_id") % 2 == 0, " km/h").otherwise(" mph"), F.lit(" Humidity: "), k, F.lit("% Precipitation: "), v,
                    F.when(F.col("event_id") % 3 == 0, " in").otherwise(" mm"), F.lit(" Visibility: 10 furlongs UV index: "), k, F.lit(" h Wind: 99 km/h 11:11 HKT"))
    return F.when(F.col("event_id") % 10 < 9, F.concat(head, rest)).otherwise(head)


@query(
    "E14_reading_card",
    """SELECT event_id, CASE WHEN ok THEN date_trunc('minute', ts) END AS time, CASE WHEN ok THEN ' ' || event_type || ' ' END AS condition,
      CASE WHEN ok AND event_id % 2 = 0 THEN round(value, 6) END AS wind_kmh, CASE WHEN ok AND event_id % 2 = 1 THEN round(value, 6) END AS wind_mph,
      CASE WHEN ok THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS humidity,
      CASE WHEN ok AND event_id % 3 <> 0 THEN round(value, 6) END AS rain_mm, CASE WHEN ok AND event_id % 3 = 0 THEN round(value, 6) END AS rain_in,
      CASE WHEN ok THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS uv, CASE WHEN ok THEN 'Visibility' END AS other_units
    FROM (SELECT *, event_id % 10 < 9 AS ok FROM events)""",
)
def e14_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = table(spark, sf_dir, "events").select("event_id", *E.reading_card(_card_text(), F.to_date("ts")))
    return rounded(card.select(
        "event_id", "time", "condition", F.col("`Wind in km/h`").alias("wind_kmh"), F.col("`Wind in mph`").alias("wind_mph"), F.col("`Humidity in %`").alias("humidity"),
        F.col("`Precipitation in mm`").alias("rain_mm"), F.col("`Precipitation in in`").alias("rain_in"), F.col("`UV index in h`").alias("uv"),
        F.when(F.size("other_units") > 0, F.array_join("other_units", ",")).alias("other_units")))
