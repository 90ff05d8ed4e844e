"""Article extraction over a raw pages table.

One Python pass per page (stdlib ``html.parser`` inside ``mapInArrow``) turns the HTML into an
array of elements and text runs ``(i, end, tag, cls, href, dt, text)``; every rule after that (link
filters, headline / body / time cascades, dedupe) is a native column expression over that array.
The page rows are never shuffled by the parse; one row per page goes in and one comes out.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailywire.functions import lexicons as L
from dailywire.functions import text as TX

NODE_FIELDS = [
    ("i", pa.int32()), ("end", pa.int32()), ("tag", pa.string()), ("cls", pa.string()), ("href", pa.string()),
    ("dt", pa.string()), ("text", pa.string()),
]
NODES_DDL = "array<struct<i:int,end:int,tag:string,cls:string,href:string,dt:string,text:string>>"
TEXT = "#text"  # the tag of a run of text
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT_TAGS = frozenset(("script", "style"))
PARSE_SLICE_ROWS = 256  # pages parsed per output batch


class _NodeBuilder(HTMLParser):
    """Elements and text runs in document order; ``end`` is the place after an element's last descendant
    (unclosed tags nest: an end tag closes its nearest open match). Every text run is held once."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.stack: list[int] = []
        self.raw_depth = 0

    def _add(self, tag: str, cls=None, href=None, dt=None, text=None) -> int:
        i = len(self.nodes)
        self.nodes.append({"i": i, "end": i + 1, "tag": tag, "cls": cls, "href": href, "dt": dt, "text": text})
        return i

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        i = self._add(tag, a.get("class"), a.get("href"), a.get("datetime"))
        if tag not in VOID_TAGS:
            self.stack.append(i)
            self.raw_depth += tag in RAW_TEXT_TAGS

    def handle_startendtag(self, tag, attrs):
        a = dict(attrs)
        self._add(tag, a.get("class"), a.get("href"), a.get("datetime"))

    def _close(self, depth: int) -> None:
        for i in self.stack[depth:]:
            self.nodes[i]["end"] = len(self.nodes)
            self.raw_depth -= self.nodes[i]["tag"] in RAW_TEXT_TAGS
        del self.stack[depth:]

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.nodes[self.stack[k]]["tag"] == tag:
                self._close(k)
                return

    def handle_data(self, data):
        if not self.raw_depth:
            self._add(TEXT, text=data)

    def result(self) -> list[dict]:
        self._close(0)
        return self.nodes


def html_nodes(html: str | None) -> tuple[list[dict], str | None]:
    """(nodes, error) of one page; a page that the parser gives up on has no nodes and the reason."""
    if html is None:
        return [], None
    b = _NodeBuilder()
    try:
        b.feed(html)
        b.close()
    except Exception as e:  # noqa: BLE001 - a broken page must not stop the job; it is reported
        return [], f"{type(e).__name__}: {e}"
    return b.result(), None


def parse_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: Sequence[str] = ("url",)) -> DataFrame:
    """(id, *keep, nodes, parse_error): the HTML node pass, Arrow batches in and out. The nodes are linear
    in the size of the page."""
    keep = [c for c in keep if c in pages.columns and c != id_col]
    src = pages.select(id_col, *keep, html_col)
    fields = {f.name: f for f in src.schema.fields}
    out_ddl = ", ".join([f"{id_col} {fields[id_col].dataType.simpleString()}"]
                        + [f"{c} {fields[c].dataType.simpleString()}" for c in keep] + [f"nodes {NODES_DDL}", "parse_error string"])
    node_type = pa.list_(pa.struct(NODE_FIELDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # parse and emit in slices so one output batch stays bounded whatever the input batch size
            for start in range(0, whole.num_rows, PARSE_SLICE_ROWS):
                b = whole.slice(start, PARSE_SLICE_ROWS)
                parsed = [html_nodes(h) for h in b.column(html_col).to_pylist()]
                cols = [b.column(id_col)] + [b.column(c) for c in keep]
                cols += [pa.array([n for n, _ in parsed], type=node_type), pa.array([e for _, e in parsed], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[id_col, *keep, "nodes", "parse_error"])

    return src.mapInArrow(run, out_ddl)


# ---------------------------------------------------------------- node selectors (Column -> Column)

def nodes_with_tag(nodes: Column | str, tag: str, cls_contains: str | None = None, cls_token: str | None = None) -> Column:
    """Nodes of ``tag`` whose class string contains ``cls_contains`` / has the class ``cls_token``."""
    n = F.col(nodes) if isinstance(nodes, str) else nodes

    def keep(x):
        cond = x["tag"] == tag
        if cls_contains is not None:
            cond = cond & F.coalesce(x["cls"].contains(cls_contains), F.lit(False))
        if cls_token is not None:
            cond = cond & F.coalesce(F.array_contains(F.split(x["cls"], r"\s+"), cls_token), F.lit(False))
        return cond

    return F.filter(n, keep)


def node_text(nodes: Column, x: Column) -> Column:
    """All text below a node: the text runs between its place and its ``end``."""
    below = F.filter(F.slice(nodes, x["i"] + 2, x["end"] - x["i"] - 1), lambda t: t["tag"] == TEXT)
    return F.array_join(F.transform(below, lambda t: t["text"]), "")


def joined_clean_text(nodes: Column, selected: Column) -> Column:
    """``"" + " " + clean(text)`` for each selected node, in document order ('' when none)."""
    return F.aggregate(selected, F.lit(""), lambda acc, x: F.concat(acc, F.lit(" "), TX.clean_html_text(node_text(nodes, x))))


def _inside(sections: Column, x: Column) -> Column:
    """Whether the node is below one of the section nodes."""
    return F.exists(sections, lambda s: (s["i"] < x["i"]) & (x["i"] < s["end"]))


def section_links(nodes: Column | str, section_tag: str | None, section_class: str | None) -> Column:
    """E1 raw: hrefs of ``a`` nodes inside the site's section selector (all ``a`` without a selector), doc order."""
    n = F.col(nodes) if isinstance(nodes, str) else nodes
    anchors = nodes_with_tag(n, "a")
    if section_tag is not None:
        anchors = TX.let(nodes_with_tag(n, section_tag, cls_token=section_class), lambda sections: F.filter(nodes_with_tag(n, "a"), lambda x: _inside(sections, x)))
    return F.transform(anchors, lambda x: TX.clean_link(F.coalesce(x["href"], F.lit("None"))))


def _contains_any(c: Column, words: Sequence[str]) -> Column:
    if not words:
        return F.lit(False)
    out = c.contains(words[0])
    for w in words[1:]:
        out = out | c.contains(w)
    return out


def primary_links(links: Column, keep_any: Sequence[str] = L.LINK_KEEP_ANY, drop_any: Sequence[str] = L.LINK_DROP_ANY) -> Column:
    """E1 rule: keep links containing one of ``keep_any`` and none of ``drop_any`` (empty keep = keep all)."""
    return F.filter(links, lambda u: (_contains_any(u, keep_any) if keep_any else F.lit(True)) & ~_contains_any(u, drop_any))


def fallback_links(nodes: Column | str, drop_any: Sequence[str] = L.FALLBACK_LINK_DROP_ANY) -> Column:
    """E2 rule: every href lower-cased, with four digits in a row and none of ``drop_any``."""
    all_links = F.transform(section_links(nodes, None, None), lambda u: F.lower(u))
    return F.filter(all_links, lambda u: u.rlike(r"\d\d\d\d") & ~_contains_any(u, drop_any))


def page_links(nodes: Column | str, section_tag: str | None, section_class: str | None,
               keep_any: Sequence[str] = L.LINK_KEEP_ANY, drop_any: Sequence[str] = L.LINK_DROP_ANY) -> Column:
    """E1 -> E2 -> E3: primary links, the fallback only when there are none, order-preserving distinct."""
    primary = primary_links(section_links(nodes, section_tag, section_class), keep_any, drop_any)
    chosen = F.when(F.size(primary) > 0, primary).otherwise(fallback_links(nodes))
    return F.array_distinct(chosen)


def resolve_url(link: Column, homepage: Column) -> Column:
    """E5: a link that is not absolute becomes ``homepage + link``."""
    return F.when(link.rlike(r"^https?://"), link).otherwise(F.concat(homepage, link))


def site_links(parsed: DataFrame, sites: DataFrame, site: str = "site", id_col: str = "page_id") -> DataFrame:
    """E1 -> E2 -> E3 -> E5 with each site's own rules: (id, newssite, pos, url).

    ``sites`` has a row per site: (site, newssite, homepage, section_tag, section_class); a NULL tag takes
    the whole page, a NULL class any element of the tag. Pages of a site that is not listed give no links.
    """
    j = parsed.join(sites, site)
    n, tag, cls = F.col("nodes"), F.col("section_tag"), F.col("section_class")
    sections = F.filter(n, lambda x: (x["tag"] == tag) & (cls.isNull() | F.coalesce(F.array_contains(F.split(x["cls"], r"\s+"), cls), F.lit(False))))
    inside = TX.let(sections, lambda s: F.filter(nodes_with_tag(n, "a"), lambda x: tag.isNull() | _inside(s, x)))
    primary = primary_links(F.transform(inside, lambda x: TX.clean_link(F.coalesce(x["href"], F.lit("None")))))
    chosen = TX.let(primary, lambda p: F.array_distinct(F.when(F.size(p) > 0, p).otherwise(fallback_links(n))))
    links = j.select(id_col, "newssite", "homepage", F.posexplode(chosen).alias("pos", "link"))
    return links.select(id_col, "newssite", "pos", resolve_url(F.col("link"), F.col("homepage")).alias("url"))


def headline(nodes: Column | str) -> Column:
    """All h1 texts (each as ``" " + clean``); if there is no h1, the h2s; NULL when neither exists."""
    n = F.col(nodes) if isinstance(nodes, str) else nodes
    h1, h2 = nodes_with_tag(n, "h1"), nodes_with_tag(n, "h2")
    return F.when(F.size(h1) > 0, joined_clean_text(n, h1)).when(F.size(h2) > 0, joined_clean_text(n, h2))


def not_archive(headline_col: Column, word: str = "Archive") -> Column:
    """E8 predicate: headline does not contain ``word`` (case-sensitive)."""
    return ~headline_col.contains(word)


def body_text(nodes: Column | str) -> Column:
    """Li with class ~article; else div with class ~Text; else all p; NULL when nothing (quarantined)."""
    n = F.col(nodes) if isinstance(nodes, str) else nodes
    li = nodes_with_tag(n, "li", cls_contains="article")
    div = nodes_with_tag(n, "div", cls_contains="Text")
    p = nodes_with_tag(n, "p")
    nz = lambda c: F.when(c != "", c)
    return F.coalesce(nz(joined_clean_text(n, li)), nz(joined_clean_text(n, div)), nz(joined_clean_text(n, p)))


# ---------------------------------------------------------------- fuzzy date parsing

_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_MONTH_ENDS = "uary ruary ch il  e y ust (?:t|tember) ober ember ember".split(" ")
# a month's short or whole name, not the start of another word
_MON = r"\b(" + "|".join(_MONTHS) + r")(?:" + "|".join(sorted({e for e in _MONTH_ENDS if e})) + r")?\b\.?"


def _month_number(m: Column) -> Column:
    out = F.lit(None).try_cast("int")
    for i, name in enumerate(_MONTHS, start=1):
        out = F.when(m == name, F.lit(i)).otherwise(out)
    return out


def _clock(t: Column) -> tuple[Column, Column]:
    """hour, minute from the first ``h:mm`` (with optional am/pm) in ``t``, else a bare hour with am/pm
    or a compact ``thhmm``; 0:00 when absent."""
    rx, bare, compact = r"(\d{1,2}):(\d{2})(?::\d{2})?\s*(am|pm|a\.m\.|p\.m\.)?", r"\b(\d{1,2})\s*(am|pm|a\.m\.|p\.m\.)", r"\bt(\d{2})(\d{2})(?:\d{2})?\b"
    has, has_bare = t.rlike(rx), t.rlike(bare)
    h = F.when(has, F.regexp_extract(t, rx, 1)).when(has_bare, F.regexp_extract(t, bare, 1)).otherwise(F.regexp_extract(t, compact, 1))
    mi = F.when(has, F.regexp_extract(t, rx, 2)).when(has_bare, F.lit("")).otherwise(F.regexp_extract(t, compact, 2))
    ampm = F.when(has, F.regexp_extract(t, rx, 3)).when(has_bare, F.regexp_extract(t, bare, 2)).otherwise(F.lit(""))
    hour = F.when(h == "", F.lit(0)).otherwise(h.try_cast("int"))
    hour = F.when(ampm.startswith("p") & (hour < 12), hour + 12).when(ampm.startswith("a") & (hour == 12), F.lit(0)).otherwise(hour)
    minute = F.when(mi == "", F.lit(0)).otherwise(mi.try_cast("int"))
    return hour, minute


def normalise_date_text(col: Column | str) -> Column:
    """E12 step 1: lower-case and remove the noise words in order."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    for w in L.DATE_NOISE:
        c = F.replace(c, F.lit(w), F.lit(""))
    return c


def parse_fuzzy_datetime(col: Column | str) -> Column:
    """Find a date (ISO, ``d Mon yyyy``, ``Mon d, yyyy``, ``m/d/yyyy``, ``d.m.yyyy`` or compact
    ``yyyymmdd``) and a clock time anywhere in the text.

    Seconds are zeroed; an explicit UTC offset is applied (result in UTC); failure -> NULL.
    The normalised text, the kind of date found and the text after removing the date are each
    bound once (``let``), which keeps the expression small and every regex evaluated once per row.
    """
    # E11 cleaning turns '-' into blanks before the cascade parses, so separators may be - / . or blank
    iso = r"(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})"
    dmy = r"(\d{1,2})(?:st|nd|rd|th)?\s+" + _MON + r",?\s+(\d{4})"
    mdy = _MON + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})"
    slashes, dots, compact = r"\b(\d{1,2})/(\d{1,2})/(\d{4})", r"\b(\d{1,2})\.(\d{1,2})\.(\d{4})", r"\b(\d{4})(\d{2})(\d{2})(?=t\d|\b)"
    # kind -> (regex, year/month/day groups)
    patterns = {1: (iso, (1, 2, 3)), 2: (dmy, (3, 2, 1)), 3: (mdy, (3, 1, 2)), 4: (slashes, (3, 1, 2)), 5: (dots, (3, 2, 1)), 6: (compact, (1, 2, 3))}

    def pick(kind: Column, fn) -> Column:
        out = F.lit(None)
        for k in sorted(patterns, reverse=True):
            out = F.when(kind == k, fn(*patterns[k])).otherwise(out)
        return out

    def on_text(t: Column) -> Column:
        kind = F.when(t.rlike(iso), 1).when(t.rlike(dmy), 2).when(t.rlike(mdy), 3).when(t.rlike(slashes), 4).when(t.rlike(dots), 5).when(t.rlike(compact), 6)

        def on_kind(k: Column) -> Column:
            year = pick(k, lambda rx, g: F.regexp_extract(t, rx, g[0]).try_cast("int"))
            named = F.when(k == 2, _month_number(F.regexp_extract(t, dmy, 2))).otherwise(_month_number(F.regexp_extract(t, mdy, 1)))
            month = F.when(k.isin(2, 3), named).otherwise(pick(k, lambda rx, g: F.regexp_extract(t, rx, g[1]).try_cast("int")))
            day = pick(k, lambda rx, g: F.regexp_extract(t, rx, g[2]).try_cast("int"))

            def on_rest(rest: Column) -> Column:
                hour, minute = _clock(rest)
                stamp = F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0))
                off = F.regexp_extract(rest, r"\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?\s*(z|[+-]\d{2}:?\d{2})", 1)
                sign = F.when(off.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
                digits = F.regexp_replace(off, r"[^0-9]", "")
                off_min = F.when((off == "") | (off == "z"), F.lit(0)).otherwise(
                    sign * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")))
                return stamp - F.make_dt_interval(F.lit(0), F.lit(0), off_min)

            # the clock is looked for after the date part (an ISO 'T' separator is fine)
            rest = pick(k, lambda rx, g: F.regexp_replace(t, rx, " "))
            return F.when(k.isNotNull(), TX.let(rest, on_rest))

        return TX.let(kind, on_kind)

    return TX.let(normalise_date_text(col), on_text)


_LONG_MONTHS = "january february march april may june july august september october november december".split()
#: Hours east of UTC of zone names; a name that several zones share has its most frequent meaning.
ZONES = {"z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 1, "cet": 1, "cest": 2, "eet": 2, "msk": 3, "ist": 5.5, "sgt": 8, "hkt": 8, "jst": 9, "aest": 10, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}
#: Tokens of a date text: numeric dates, offsets, clocks, half-day marks, words, numbers.
_DATE_TOKENS = r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4}|(?<!\d)\d{8}(?!\d)|(?<=\d|\s|c|t)[+-]\d{2}:?\d{2}(?!\d)|\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?|(?<![a-z])[ap]\.?m\b\.?|[a-z]+|\d+"


def scan_datetime(col: Column | str, year: Column | int | None = None) -> Column:
    """E12 over any text: a scan of its date tokens that keeps what it has found so far.

    Day, month, year, clock, half of the day and zone may come in any order and among other words: numeric
    dates (y-m-d, m/d/y, d.m.y, yyyymmdd), month names, numbers with or without endings, ``h:mm``, bare hours
    with am / pm, offsets, and the zone names of ``ZONES``. The first of each kind counts; a number of four
    digits is a year, one to 31 a day, or the hour if am / pm follows. A missing year is ``year``, a missing
    clock 0:00; seconds are zeroed, and with an offset or zone the result is in UTC. Weekdays and other words
    are passed over. NULL without day and month, or for a date that does not exist.
    """
    t = normalise_date_text(col)
    months = F.create_map(*[F.lit(x) for i, name in enumerate(_LONG_MONTHS, 1) for x in (name, i)], *[F.lit(x) for i, n in enumerate(_MONTHS, 1) if n != "may" for x in (n, i)], F.lit("sept"), F.lit(9))
    zones = F.create_map(*[F.lit(x) for z, h in ZONES.items() for x in (z, int(h * 60))])
    null = F.lit(None).cast("int")
    start = F.struct(*[null.alias(n) for n in ("y", "m", "d", "h", "mi", "off", "num")], F.lit("").alias("half"))

    def step(s: Column, w: Column) -> Column:
        number = w.try_cast("int")
        parts = F.split(w, r"[-/.]")
        whole = w.rlike(r"^\d+$")
        compact = w.rlike(r"^\d{8}$")
        date = (w.rlike(r"^\d+[-/.]\d+[-/.]\d+$") | compact) & s["m"].isNull()
        ymd = w.rlike(r"^\d{4}\D")
        at = lambda i: F.get(parts, F.lit(i)).try_cast("int")
        pick = lambda c, iso, slash, dot: F.when(compact, c).when(ymd, iso).when(w.contains("/"), slash).otherwise(dot)
        clock = w.contains(":") & ~w.rlike("^[+-]") & s["h"].isNull()
        hm = F.split(w, ":")
        half = w.rlike(r"^[ap]\.?m\.?$")
        bare = half & s["h"].isNull() & s["num"].isNotNull()
        offset = w.rlike("^[+-]") & s["h"].isNotNull() & s["off"].isNull()
        digits = F.regexp_replace(w, "[^0-9]", "")
        minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
        zone, month = F.try_element_at(zones, w), F.try_element_at(months, w)
        year_ = whole & (F.length(w) == 4) & s["y"].isNull()
        day_ = whole & (F.length(w) <= 2) & s["d"].isNull() & number.between(1, 31)
        sub = lambda a, n: F.substring(w, a, n).try_cast("int")
        return F.struct(
            F.when(date, pick(sub(1, 4), at(0), at(2), at(2))).when(year_, number).otherwise(s["y"]).alias("y"),
            F.when(date, pick(sub(5, 2), at(1), at(0), at(1))).otherwise(F.coalesce(s["m"], month)).alias("m"),
            # the number before am / pm was the hour, not the day
            F.when(date, pick(sub(7, 2), at(2), at(1), at(0))).when(day_, number).when(bare & (s["d"] == s["num"]), null).otherwise(s["d"]).alias("d"),
            F.when(clock, F.get(hm, F.lit(0)).try_cast("int")).when(bare, s["num"]).otherwise(s["h"]).alias("h"),
            F.when(clock, F.get(hm, F.lit(1)).try_cast("int")).when(bare, 0).otherwise(s["mi"]).alias("mi"),
            F.when(offset, F.when(w.startswith("-"), -minutes).otherwise(minutes)).otherwise(F.coalesce(s["off"], F.when(s["h"].isNotNull(), zone))).alias("off"),
            F.when(whole & (F.length(w) <= 2), number).alias("num"),
            F.when(half & (s["half"] == ""), F.substring(w, 1, 1)).otherwise(s["half"]).alias("half"),
        )

    def made(s: Column) -> Column:
        h = F.coalesce(s["h"], F.lit(0))
        hour = F.when((s["half"] == "p") & (h < 12), h + 12).when((s["half"] == "a") & (h == 12), F.lit(0)).otherwise(h)
        default = F.lit(year) if not isinstance(year, Column) else year
        stamp = F.try_make_timestamp_ntz(F.coalesce(s["y"], default.cast("int")), s["m"], s["d"], hour, F.coalesce(s["mi"], F.lit(0)), F.lit(0))
        return stamp - F.make_dt_interval(F.lit(0), F.lit(0), F.coalesce(s["off"], F.lit(0)))

    # ordinal endings would be words of their own
    tokens = F.regexp_extract_all(F.regexp_replace(t, r"(?<=\d)(?:st|nd|rd|th)\b", " "), F.lit(_DATE_TOKENS), F.lit(0))
    return TX.let(F.aggregate(tokens, start, step), made)


def published_time(nodes: Column | str) -> Column:
    """E10 cascade: first ``time`` (its datetime attribute), first ``div.timestamp``, the last parsable
    ``div`` with class ~createddate, the last parsable ``span`` inside a ``div`` with class ~heading."""
    n = F.col(nodes) if isinstance(nodes, str) else nodes
    times = nodes_with_tag(n, "time")
    first_time = F.when(F.size(times) > 0, parse_fuzzy_datetime(F.element_at(times, 1)["dt"]))
    stamps = nodes_with_tag(n, "div", cls_token="timestamp")
    first_stamp = F.when(F.size(stamps) > 0, parse_fuzzy_datetime(TX.clean_html_text(node_text(n, F.element_at(stamps, 1)))))

    def last_parsable(selected: Column) -> Column:
        parsed = F.filter(F.transform(selected, lambda x: parse_fuzzy_datetime(TX.clean_html_text(node_text(n, x)))), lambda v: v.isNotNull())
        return F.when(F.size(parsed) > 0, F.element_at(parsed, -1))

    created = last_parsable(nodes_with_tag(n, "div", cls_contains="createddate"))
    headings = nodes_with_tag(n, "div", cls_contains="heading")
    spans = TX.let(headings, lambda sections: F.filter(nodes_with_tag(n, "span"), lambda x: _inside(sections, x)))
    return F.coalesce(first_time, first_stamp, created, last_parsable(spans))


def extract_articles(parsed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """E7-E10 per article page: (id, url, heading, text, datetime, error), and ``newssite`` if the pages
    have one (joined from the sites table).

    Pages without headline are dropped (E7), 'Archive' headlines are dropped (E8); a page without
    body text, or one that could not be parsed, is kept with ``error`` set instead of stopping the job.
    """
    out = parsed.select(
        id_col, url_col,
        headline("nodes").alias("heading"),
        body_text("nodes").alias("text"),
        published_time("nodes").alias("datetime"),
        F.col("parse_error").alias("error"),
        *[c for c in ("newssite",) if c in parsed.columns],
    )
    out = out.where(F.col("error").isNotNull() | (F.col("heading").isNotNull() & not_archive(F.col("heading"))))
    return out.withColumn("error", F.coalesce("error", F.when(F.col("text").isNull(), F.lit("no text found"))))


def assemble_articles(articles: DataFrame, key: str = "url", order: str = "page_id") -> DataFrame:
    """One row per URL, the latest arrival wins (max_by over the arrival order)."""
    cols = [c for c in articles.columns if c != key]
    best = articles.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
    return best.select(key, "_r.*")


def new_links(links: DataFrame, store: DataFrame, key: str = "url") -> DataFrame:
    """Links not in the store of known URLs: one anti join, whose strategy AQE picks from the
    measured sizes; the links (and the page parse below them) are computed once."""
    return links.join(store.select(key).distinct(), on=key, how="left_anti")


# ---------------------------------------------------------------- readings text

def weather_fields(col: Column | str, metrics: Sequence[str] = L.WEATHER_METRICS) -> Column:
    """Per metric ``Name: <value> <unit>`` -> array<struct<metric, value, unit>> (unit may be '').

    A metric that the text does not name has a NULL value.
    """
    t = F.col(col) if isinstance(col, str) else col
    items = []
    for m in metrics:
        rx = m + r":\s*(\d+\.?\d*)\s*([a-z%][a-z/%]*)?"
        items.append(F.struct(F.lit(m).alias("metric"), F.regexp_extract(t, rx, 1).try_cast("double").alias("value"),
                              F.regexp_extract(t, rx, 2).alias("unit")))
    return F.array(*items)


#: Units a metric may have in the wide row; '' is a value without a unit.
METRIC_UNITS = {"Wind": ("km/h", "mph"), "Humidity": ("%",), "Precipitation": ("mm", "in"), "Visibility": ("km", "mi"), "UV index": ("", "h")}


def weather_columns(long: DataFrame, id_col: str, metrics: Sequence[str] = L.WEATHER_METRICS) -> DataFrame:
    """E14 wide form: one column per metric named ``"<metric> in <unit>"`` (just ``<metric>`` without a
    unit). The pivot values are the (small) distinct metric/unit names found, so one extra job
    lists them; the metric list bounds their number. ``reading_card`` has a given list of units and no such job."""
    named = long.where(F.col("metric").isin(*metrics)).withColumn(
        "_name", F.when(F.col("unit") != "", F.concat(F.col("metric"), F.lit(" in "), F.col("unit"))).otherwise(F.col("metric")))
    return named.groupBy(id_col).pivot("_name").agg(F.first("value"))


def reading_card(text: Column | str, day: Column | str, start: str = L.READING_START, end: str = L.READING_END, zone: str = "HKT",
                 units: Mapping[str, Sequence[str]] = METRIC_UNITS) -> list[Column]:
    """The columns of a reading card: section, time, condition, and ``"<metric> in <unit>"`` (``<metric>``
    without a unit) for the metrics and units listed, so that no job has to list what occurs.

    A cursor goes from marker to marker: the section begins after ``start`` and ends with ``end``; its first
    clock before ``zone`` gives the time on ``day``; the text from there to the first digit is the
    condition; a metric's value and unit are between its name and the next capital letter. What is
    missing is NULL, also where the section itself is; ``other_units`` has the metrics whose unit is not listed.
    """
    t, d = (F.col(c) if isinstance(c, str) else c for c in (text, day))

    def first(c: Column, rx: str, g: int = 1) -> Column:
        return F.when(c.rlike(rx), F.regexp_extract(c, rx, g))

    clock = r"(\d{1,2}:\d{2})\s*" + zone

    def card(section: Column) -> Column:
        rest = first(section, rf"(?s){clock}(.*)$", 2)

        def fields(rest: Column) -> Column:
            pieces = {m: F.regexp_extract(rest, rf"{m}:\s*([^A-Z]*)", 1) for m in units}
            value = {m: F.regexp_extract(p, r"\d+\.?\d*", 0).try_cast("double") for m, p in pieces.items()}
            unit = {m: F.regexp_extract(p, r"[a-z%][a-z/%]*", 0) for m, p in pieces.items()}
            listed = [F.when(unit[m] == u, value[m]).alias(f"{m} in {u}" if u else m) for m, us in units.items() for u in us]
            others = F.filter(F.array(*[F.when(value[m].isNotNull() & ~unit[m].isin(*us), F.lit(m)) for m, us in units.items()]), lambda m: m.isNotNull())
            time = F.try_to_timestamp(F.concat_ws(" ", F.date_format(d, "yyyy-MM-dd"), first(section, clock)), F.lit("yyyy-MM-dd H:mm")).cast("timestamp_ntz")
            return F.struct(section.alias("section"), time.alias("time"), first(rest, r"(?s)^(\D*)\d").alias("condition"), *listed, others.alias("other_units"))

        return TX.let(rest, fields)

    whole = TX.let(first(t, rf"(?s){start}(.*?{end})"), card)
    names = ["section", "time", "condition", *[f"{m} in {u}" if u else m for m, us in units.items() for u in us], "other_units"]
    return [whole.getField(n).alias(n) for n in names]


def index_quote(nodes: Column | str, name: tuple[str, str], value: tuple[str, str], read_at: Column | str) -> list[Column]:
    """(datetime, index_name, index_value) of a quote page: the last texts of the (tag, class) selectors,
    the value with its thousands separators read, and the time of the reading."""
    n, at = (F.col(c) if isinstance(c, str) else c for c in (nodes, read_at))

    def last(tag: str, cls: str) -> Column:
        return TX.let(nodes_with_tag(n, tag, cls_token=cls), lambda found: F.when(F.size(found) > 0, TX.clean_html_text(node_text(n, F.element_at(found, -1)))))

    return [at.alias("datetime"), last(*name).alias("index_name"), TX.parse_grouped_number(last(*value)).alias("index_value")]


def last_text(nodes: Column | str, tag: str, cls_contains: str | None = None) -> Column:
    """Clean text of the last node matching the selector (NULL when none)."""
    n = F.col(nodes) if isinstance(nodes, str) else nodes
    sel = nodes_with_tag(n, tag, cls_contains=cls_contains)
    return F.when(F.size(sel) > 0, TX.clean_html_text(node_text(n, F.element_at(sel, -1))))
