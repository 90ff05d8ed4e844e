"""Text cleaning and enrichment queries over ``documents``."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession

from dailywire.functions import lexicons as L
from dailywire.functions import text as TX
from dailywire.operators import enrich as N
from dailywire.operators import text as TO
from dailywire.plans import sqltext as S
from dailywire.plans.daily_plans import DRIVER_KEY_TERMS, DRIVER_NEGATIVE_TERMS, DRIVER_POLARITY
from dailywire.plans.driver_words import STOPWORDS
from dailywire.plans.registry import query, rounded
from dailywire.plans.text_chain import DRIVER_TAG_LEXICON, LEXICON_COLS, PROCESSED_CTES, T3_CTES, lexicon_df, processed
from dailywire.sources.readers import table, text_table

# Lexicon tables for the registered runs (words that occur in the synthetic prose).
DRIVER_VALENCE = {"the": 0.0, "rewh": -1.5, "thatin": 2.0, "orre": 1.2, "hehely": -0.8, "le": 0.5, "der": -2.1, "que": 0.0}
DRIVER_CATEGORIES = [
    # word, negative, positive, uncertainty, litigious, constraining
    ("rewh", True, False, False, False, False),
    ("orre", True, False, True, False, False),
    ("thatin", False, True, False, False, False),
    ("ononst", False, True, False, True, False),
    ("hehely", False, False, True, False, True),
    ("inoran", False, False, False, True, False),
    ("der", True, False, False, False, True),
    ("que", False, True, False, False, False),
]
DRIVER_GAZETTEER = [("rewh", "ORG"), ("thon", "GPE"), ("thth", "DATE"), ("orre", "EVENT"), ("hehely", "PERSON"), ("der", "ORG"), ("que", "GPE")]
# phrases that overlap: the first position decides, then the longest phrase
DRIVER_PHRASES = [*DRIVER_GAZETTEER, ("anea", "ORG"), ("anea eriner", "GPE"), ("anea eriner thanea", "EVENT"), ("eriner thanea", "PERSON"),
                  ("thanedble anea eriner", "ORG"), ("thanedble", "DATE"), ("attion thanedble", "GPE"), ("onbleea anon", "EVENT"), ("ntre onbleea rewh", "GPE")]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_table(spark, sf_dir, "documents", ["doc_id", "text"])


@query("E11_clean_html_text", f"SELECT doc_id, {S.clean_html_text('text')} AS cleaned FROM documents")
def e11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", TX.clean_html_text("text").alias("cleaned"))


@query("E6_clean_link", f"SELECT page_id, {S.replace_chain('url', L.LINK_REPLACEMENTS)} AS link FROM pages")
def e6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", TX.clean_link("url").alias("link"))


@query("T1_expand_contractions", f"SELECT doc_id, {S.expand_contractions('text')} AS expanded FROM documents")
def t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", TX.expand_contractions("text").alias("expanded"))


@query("T2_strip_special", f"SELECT doc_id, {S.strip_special('text')} AS stripped FROM documents")
def t2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", TX.strip_special("text").alias("stripped"))


@query("T3_tokenize_pos_lemma", f"WITH {T3_CTES} SELECT doc_id, normalized FROM c_n")
def t3(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _docs(spark, sf_dir).select("doc_id", TX.strip_special(TX.expand_contractions("text")).alias("s"))
    lex = lexicon_df(spark, DRIVER_TAG_LEXICON, LEXICON_COLS)
    return TO.tokenize_pos_lemma(staged, "doc_id", "s", lex, blank=" ").select("doc_id", "normalized")


@query("T4_remove_stopwords", f"SELECT doc_id, {S.remove_stopwords('text', STOPWORDS)} AS cleaned FROM documents")
def t4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", TX.remove_stopwords("text", STOPWORDS).alias("cleaned"))


@query(
    "T5_remove_stopwords_cased",
    f"SELECT doc_id, {S.remove_stopwords('text', L.STOPWORDS_FIRST_100[:50], lower=False)} AS cleaned FROM documents",
)
def t5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", TX.remove_stopwords("text", L.STOPWORDS_FIRST_100, lower=False, limit=50).alias("cleaned"))


@query("T6_preprocess_text", f"WITH {PROCESSED_CTES} SELECT doc_id, p AS processed_text FROM p")
def t6(spark: SparkSession, sf_dir: str) -> DataFrame:
    lex = lexicon_df(spark, DRIVER_TAG_LEXICON, LEXICON_COLS)
    return TO.preprocess(_docs(spark, sf_dir), "doc_id", "text", STOPWORDS, lex).select("doc_id", "processed_text")


def _without_accents(s: str) -> str:
    """Canonical decomposition without its combining marks; Spark has no such function."""
    return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))


@query("T7_map_text_udf", "SELECT doc_id, strip_accents(text) AS mapped FROM documents")
def t7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user Python function (accents off every letter) through an Arrow-batched pandas UDF."""
    return _docs(spark, sf_dir).select("doc_id", TO.map_text("text", _without_accents).alias("mapped"))


@query("N1_keyterm_flag", f"WITH {PROCESSED_CTES} SELECT doc_id, {S.keyterm_flag('p', DRIVER_KEY_TERMS)} AS covid_flag FROM p")
def n1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir).select("doc_id", TX.keyterm_flag("p", DRIVER_KEY_TERMS).alias("covid_flag"))


def _polarity_sql(out: str = "polarity") -> str:
    lex = S.values_table(list(DRIVER_POLARITY.items()), ["word", "score"], "lx")
    return f"""WITH {PROCESSED_CTES},
    t AS (SELECT doc_id, unnest(string_split(p, ' ')) AS w FROM p),
    s AS (SELECT doc_id, CAST(sum(CAST(score AS DECIMAL(18, 6))) AS DOUBLE) / count(score) AS pol FROM t JOIN {lex} ON t.w = lx.word GROUP BY doc_id),
    r AS (SELECT p.doc_id, p.p, coalesce(s.pol, 0.0) AS {out} FROM p LEFT JOIN s USING (doc_id))"""


def _polarity_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    lex = lexicon_df(spark, list(DRIVER_POLARITY.items()), ["word", "score"])
    return N.lexicon_polarity(processed(spark, sf_dir), "doc_id", "p", lex)


@query("N2_lexicon_polarity", _polarity_sql() + " SELECT doc_id, round(polarity, 6) AS polarity FROM r")
def n2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_polarity_df(spark, sf_dir).select("doc_id", "polarity"))


@query(
    "N3_negative_flag",
    f"WITH {PROCESSED_CTES} SELECT doc_id, {S.negative_flag('p', DRIVER_POLARITY, DRIVER_NEGATIVE_TERMS)} AS negative_flag FROM p",
)
def n3(spark: SparkSession, sf_dir: str) -> DataFrame:
    lex = lexicon_df(spark, list(DRIVER_POLARITY.items()), ["word", "score"])
    scored = N.score_documents(processed(spark, sf_dir), "doc_id", "p", polarity=lex, negative_terms=DRIVER_NEGATIVE_TERMS)
    return scored.select("doc_id", "negative_flag")


@query(
    "N4_polarity_label",
    _polarity_sql()
    + " SELECT doc_id, CASE WHEN polarity < 0 THEN 'negative' WHEN polarity = 0 THEN 'neutral' WHEN polarity > 0 THEN 'positive' END AS polarity_textblob FROM r",
)
def n4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _polarity_df(spark, sf_dir).select("doc_id", TX.polarity_label("polarity").alias("polarity_textblob"))


def _valence_sql() -> str:
    lex = S.values_table(list(DRIVER_VALENCE.items()), ["word", "score"], "lx")
    return f"""WITH {PROCESSED_CTES},
    t AS (SELECT doc_id, unnest(string_split(p, ' ')) AS w FROM p),
    s AS (SELECT doc_id, sum(CASE WHEN sc > 0 THEN sc + 1 END) AS pos_s, sum(CASE WHEN sc < 0 THEN abs(sc) + 1 END) AS neg_s,
          count(CASE WHEN sc <> 0 THEN 1 END) AS nz FROM (SELECT t.doc_id, CAST(score AS DECIMAL(18, 6)) AS sc FROM t JOIN {lex} ON t.w = lx.word) GROUP BY doc_id),
    j AS (SELECT p.doc_id, coalesce(pos_s, 0) AS pos_s, coalesce(neg_s, 0) AS neg_s,
          CAST(len(list_filter(string_split(p.p, ' '), lambda w: w <> '')) - coalesce(nz, 0) AS DECIMAL(38, 6)) AS neu_s FROM p LEFT JOIN s USING (doc_id)),
    k AS (SELECT doc_id, pos_s + neg_s + neu_s AS tot, * FROM j),
    v AS (SELECT doc_id, pos_s, neg_s, neu_s,
          CASE WHEN tot > 0 THEN CAST(neg_s AS DOUBLE) / CAST(tot AS DOUBLE) ELSE 0.0 END AS valence_neg,
          CASE WHEN tot > 0 THEN CAST(neu_s AS DOUBLE) / CAST(tot AS DOUBLE) ELSE 0.0 END AS valence_neu,
          CASE WHEN tot > 0 THEN CAST(pos_s AS DOUBLE) / CAST(tot AS DOUBLE) ELSE 0.0 END AS valence_pos FROM k)
    SELECT doc_id, round(valence_neg, 6) AS valence_neg, round(valence_neu, 6) AS valence_neu, round(valence_pos, 6) AS valence_pos,
      CASE WHEN neg_s >= neu_s AND neg_s >= pos_s THEN 'negative' WHEN neu_s >= pos_s THEN 'neutral' ELSE 'positive' END AS polarity_vader
    FROM v"""


@query("N5_valence_class", _valence_sql())
def n5(spark: SparkSession, sf_dir: str) -> DataFrame:
    lex = lexicon_df(spark, list(DRIVER_VALENCE.items()), ["word", "score"])
    out = N.valence_class(processed(spark, sf_dir), "doc_id", "p", lex)
    return rounded(out.select("doc_id", "valence_neg", "valence_neu", "valence_pos", "polarity_vader"))


def _categories_sql(jaccard: bool) -> str:
    cats = L.SENTIMENT_CATEGORIES
    dic = S.values_table(DRIVER_CATEGORIES, ["word", *cats], "dx")
    counts = ", ".join(f"count(CASE WHEN {c} THEN 1 END) AS {c}_count" for c in cats)
    sizes = ", ".join(f"count(CASE WHEN {c} THEN 1 END) AS {c}_size" for c in cats)
    cols = ", ".join(f"coalesce(s.{c}_count, 0) AS {c}_count" for c in cats)
    base = f"""WITH {PROCESSED_CTES}, dic AS (SELECT * FROM {dic}),
    t AS (SELECT doc_id, unnest({S.word_tokens('p')}) AS w FROM p),
    s AS (SELECT doc_id, {counts} FROM t JOIN dic ON t.w = dic.word GROUP BY doc_id),
    z AS (SELECT {sizes} FROM dic),
    c AS (SELECT p.doc_id, {S.whitespace_token_count('p.p')} AS ws, {cols} FROM p LEFT JOIN s USING (doc_id))"""
    if not jaccard:
        return base + " SELECT doc_id, " + ", ".join(f"{c}_count" for c in cats) + " FROM c"
    jac = ", ".join(
        f"round(CASE WHEN ({c}_size + ws - {c}_count) = 0 THEN NULL ELSE {c}_count::DOUBLE / ({c}_size + ws - {c}_count) END, 6) AS {c}_jacsim"
        for c in cats
    )
    return base + f" SELECT doc_id, {jac} FROM c, z"


def _categories_df(spark: SparkSession, sf_dir: str, jaccard: bool) -> DataFrame:
    dic = lexicon_df(spark, DRIVER_CATEGORIES, ["word", *L.SENTIMENT_CATEGORIES])
    return N.category_word_counts(processed(spark, sf_dir), "doc_id", "p", dic, with_jaccard=jaccard)


@query("N7_category_word_counts", _categories_sql(False))
def n7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _categories_df(spark, sf_dir, False).select("doc_id", *[f"{c}_count" for c in L.SENTIMENT_CATEGORIES])


@query("N8_category_jaccard", _categories_sql(True))
def n8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_categories_df(spark, sf_dir, True).select("doc_id", *[f"{c}_jacsim" for c in L.SENTIMENT_CATEGORIES]))


def _entity_sql() -> str:
    gz = S.values_table(DRIVER_PHRASES, ["term", "label"], "t2")
    cols = ", ".join(f"CASE WHEN f.label = '{lab}' THEN f.term END AS {col}" for lab, col in L.ENTITY_COLUMNS)
    longest = max(len(t.split()) for t, _ in DRIVER_PHRASES)
    runs = " UNION ALL ".join(f"SELECT doc_id, pos, {n} AS n, array_to_string(tk[pos:pos + {n - 1}], ' ') AS w FROM t WHERE pos + {n - 1} <= len(tk)" for n in range(1, longest + 1))
    return f"""WITH {PROCESSED_CTES},
    tl AS (SELECT doc_id, list_filter(string_split(p, ' '), lambda w: w <> '') AS tk FROM p),
    t AS (SELECT doc_id, tk, unnest(range(1, len(tk) + 1)) AS pos FROM tl),
    r AS ({runs}),
    m AS (SELECT doc_id, arg_min(t2.term, pos * {longest + 1} - n) AS term, arg_min(t2.label, pos * {longest + 1} - n) AS label FROM r JOIN {gz} ON r.w = t2.term GROUP BY doc_id)
    SELECT p.doc_id, {cols} FROM p LEFT JOIN m f USING (doc_id)"""


@query("N9_first_entity", _entity_sql())
def n9(spark: SparkSession, sf_dir: str) -> DataFrame:
    gz = lexicon_df(spark, DRIVER_PHRASES, ["term", "label"])
    out = N.first_entity(processed(spark, sf_dir), "doc_id", "p", gz)
    return out.select("doc_id", *[c for _, c in L.ENTITY_COLUMNS])
