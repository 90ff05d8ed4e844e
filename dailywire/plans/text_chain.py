"""The text chain that every enrichment and corpus query starts from (T1 -> T2 -> T3 -> T4), and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dailywire.operators.text import preprocess
from dailywire.plans import sqltext as S
from dailywire.plans.driver_words import STOPWORDS
from dailywire.sources.readers import text_table

# Tag table of the registered runs (words that occur in the synthetic prose).
DRIVER_TAG_LEXICON = [
    # word, tag, pos, lemma, plural
    ("the", "DT", "DET", "the", None),
    ("of", "IN", "ADP", "of", None),
    ("and", "CC", "CCONJ", "and", None),
    ("it", "PRP", "PRON", "it", None),
    ("was", "VBD", "AUX", "be", None),
    ("is", "VBZ", "AUX", "be", None),
    ("ing", "VBG", "VERB", "in", None),
    ("thatin", "NN", "NOUN", "thatin", None),
    ("rewh", "NNS", "NOUN", "rewh", None),
    ("ononst", "NN", "NOUN", "ononst", "ononsts"),
    ("orantion", "NN", "NOUN", "orant", None),
    ("hehely", "RB", "ADV", "hehe", None),
    ("les", "DT", "DET", "le", None),
    ("der", "ART", "DET", "der", None),
    ("que", "CS", "SCONJ", "que", None),
]
LEXICON_COLS = ["word", "tag", "pos", "lemma", "plural"]


def lexicon_df(spark: SparkSession, rows, cols) -> DataFrame:
    types = {"word": "string", "tag": "string", "pos": "string", "lemma": "string", "plural": "string", "term": "string",
             "label": "string", "score": "double"}
    schema = ", ".join(f"{c} {types.get(c, 'boolean')}" for c in cols)
    return spark.createDataFrame(rows, schema)


def tags(spark: SparkSession) -> DataFrame:
    return lexicon_df(spark, DRIVER_TAG_LEXICON, LEXICON_COLS)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, p): the cleaned text of every document."""
    docs = text_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return preprocess(docs, "doc_id", "text", STOPWORDS, tags(spark), out="p").select("doc_id", "p")


def t3_ctes(noun_mode: str = "lemma") -> str:
    """CTEs up to n (doc_id, normalized)."""
    lex = S.values_table(DRIVER_TAG_LEXICON, LEXICON_COLS, "lx")
    shared = ("list_sum(list_transform(list_distinct(list_filter(string_split(lower(word), ''), lambda c: c <> '')), "
              "lambda c: least(length(lower(word)) - length(replace(lower(word), c, '')), "
              "length(lower(coalesce(lemma, word))) - length(replace(lower(coalesce(lemma, word)), c, '')))))")
    noun = "lower(coalesce(lemma, word))" if noun_mode == "lemma" else "CASE WHEN plural IS NULL THEN lower(word) ELSE lower(plural) END"
    return f"""c_lex AS (SELECT lower(word) AS word, CASE WHEN tag IN ('NN', 'NE') THEN {noun}
          WHEN pos IN ('DET', 'ADP', 'CONJ', 'PRON') THEN NULL
          WHEN {shared} >= length(word) - 1 THEN lower(coalesce(lemma, word)) ELSE lower(word) END AS out FROM {lex}),
    c_s AS (SELECT doc_id, {S.strip_special(S.expand_contractions('text'))} AS s FROM documents),
    c_tk AS (SELECT doc_id, list_filter(regexp_split_to_array(s, '\\s+'), lambda w: w <> '') AS tk FROM c_s),
    c_tt AS (SELECT doc_id, lower(unnest(tk)) AS token, generate_subscripts(tk, 1) AS pos FROM c_tk),
    c_r AS (SELECT doc_id, pos, CASE WHEN c_lex.word IS NULL THEN token ELSE c_lex.out END AS piece FROM c_tt LEFT JOIN c_lex ON c_tt.token = c_lex.word),
    c_g AS (SELECT doc_id, string_agg(' ' || piece, '' ORDER BY pos) AS normalized FROM c_r WHERE piece IS NOT NULL GROUP BY doc_id),
    c_n AS (SELECT d.doc_id, coalesce(c_g.normalized, '') AS normalized FROM documents d LEFT JOIN c_g USING (doc_id))"""


T3_CTES = t3_ctes()
PROCESSED_CTES = f"{T3_CTES}, p AS (SELECT doc_id, {S.remove_stopwords('normalized', STOPWORDS)} AS p FROM c_n)"
