"""Enrichment (N1-N9): key terms, lexicon sentiment, category similarity, entities.

Pretrained taggers / scorers are re-aimed as lexicon tables joined to the token table;
the contract is the decision rule, not a model's scores.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailywire.functions import lexicons as L
from dailywire.functions import text as TX
from dailywire.operators.clean import drop_duplicates_first
from dailywire.operators.tokens import ROW, inline_lookup, one_per_word, per_document, row_key
from dailywire.session import broadcast_if_small

def _nonempty_blank_tokens(col: Column | str) -> Column:
    return F.filter(TX.blank_tokens(col), lambda x: x != "")


# Scores are summed exactly as decimals: a polarity of exactly 0, a tie between valence shares and
# the "below zero after penalties" test must not depend on the order in which an engine adds.
SCORE_DEC = "decimal(18,6)"
SUM_DEC = "decimal(38,6)"


def polarity_parts(col: Column | str, lexicon: Mapping[str, float] = L.DEMO_POLARITY) -> Column:
    """N2 pieces for a literal lexicon (scanned linearly per token; a table of any size goes through
    ``lexicon_polarity`` / ``score_documents``): struct(s = exact sum of listed scores, n = how many). Map-side only."""
    m = F.create_map(*[x for k, v in lexicon.items() for x in (F.lit(k), F.lit(str(v)).cast(SCORE_DEC))])
    scores = F.filter(F.transform(_nonempty_blank_tokens(col), lambda t: F.try_element_at(m, t)), lambda s: s.isNotNull())

    def parts(sc: Column) -> Column:
        total = F.aggregate(sc, F.lit(0).cast(SUM_DEC), lambda acc, s: (acc + s).cast(SUM_DEC))
        return F.struct(total.alias("s"), F.size(sc).alias("n"))

    return TX.let(scores, parts)


def polarity_value(parts: Column) -> Column:
    """Mean score as double (0 when no token is listed); its sign is the sign of the exact sum."""
    return F.when(parts["n"] > 0, parts["s"].cast("double") / parts["n"]).otherwise(F.lit(0.0))


def polarity_literal(col: Column | str, lexicon: Mapping[str, float] = L.DEMO_POLARITY) -> Column:
    """N2 for a small literal lexicon: mean score of the listed tokens, 0 when none is listed."""
    return polarity_value(polarity_parts(col, lexicon))


def negative_flag_col(parts: Column, processed: Column | str, terms: Sequence[str] = L.NEGATIVE_TERMS,
                      penalty: float = L.NEGATIVE_TERM_PENALTY) -> Column:
    """Polarity minus ``penalty`` per negative-term occurrence; 1 if below 0, else NULL.

    Decided exactly on the parts: mean - penalty * k < 0  <=>  sum - penalty * k * n < 0 (n > 0).
    """
    k = TX.term_occurrences(processed, terms)
    below = F.when(parts["n"] > 0, parts["s"] - F.lit(str(penalty)).cast(SCORE_DEC) * k * parts["n"] < 0).otherwise(k > 0)
    return F.when(below, F.lit(1))


def lexicon_polarity(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame,
                     out: str = "polarity", word_col: str = "word", score_col: str = "score") -> DataFrame:
    """N2 over a lexicon table: (id, polarity) = mean score of the listed tokens, 0 if none is listed."""
    per = per_document(docs, id_col, TX.blank_tokens(text_col), lexicon.select(word_col, score_col),
                       [F.struct(F.sum(F.col(score_col).cast(SCORE_DEC)).alias("s"), F.count(score_col).alias("n")).alias("_p")],
                       word_col)
    return per.select(id_col, polarity_value(F.col("_p")).alias(out))


def valence_class(docs: DataFrame, id_col: str, text_col: str, valence: DataFrame,
                  word_col: str = "word", score_col: str = "score") -> DataFrame:
    """negative/neutral/positive shares from a valence lexicon, label by argmax (ties: neg, neu, pos).

    pos = sum(v+1) over v>0, neg = sum(|v|+1) over v<0, neu = tokens with v=0 (unlisted tokens count as 0).
    Output: (id, valence_neg, valence_neu, valence_pos, polarity_vader).
    """
    j = per_document(docs, id_col, TX.blank_tokens(text_col), valence.select(word_col, score_col),
                     _valence_aggs(F.col(score_col)), word_col)
    return _valence_columns(j).drop("_pos", "_neg", "_nz", "_n")


def _valence_aggs(v: Column) -> list[Column]:
    v = v.cast(SCORE_DEC)
    return [
        F.sum(F.when(v > 0, v + 1)).alias("_pos"),
        F.sum(F.when(v < 0, F.abs(v) + 1)).alias("_neg"),
        F.count(F.when(v != 0, 1)).alias("_nz"),
        F.count("token").alias("_n"),
    ]


def _valence_columns(j: DataFrame) -> DataFrame:
    """Shares as doubles; the label compares the exact decimal sums (same order as the shares)."""
    pos = F.coalesce(F.col("_pos"), F.lit(0).cast(SUM_DEC))
    neg = F.coalesce(F.col("_neg"), F.lit(0).cast(SUM_DEC))
    neu = (F.col("_n") - F.col("_nz")).cast(SUM_DEC)
    total = pos + neg + neu
    share = lambda x: F.when(total > 0, x.cast("double") / total.cast("double")).otherwise(F.lit(0.0))
    j = j.withColumns({"valence_neg": share(neg), "valence_neu": share(neu), "valence_pos": share(pos)})
    label = F.when((neg >= neu) & (neg >= pos), "negative").when(neu >= pos, "neutral").otherwise("positive")
    return j.withColumn("polarity_vader", label)


def prepare_sentiment_dictionary(raw: DataFrame, lemmas: DataFrame | None = None,
                                 categories: Sequence[str] = L.SENTIMENT_CATEGORIES, word_col: str = "word",
                                 order: Column | None = None) -> DataFrame:
    """Lower-case words, verb lemma from a (word, lemma) table, flags to boolean, keep flagged, first per word.

    "First" follows ``order``; give ``sources.readers.file_position()`` for a dictionary read from files
    (Spark reads several files in any order), else the order of the rows in the input.
    """
    d = raw.withColumn("_order", F.monotonically_increasing_id() if order is None else order)
    d = d.withColumns({c: F.col(c).cast("int").cast("boolean") for c in categories})
    d = d.where(F.greatest(*[F.col(c).cast("int") for c in categories]) == 1)
    d = d.withColumn(word_col, F.lower(word_col))
    if lemmas is not None:
        lem = broadcast_if_small(one_per_word(lemmas.select(F.col("word").alias("_w"), F.col("lemma").alias("_l")), "_w"))
        d = d.join(lem, d[word_col] == lem["_w"], "left").withColumn(word_col, F.coalesce("_l", word_col)).drop("_w", "_l")
    return drop_duplicates_first(d, [word_col], ["_order"]).drop("_order")


def category_word_counts(docs: DataFrame, id_col: str, text_col: str, dictionary: DataFrame,
                         categories: Sequence[str] = L.SENTIMENT_CATEGORIES, word_col: str = "word",
                         with_jaccard: bool = True) -> DataFrame:
    """N7 (+ N8): per document and category the count of the category's words (with repeats), and
    ``count / (category vocabulary size + whitespace token count - count)``.
    Output: (id, <cat>_count..., <cat>_jacsim...).
    """
    dic = dictionary.select(word_col, *[F.col(c).cast("boolean").alias(c) for c in categories])
    carry = {"_ws": TX.whitespace_token_count(text_col)} if with_jaccard else {}
    out = per_document(docs, id_col, TX.word_tokens(text_col), dic,
                       [F.count(F.when(F.col(c), 1)).alias(f"{c}_count") for c in categories], word_col, carry)
    if not with_jaccard:
        return out
    # category vocabulary sizes: one aggregated row, broadcast
    sizes = dic.agg(*[F.count(F.when(F.col(c), 1)).alias(f"_{c}_size") for c in categories])
    out = out.crossJoin(F.broadcast(sizes))
    for c in categories:
        cnt = F.col(f"{c}_count").cast("double")
        out = out.withColumn(f"{c}_jacsim", F.try_divide(cnt, F.col(f"_{c}_size") + F.col("_ws") - cnt))
    return out.drop("_ws", *[f"_{c}_size" for c in categories])


def first_entity(docs: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame,
                 columns: Sequence[tuple[str, str]] = L.ENTITY_COLUMNS,
                 term_col: str = "term", label_col: str = "label") -> DataFrame:
    """The document's first entity (by token position, the longest of those that start there); its
    text fills the column of its label. Entities may have several words.

    Matching follows the phrases word by word only where one can start: a token is looked up among the
    first words, which tell how far their phrases reach; only hits form the runs of tokens up to that
    length, and these are looked up among the phrases. Both lookups are size-checked broadcasts, else shuffle
    joins, so the gazetteer may be of any size; small tables are looked up within the document's token array. At most one of the output columns is non-null per document.
    Output: (id, company, country, ...), a row for each input row.
    """
    words = F.filter(F.split(F.col(term_col), " "), lambda w: w != "")
    gz = gazetteer.where(F.col(term_col).isNotNull()).select(words.alias("_w"), F.col(label_col).alias("_label")).where(F.size("_w") > 0)
    gz = one_per_word(gz.select(F.array_join("_w", " ").alias("_phrase"), "_w", "_label"), "_phrase")
    starts = gz.groupBy(F.col("_w")[0].alias("_start")).agg(F.max(F.size("_w")).alias("_reach"))
    reach_of, label_of = inline_lookup(starts, "_start"), inline_lookup(gz.select("_phrase", "_label"), "_phrase")
    if reach_of is not None and label_of is not None:
        entity = TX.let(_nonempty_blank_tokens(text_col), lambda toks: _first_phrase(toks, reach_of, label_of))
        out = docs.select(F.col(id_col), entity.alias("_first"))
        return out.select(id_col, *[F.when(F.col("_first.l") == lab, F.col("_first.t")).alias(col) for lab, col in columns])
    longest = gz.agg(F.max(F.size("_w"))).first()[0] or 1
    pre = docs.select(row_key().alias(ROW), F.col(id_col), _nonempty_blank_tokens(text_col).alias("_toks"))
    toks = pre.select(ROW, id_col, "_toks", F.posexplode_outer("_toks").alias("pos", "token"))
    toks = toks.select(ROW, id_col, "pos", "token", F.slice("_toks", F.coalesce(F.col("pos"), F.lit(0)) + 1, longest).alias("_next"))
    hit = toks.join(broadcast_if_small(starts), F.col("token") == F.col("_start"), "left")
    runs = F.transform(F.sequence(F.lit(1), F.least(F.col("_reach"), F.size("_next"))), lambda n: F.array_join(F.slice("_next", F.lit(1), n), " "))
    hit = hit.select(ROW, id_col, "pos", F.posexplode_outer(F.when(F.col("_reach").isNotNull(), runs)).alias("_length", "_run"))
    found = hit.join(broadcast_if_small(gz.select("_phrase", "_label")), F.col("_run") == F.col("_phrase"), "left")
    place = F.when(F.col("_label").isNotNull(), F.struct("pos", -F.col("_length")))
    first = found.groupBy(ROW).agg(F.first(id_col).alias(id_col), F.min_by(F.struct(F.col("_run").alias("t"), F.col("_label").alias("l")), place).alias("_first"))
    out = first.withColumns({col: F.when(F.col("_first.l") == lab, F.col("_first.t")) for lab, col in columns})
    return out.drop(ROW, "_first")


def _first_phrase(toks: Column, reach_of: Callable[[Column], Column], label_of: Callable[[Column], Column]) -> Column:
    """(t, l): the first phrase in ``toks`` and its label, the longest of those that start there."""
    def longest_from(i: Column, reach: Column) -> Column:
        run = lambda n: TX.let(F.array_join(F.slice(toks, i + 1, n), " "), lambda r: F.struct(r.alias("t"), label_of(r)["_label"].alias("l")))
        runs = F.transform(F.sequence(F.least(reach, F.size(toks) - i), F.lit(1), F.lit(-1)), run)
        return F.get(F.filter(runs, lambda x: x["l"].isNotNull()), F.lit(0))

    starts = F.filter(F.transform(toks, lambda t, i: F.struct(i.alias("i"), reach_of(t)["_reach"].alias("r"))), lambda x: x["r"].isNotNull())
    return F.get(F.filter(F.transform(starts, lambda x: longest_from(x["i"], x["r"])), lambda x: x.isNotNull()), F.lit(0))


def score_documents(docs: DataFrame, id_col: str, text_col: str, polarity: DataFrame | None = None,
                    valence: DataFrame | None = None, gazetteer: DataFrame | None = None,
                    negative_terms: Sequence[str] = L.NEGATIVE_TERMS, penalty: float = L.NEGATIVE_TERM_PENALTY,
                    entity_columns: Sequence[tuple[str, str]] = L.ENTITY_COLUMNS, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """N2 + N3 + N5 + N9 in one pass: one explode of the blank-split tokens, one left join to the
    combined lexicon (word -> polarity score, valence, entity label; broadcast after a row check),
    one group by document with conditional aggregates. Same results as the separate operators.

    Lexicons: polarity (word, score), valence (word, score), gazetteer (term, label) of single words (phrases
    need ``first_entity``), each reduced to one row per word. ``carry`` are further columns, computed on the document row.
    """
    parts = []
    if polarity is not None:
        parts.append(one_per_word(polarity.select(F.col("word"), F.col("score").alias("_pol"))))
    if valence is not None:
        parts.append(one_per_word(valence.select(F.col("word"), F.col("score").alias("_val"))))
    if gazetteer is not None:
        if not gazetteer.where("term like '% %'").isEmpty():
            raise ValueError("entities of several words: use first_entity")
        parts.append(one_per_word(gazetteer.select(F.col("term").alias("word"), F.col("label").alias("_lab"))))
    if not parts:
        raise ValueError("give at least one lexicon")
    lex = parts[0]
    for p in parts[1:]:
        lex = lex.join(p, "word", "full")  # small tables keyed by word
    cols = set(lex.columns)
    aggs = [] if "_val" in cols else [F.count("token").alias("_n")]
    if "_pol" in cols:
        aggs.append(F.struct(F.sum(F.col("_pol").cast(SCORE_DEC)).alias("s"), F.count("_pol").alias("n")).alias("_pp"))
    if "_val" in cols:
        aggs += _valence_aggs(F.col("_val"))
    if "_lab" in cols:
        aggs.append(F.min_by(F.struct(F.col("token").alias("t"), F.col("_lab").alias("l")),
                             F.when(F.col("_lab").isNotNull(), F.col("pos"))).alias("_first"))
    carry = {**(carry or {}), "_negterms": TX.term_occurrences(text_col, negative_terms)}
    out = per_document(docs, id_col, TX.blank_tokens(text_col), lex, aggs, "word", carry)
    if "_pol" in cols:
        pp, k = F.col("_pp"), F.col("_negterms")
        out = out.withColumn("polarity", polarity_value(pp))
        below = F.when(pp["n"] > 0, pp["s"] - F.lit(str(penalty)).cast(SCORE_DEC) * k * pp["n"] < 0).otherwise(k > 0)
        out = out.withColumn("negative_flag", F.when(below, F.lit(1)))
    if "_val" in cols:
        out = _valence_columns(out)
    if "_lab" in cols:
        out = out.withColumns({col: F.when(F.col("_first.l") == lab, F.col("_first.t")) for lab, col in entity_columns})
    return out.drop(*[c for c in out.columns if c.startswith("_")])
