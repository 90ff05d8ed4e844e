"""DataFrame-level text operators: T3 (tag / lemma lookup), T6 (full preprocessing), T7 (user function).

T1, T2, T4, T5 are column expressions in ``dailywire.functions.text``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailywire.functions import lexicons as L
from dailywire.functions import text as TX
from dailywire.operators.tokens import ROW, inline_lookup, lookup, one_per_word, row_key, token_table
from dailywire.session import broadcast_if_small


def shared_letters(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of the characters of ``a`` and ``b`` (``Counter(a) & Counter(b)``)."""
    def occurrences(s: Column, ch: Column) -> Column:
        return F.length(s) - F.length(F.replace(s, ch, F.lit("")))

    return F.aggregate(
        F.array_distinct(F.filter(F.split(a, "", -1), lambda ch: ch != "")),
        F.lit(0),
        lambda acc, ch: acc + F.least(occurrences(a, ch), occurrences(b, ch)),
    )


def token_output(word: Column, tag: Column, pos: Column, lemma: Column, plural: Column, noun_mode: str = "lemma") -> Column:
    """The T3 output of a token with these readings (NULL = dropped).

    * tag NN / NE: ``noun_mode="lemma"`` -> lower lemma; ``"reference"`` -> lower word when singular
      (``plural`` NULL), else lower ``plural``;
    * pos DET / ADP / CONJ / PRON: dropped;
    * otherwise lower lemma when it shares at least ``len(word) - 1`` letters with the word, else lower word.
    """
    w, lem = F.lower(word), F.lower(F.coalesce(lemma, word))
    if noun_mode == "reference":
        noun = F.when(plural.isNull(), w).otherwise(F.lower(plural))
    else:
        noun = lem
    return (
        F.when(tag.isin(*L.NOUN_TAGS), noun)
        .when(pos.isin(*L.DROPPED_POS), F.lit(None).cast("string"))
        .when(shared_letters(w, lem) >= F.length(word) - 1, lem)
        .otherwise(w)
    )


def resolve_lexicon(lexicon: DataFrame, noun_mode: str = "lemma") -> DataFrame:
    """(word, _out, _hit) per lexicon word: ``token_output`` of its entry, of several the smallest.

    The decision depends only on the entry, so it is evaluated once per entry, not per token.
    """
    out = token_output(*(F.col(c) for c in ("word", "tag", "pos", "lemma", "plural")), noun_mode)
    return one_per_word(lexicon.select(F.lower(F.col("word")).alias("word"), out.alias("_out"), F.lit(True).alias("_hit")))


def by_ending(tokens: DataFrame, endings: DataFrame, noun_mode: str = "lemma") -> DataFrame:
    """``tokens`` with ``_rule``, whether a rule for word endings holds, and ``_by_rule``, the T3 output by the
    longest that does.

    ``endings`` has (ending, lemma_ending, tag, pos, min_stem): a word with this ending and at least
    ``min_stem`` letters before it has the reading, its lemma ends in ``lemma_ending`` instead. An ending of
    several rules has the smallest. Words of the lexicon are the exceptions: their own entry comes first.
    """
    rules = one_per_word(endings.select(F.lower("ending").alias("ending"), F.coalesce(F.lower("lemma_ending"), F.lit("")).alias("lemma_ending"), "tag", "pos", F.coalesce("min_stem", F.lit(1)).alias("min_stem")), "ending")
    lengths = sorted((r[0] for r in rules.select(F.length("ending")).distinct().collect()), reverse=True)  # lengths of word endings: a few numbers
    word = F.col("token")
    found = []
    for n in lengths:
        own = broadcast_if_small(rules.where(F.length("ending") == n).select(F.col("ending").alias(f"_e{n}"), F.struct("lemma_ending", "tag", "pos", "min_stem").alias(f"_r{n}")))
        tokens = tokens.join(own, F.when(F.length(word) >= n, F.right(word, F.lit(n))) == F.col(f"_e{n}"), "left")
        rule = F.col(f"_r{n}")
        found.append(F.when(F.length(word) - n >= rule["min_stem"], F.struct(F.concat(F.left(word, F.length(word) - n), rule["lemma_ending"]).alias("lemma"), rule["tag"].alias("tag"), rule["pos"].alias("pos"))))
    rule = F.coalesce(*found) if found else F.lit(None).cast("struct<lemma:string,tag:string,pos:string>")
    tokens = tokens.withColumn("_best", rule).drop(*[c for n in lengths for c in (f"_e{n}", f"_r{n}")])
    best = F.col("_best")
    out = token_output(word, best["tag"], best["pos"], best["lemma"], F.lit(None).cast("string"), noun_mode)
    return tokens.withColumns({"_rule": best.isNotNull(), "_by_rule": out}).drop("_best")


#: Transition scores that are inlined into the plan, at most.
MAX_TRANSITIONS = 4096


def best_readings(tokens: Column, transitions: dict[tuple[str, str], float], unseen: float) -> Column:
    """The outputs of the best sequence of readings: a bigram Viterbi pass.

    ``tokens`` is an array with an array of readings (score, tag, out) for each token. The score of a sequence is
    the sum of its readings' scores and of the transition scores between neighbours (``unseen`` if not given); of
    equal sequences the one with the smaller outputs wins. A token with one reading separates what is before
    it from what follows, so the array is cut there, every token starting a piece that ends with the next
    such token, and only the runs of ambiguous tokens between two of them are folded.
    """
    steps = F.create_map(*[F.lit(x) for (a, b), v in transitions.items() for x in (f"{a}>{b}", float(v))]) if transitions else None
    score_type = "struct<score:double,path:array<string>,tag:string>"

    def move(a: Column, b: Column) -> Column:
        return F.lit(float(unseen)) if steps is None else F.coalesce(F.try_element_at(steps, F.concat(a, F.lit(">"), b)), F.lit(float(unseen)))

    def step(states: Column, token: Column) -> Column:
        def reading(r: Column) -> Column:
            def after(s: Column) -> Column:
                return F.struct((-(s["score"] + move(s["tag"], r["tag"]) + r["score"])).alias("score"), F.concat(s["path"], F.array(r["out"])).alias("path"), r["tag"].alias("tag"))

            best = F.array_min(F.transform(states, after))
            more = F.struct((-best["score"]).alias("score"), best["path"].alias("path"), best["tag"].alias("tag"))
            first = F.struct(r["score"].alias("score"), F.array(r["out"]).alias("path"), r["tag"].alias("tag"))
            return F.when(F.size(states) > 0, more).otherwise(first)

        return F.transform(token, reading)

    def folded(piece: Column) -> Column:
        states = F.aggregate(piece, F.array().cast(f"array<{score_type}>"), step)
        return F.array_min(F.transform(states, lambda s: F.struct((-s["score"]).alias("score"), s["path"].alias("path"))))["path"]

    def cut(tokens: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: (i == 0) | (F.size(F.get(tokens, i)) == 1))

        def pieces(at: Column) -> Column:
            def piece(start: Column, n: Column) -> Column:
                following = F.get(at, n + 1)
                # the piece ends with the next single reading, which is the first of the piece after it
                size = F.coalesce(following - start + 1, F.size(tokens) - start)
                keep = F.coalesce(following - start, F.size(tokens) - start)
                simple = F.transform(F.slice(tokens, start + 1, keep), lambda t: t[0]["out"])
                alone = (keep == 1) & (F.size(F.get(tokens, start)) == 1)
                return F.when(alone, simple).otherwise(F.slice(folded(F.slice(tokens, start + 1, size)), F.lit(1), keep))

            return F.flatten(F.transform(at, piece))

        return TX.let(at, pieces)

    return F.when(F.size(tokens) > 0, cut(tokens)).otherwise(F.array().cast("array<string>"))


def best_readings_by_table(tokens: Column, transitions: DataFrame, unseen: float) -> Column:
    """``best_readings`` with the scores of a (prev_tag, tag, score) table."""
    if transitions.count() > MAX_TRANSITIONS:
        raise ValueError(f"at most {MAX_TRANSITIONS} transitions")
    table = {(r[0], r[1]): r[2] for r in transitions.select("prev_tag", "tag", "score").collect()}
    return best_readings(tokens, table, unseen)


def lexicon_readings(lexicon: DataFrame, noun_mode: str = "lemma") -> DataFrame:
    """(word, _readings): the array of (score, tag, out) of a word's entries."""
    decided = token_output(*(F.col(c) for c in ("word", "tag", "pos", "lemma", "plural")), noun_mode)
    reading = F.struct(F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.coalesce("tag", F.lit("")).alias("tag"), decided.alias("out"))
    return lexicon.select(F.lower("word").alias("word"), reading.alias("r")).groupBy("word").agg(F.array_sort(F.collect_set("r")).alias("_readings"))


def _unlisted(out: Column) -> Column:
    """The only reading of a word without an entry."""
    return F.array(F.struct(F.lit(0.0).alias("score"), F.lit("").alias("tag"), out.alias("out")))


def tokenize_pos_lemma(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, out: str = "normalized",
                       noun_mode: str = "lemma", carry: Sequence[str] = (), endings: DataFrame | None = None,
                       transitions: DataFrame | None = None, unseen: float = 0.0, blank: str = f"{TX.BLANK}+") -> DataFrame:
    """Tokens separated by ``blank`` and looked up (lower-cased) in a (word, tag, pos, lemma, plural) lexicon.

    Output (id, *carry, out): ``" " + result`` per kept token in token order ('' when nothing is
    kept). A token that is not in the lexicon is read by its ending if ``endings`` are given (``by_ending``), else
    kept lower-cased. Without ``transitions`` a word has one entry, decided once; with them (prev_tag, tag,
    score) a word may have several entries, which then also have a ``score``, and a document's readings are
    the best sequence (``best_readings``; tokens without an entry have the tag '' and score 0).

    A table that is small enough to be inlined (``inline_lookup``) is looked up within the document's own token
    array, so the pass is map-only. A larger one, or ``endings``, goes by a size-checked broadcast left join of the
    tokens, regrouped by a partial ``collect_list`` in the task that read them, so only kept tokens move.
    """
    words = F.split(F.lower(F.col(text_col)), blank, -1)
    table = resolve_lexicon(lexicon, noun_mode) if transitions is None else lexicon_readings(lexicon, noun_mode)
    listed = inline_lookup(table) if endings is None else None
    if listed is not None:
        if transitions is None:
            kept = F.transform(words, lambda t: F.when(t != "", listed(t, lambda e: e["_out"], t)))
        else:
            found = F.transform(F.filter(words, lambda t: t != ""), lambda t: listed(t, lambda e: e["_readings"], _unlisted(t)))
            kept = best_readings_by_table(found, transitions, unseen)
        # a blank before every kept token; NULLs are left out
        joined = F.array_join(F.concat(F.array(F.lit("")), kept), " ")
        return docs.select(F.col(id_col), *[F.col(c) for c in carry], F.coalesce(joined, F.lit("")).alias(out))
    pre = docs.select(row_key().alias(ROW), F.col(id_col), *[F.col(c) for c in carry], words.alias("_toks"))
    toks = token_table(pre, ROW, F.col("_toks"), outer=True, carry=[id_col, *carry])
    if endings is not None:
        toks = by_ending(toks, endings, noun_mode)
        unknown = F.when(F.col("_rule"), F.col("_by_rule")).otherwise(F.col("token"))
    else:
        unknown = F.col("token")
    if transitions is None:
        res = lookup(toks, table, "word", how="left")
        piece = F.when(F.col("_hit").isNull(), unknown).otherwise(F.col("_out"))
        part = F.when(piece.isNotNull(), F.struct(F.col("pos"), piece.alias("t")))
    else:
        res = lookup(toks, table, "word", how="left")
        part = F.when(F.col("pos").isNotNull(), F.struct(F.col("pos"), F.coalesce("_readings", _unlisted(unknown)).alias("r")))
    per = res.groupBy(ROW).agg(
        *[F.first(c).alias(c) for c in (id_col, *carry)],
        F.array_sort(F.collect_list(part)).alias("_parts"),
    )
    if transitions is None:
        kept = F.transform("_parts", lambda s: s["t"])
    else:
        kept = F.filter(best_readings_by_table(F.transform("_parts", lambda s: s["r"]), transitions, unseen), lambda t: t.isNotNull())
    joined = F.array_join(F.transform(kept, lambda t: F.concat(F.lit(" "), t)), "")
    return per.withColumn(out, F.coalesce(joined, F.lit(""))).drop(ROW, "_parts")


def preprocess(docs: DataFrame, id_col: str, text_col: str, stopwords: Sequence[str] | DataFrame,
               lexicon: DataFrame | None = None, out: str = "processed_text",
               noun_mode: str = "lemma") -> DataFrame:
    """T1 -> T2 -> T3 -> T4. Without a lexicon T3 is skipped and the plan stays map-only.

    ``stopwords`` is a list (hash-set literal) or a one-column ``word`` table (join-based path,
    for lists too large to inline; the output then carries only id and ``out``).
    """
    staged = docs.withColumn(out, TX.strip_special(TX.expand_contractions(text_col)))
    if lexicon is not None:
        keep = [c for c in docs.columns if c not in (id_col, text_col, out)]
        staged = tokenize_pos_lemma(staged, id_col, out, lexicon, out=out, noun_mode=noun_mode, carry=keep, blank=" ")
    if isinstance(stopwords, DataFrame):
        return remove_stopwords_table(staged, id_col, out, stopwords, out=out)
    return staged.withColumn(out, TX.remove_stopwords(out, stopwords))


def map_text(col: Column | str, fn: Callable[[str], str], return_type: T.DataType = T.StringType()) -> Column:
    """Apply a Python function to a text column in Arrow batches (vectorised transfer, no per-row serde).

    NULL in -> NULL out. The slow path: use it only for rules the built-in functions cannot state.
    """

    @F.pandas_udf(return_type)
    def _apply(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else fn(v))

    return _apply(F.col(col) if isinstance(col, str) else col)


def remove_stopwords_table(docs: DataFrame, id_col: str, text_col: str, words: DataFrame, out: str = "cleaned",
                           lower: bool = True, min_length: int = 5, word_col: str = "word") -> DataFrame:
    """T4 / T5 for word lists too large for a literal set: the same rule as
    ``functions.text.remove_stopwords`` (split on one blank, empties kept, short result -> input).

    Tokens are exploded with their positions, marked by a left join to the word table (broadcast after a
    row check, else a shuffle join) and regrouped by row; the input, for results that are too short,
    is put together from the same tokens, so the texts are read once and nothing is joined back.
    Output: (id, out), a row for each input row.
    """
    pre = docs.select(row_key().alias(ROW), F.col(id_col), F.split(F.col(text_col), " ", -1).alias("_toks"))
    toks = pre.select(ROW, id_col, F.posexplode_outer("_toks").alias("pos", "source"))
    toks = toks.withColumn("token", F.lower("source") if lower else F.col("source"))
    listed = words.select(F.col(word_col).alias("token")).distinct().withColumn("_listed", F.lit(True))
    marked = toks.join(broadcast_if_small(listed), "token", "left")
    part = F.struct("pos", "source", "token", F.col("_listed").isNotNull().alias("listed"))
    per = marked.groupBy(ROW).agg(F.first(id_col).alias(id_col), F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), part))).alias("_p"))
    new = F.array_join(F.transform(F.filter("_p", lambda x: ~x["listed"]), lambda x: x["token"]), " ")
    whole = F.when(F.size("_p") > 0, F.array_join(F.transform("_p", lambda x: x["source"]), " "))
    per = per.withColumn("_new", new)
    return per.select(id_col, F.when(F.length("_new") > min_length, F.col("_new")).otherwise(whole).alias(out))
