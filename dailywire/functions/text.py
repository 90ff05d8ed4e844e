"""Column -> Column text functions. All native (JVM, regex / higher-order functions).

Regexes use Java syntax with ``(?U)`` so that ``\\w``, ``\\d`` and ``\\s`` are Unicode
classes, matching Python-3 ``str`` regex semantics of the analysed scripts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dailywire.functions import lexicons as L


#: ``(?U)\\s`` with its characters listed, which a regex finds faster than by their properties.
BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Most letters, none of them a blank: tested first, since the classes below take longer.
_NO_LETTER = "(?![a-zA-Z\u00c0-\u024f])"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def replace_chain(col: Column | str, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal, ordered, non-overlapping left-to-right replacements (like ``str.replace`` chained)."""
    out = _c(col)
    for search, repl in pairs:
        out = F.replace(out, F.lit(search), F.lit(repl))
    return out


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a one-element ``transform``): SQL has no LET,
    and expressions under higher-order functions are not shared by subexpression elimination."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def py_strip(col: Column | str) -> Column:
    """Strip leading/trailing Unicode blanks (``str.strip()``; Spark ``trim`` removes spaces only).

    The regex only runs when the first or last character is blank (two one-character checks).
    """
    def strip(c: Column) -> Column:
        edge = F.substring(c, 1, 1).rlike(r"(?U)\s") | F.substring(c, -1, 1).rlike(r"(?U)\s")
        return F.when(edge, F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")).otherwise(c)

    return let(_c(col), strip)


def clean_html_text(col: Column | str) -> Column:
    """Fixed replacement chain over scraped text, then strip."""
    return py_strip(replace_chain(col, L.HTML_TEXT_REPLACEMENTS))


def clean_link(col: Column | str) -> Column:
    """Curly single quotes in a link become ``/'``."""
    return replace_chain(col, L.LINK_REPLACEMENTS)


def expand_contractions(col: Column | str, bounded: bool = False) -> Column:
    """Ordered contraction expansion. ``bounded=True`` only rewrites at word ends.

    Every rule contains an apostrophe, so a text without one is passed through unscanned.
    """
    if not bounded:
        return let(_c(col), lambda c: F.when(c.contains("'") | c.contains("’"), replace_chain(c, L.CONTRACTIONS)).otherwise(c))
    out = _c(col)
    for search, repl in L.CONTRACTIONS:
        if "'" in search:
            out = F.regexp_replace(out, "(?U)" + re.escape(search) + r"\b", repl)
        else:
            out = F.replace(out, F.lit(search), F.lit(repl))
    return out


# T2 characters that become a blank, and the blanks: a run of them becomes one blank.
_T2_CHARS = r"()‘’“”…+\-{}\\.;!,?'\"/\n\d" + BLANK[1:-1].replace(" ", "")
# a single space stays as it is, so only the other runs are matched
_T2_BLANKED = f"(?U){_NO_LETTER}(?: {_NO_LETTER}[{_T2_CHARS} ]+|[{_T2_CHARS}][{_T2_CHARS} ]*)"


def strip_special(col: Column | str) -> Column:
    """Drop single-letter words, punctuation, digits, slashes; ``&`` -> `` and ``; collapse blanks.

    No final strip: a leading/trailing blank may remain (T4 splits on one blank).
    """
    def letters(c: Column) -> Column:
        # (?:^| )\w(?:$| ), apart for the text's start, as a pattern that begins with a blank is found faster
        after = lambda c: F.regexp_replace(c, r"(?dU) \w(?:$| )", " ")
        rest = F.substring(c, F.when(F.substring(c, 2, 1) == " ", 3).otherwise(2), F.length(c))
        return F.when(F.substring(c, 1, 3).rlike(r"(?U)\A\w(?: |\n?\z)"), F.concat(F.lit(" "), after(rest))).otherwise(after(c))

    out = py_strip(let(_c(col), letters))
    return F.regexp_replace(F.replace(out, F.lit("&"), F.lit(" and ")), _T2_BLANKED, " ")


def remove_stopwords(
    col: Column | str,
    stopwords: Sequence[str],
    lower: bool = True,
    limit: int | None = None,
    min_length: int = 5,
) -> Column:
    """T4 / T5: split on one blank, drop listed tokens, rejoin; keep the input if the result is short.

    The membership test becomes a hash ``INSET`` (Catalyst ``OptimizeIn``); no Python worker.
    Empty tokens stay and rejoin as blanks.
    """
    words = list(stopwords[:limit] if limit is not None else stopwords)

    def body(src: Column) -> Column:
        base = F.lower(src) if lower else src
        kept = F.filter(F.split(base, " ", -1), lambda x: ~x.isin(words)) if words else F.split(base, " ", -1)
        return let(F.array_join(kept, " "), lambda new: F.when(F.length(new) > min_length, new).otherwise(src))

    # the input and the new text are each bound once (lambdas defeat subexpression elimination)
    return let(_c(col), body)


def preprocess_text(col: Column | str, stopwords: Sequence[str]) -> Column:
    """T1 -> T2 -> T4 as one column expression (T3 needs a lexicon join; see operators.text)."""
    return remove_stopwords(strip_special(expand_contractions(col)), stopwords)


def blank_tokens(col: Column | str) -> Column:
    """Tokens split on a single blank (``text.split(" ")``), empties kept."""
    return F.split(_c(col), " ", -1)


def keyterm_flag(col: Column | str, terms: Sequence[str] = L.COVID_TERMS) -> Column:
    """1 if any blank-split token is a key term, else NULL."""
    terms = list(terms)
    return F.when(F.exists(blank_tokens(col), lambda x: x.isin(terms)), F.lit(1))


def term_occurrences(col: Column | str, terms: Sequence[str] = L.NEGATIVE_TERMS) -> Column:
    """Number of blank-split tokens (with repeats) that are in ``terms``."""
    terms = list(terms)
    return F.size(F.filter(blank_tokens(col), lambda x: x.isin(terms)))


def polarity_label(col: Column | str) -> Column:
    """<0 negative, =0 neutral, >0 positive."""
    c = _c(col)
    return F.when(c < 0, "negative").when(c == 0, "neutral").when(c > 0, "positive")


def conditional_label(col: Column | str, when_value=1, yes: str = "negative", no: str = "positive") -> Column:
    """``np.where(flag == 1, yes, no)``; NULL goes to ``no``."""
    c = _c(col)
    return F.when(c == when_value, yes).otherwise(no)


def word_tokens(col: Column | str, lower: bool = True) -> Column:
    """Vectorizer tokens: ``(?u)\\b\\w\\w+\\b`` on the lower-cased text."""
    c = F.lower(_c(col)) if lower else _c(col)
    # a maximal run of two or more word characters == \b\w\w+\b
    return F.regexp_extract_all(c, F.lit(r"(?U)[a-z\w]{2,}"), 0)


def whitespace_token_count(col: Column | str) -> Column:
    """``len(text.split())``: runs of blanks separate, leading/trailing ignored, empty -> 0."""
    return let(py_strip(col), lambda t: F.when(F.length(t) == 0, F.lit(0)).otherwise(F.size(F.split(t, r"(?U)\s+", -1))))


def strip_accents(col: Column | str) -> Column:
    """Fold accented Latin letters to their base letter (table built from Unicode decomposition)."""
    return F.translate(_c(col), L.ACCENTED, L.UNACCENTED)


def counted(tokens: Column) -> Column:
    """Array of (term, count) of the distinct elements of ``tokens``, in order: sorted, equal neighbours are counted."""
    def runs(s: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))
        run = lambda at: F.transform(at, lambda p, j: F.struct(F.get(s, p).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - p).cast("long").alias("count")))
        return F.when(F.size(s) > 0, let(at, run))

    return let(F.sort_array(tokens), runs)


def topic_tokens(col: Column | str, min_len: int = 2, max_len: int = 15) -> Column:
    """Lower, strip accents, alphabetic tokens (no digits) of length min..max not starting with ``_``."""
    toks = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(?U)[a-z[\w&&\D]]+"), 0)
    # letter by letter, so it can wait until the tokens are cut
    toks = F.transform(toks, lambda t: F.when(t.rlike("[^\\x00-\\x7f]"), strip_accents(t)).otherwise(t))
    return F.filter(
        toks,
        lambda t: (F.length(t) >= min_len) & (F.length(t) <= max_len) & ~t.startswith("_"),
    )


def cloud_tokens(col: Column | str) -> Column:
    """W1 word tokens: ``\\w[\\w']*`` lower-cased, trailing ``'s`` dropped, pure digits dropped."""
    toks = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(?U)[a-z\w][a-z\w']*"), 0)
    toks = F.transform(toks, lambda t: F.when(t.endswith("'s"), F.substring(t, F.lit(1), F.length(t) - 2)).otherwise(t))
    # what starts beyond "9" is no number
    return F.filter(toks, lambda t: ((t >= ":") | ~t.rlike(r"^\d+$")) & (t != ""))


def parse_grouped_number(col: Column | str) -> Column:
    """C4: ``"16,914.58"`` -> 16914.58; unparsable -> NULL."""
    return F.regexp_replace(_c(col), ",", "").try_cast("double")
