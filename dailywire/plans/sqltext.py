"""DuckDB SQL fragments that state the same text rules as ``dailywire.functions.text``.

Used only to write the oracle queries in ``oracle_sql()``; the Spark side never runs them.
RE2 differences handled here: ``\\w`` is ASCII in RE2 (use ``[\\pL\\pN_]``), ``$`` only
matches at the very end (a final newline is matched explicitly), ``'g'`` is needed for
global replacement, and lambdas use ``lambda x: e``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from dailywire.functions import lexicons as L


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def str_list(items: Iterable[str]) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def replace_chain(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def clean_html_text(x: str) -> str:
    return py_strip(replace_chain(x, L.HTML_TEXT_REPLACEMENTS))


def expand_contractions(x: str) -> str:
    return replace_chain(x, L.CONTRACTIONS)


def strip_special(x: str) -> str:
    s = f"regexp_replace({x}, '(^| )[\\pL\\pN_](\\n?$| )', ' ', 'g')"
    s = py_strip(s)
    s = f"regexp_replace({s}, '[()‘’“”…+\\-{{}}\\\\.;!,?''\"/\\n\\p{{Nd}}]+', ' ', 'g')"
    s = f"replace({s}, '&', ' and ')"
    return f"regexp_replace({s}, '\\s+', ' ', 'g')"


def remove_stopwords(x: str, words: Iterable[str], lower: bool = True, min_length: int = 5) -> str:
    base = f"lower({x})" if lower else x
    new = f"array_to_string(list_filter(string_split({base}, ' '), lambda w: NOT list_contains({str_list(words)}, w)), ' ')"
    return f"(CASE WHEN length({new}) > {min_length} THEN {new} ELSE {x} END)"


def preprocess_text(x: str, words: Iterable[str]) -> str:
    return remove_stopwords(strip_special(expand_contractions(x)), words)


def keyterm_flag(x: str, terms: Iterable[str] = L.COVID_TERMS) -> str:
    return f"(CASE WHEN list_has_any(string_split({x}, ' '), {str_list(terms)}) THEN 1 END)"


def term_occurrences(x: str, terms: Iterable[str] = L.NEGATIVE_TERMS) -> str:
    return f"len(list_filter(string_split({x}, ' '), lambda w: list_contains({str_list(terms)}, w)))"


def _listed_scores(x: str, lexicon: Mapping[str, float]) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN CAST({q(str(v))} AS DECIMAL(18, 6))" for k, v in lexicon.items())
    return (f"list_filter(list_transform(list_filter(string_split({x}, ' '), lambda w: w <> ''), "
            f"lambda w: CASE w {cases} END), lambda s: s IS NOT NULL)")


def polarity_literal(x: str, lexicon: Mapping[str, float]) -> str:
    """Mean listed score as double: exact decimal sum, then divided."""
    sc = _listed_scores(x, lexicon)
    return f"(CASE WHEN len({sc}) > 0 THEN CAST(list_sum({sc}) AS DOUBLE) / len({sc}) ELSE 0.0 END)"


def negative_flag(x: str, lexicon: Mapping[str, float], terms: Iterable[str] = L.NEGATIVE_TERMS,
                  penalty: float = L.NEGATIVE_TERM_PENALTY) -> str:
    """N3 decided on the exact sum: sum - penalty * k * n < 0 (k > 0 when nothing is listed)."""
    sc = _listed_scores(x, lexicon)
    k = term_occurrences(x, terms)
    below = f"(CASE WHEN len({sc}) > 0 THEN list_sum({sc}) - CAST({q(str(penalty))} AS DECIMAL(18, 6)) * {k} * len({sc}) < 0 ELSE {k} > 0 END)"
    return f"(CASE WHEN {below} THEN 1 END)"


def news_day(doc_id: str = "doc_id") -> str:
    return f"(DATE '2024-01-01' + CAST({doc_id} % 30 AS INTEGER))"


def word_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\pL\\pN_][\\pL\\pN_]+')"


def whitespace_token_count(x: str) -> str:
    s = py_strip(x)
    return f"(CASE WHEN length({s}) = 0 THEN 0 ELSE len(regexp_split_to_array({s}, '\\s+')) END)"


def values_table(rows, cols, alias: str = "t") -> str:
    def lit(v):
        if isinstance(v, str):
            return q(v)
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if v is None:
            return "NULL"
        return repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"


_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_MON = "\\b(" + "|".join(_MONTHS) + ")(?:uary|ruary|ch|il|e|y|ust|tember|t|ober|ember)?\\b\\.?"


def fuzzy_datetime(x: str) -> str:
    """The E12 rules in DuckDB: date as yyyy-m-d (any of - / . blank), d Mon yyyy or Mon d, yyyy; the
    first h:mm (am/pm) after it; an explicit offset is applied; no date -> NULL."""
    t = f"lower({x})"
    for w in L.DATE_NOISE:
        t = f"replace({t}, {q(w)}, '')"
    iso = "(\\d{4})[-/. ](\\d{1,2})[-/. ](\\d{1,2})"
    dmy = "(\\d{1,2})(?:st|nd|rd|th)?\\s+" + _MON + ",?\\s+(\\d{4})"
    mdy = _MON + "\\s+(\\d{1,2})(?:st|nd|rd|th)?,?\\s+(\\d{4})"
    has = lambda rx: f"regexp_matches({t}, '{rx}')"
    ex = lambda rx, g: f"regexp_extract({t}, '{rx}', {g})"
    mon = lambda m: "(CASE " + " ".join(f"WHEN {m} = '{n}' THEN {i}" for i, n in enumerate(_MONTHS, 1)) + " END)"
    year = f"(CASE WHEN {has(iso)} THEN {ex(iso, 1)} WHEN {has(dmy)} THEN {ex(dmy, 3)} WHEN {has(mdy)} THEN {ex(mdy, 3)} END)"
    month = (f"(CASE WHEN {has(iso)} THEN TRY_CAST({ex(iso, 2)} AS INTEGER) WHEN {has(dmy)} THEN {mon(ex(dmy, 2))} "
             f"WHEN {has(mdy)} THEN {mon(ex(mdy, 1))} END)")
    day = f"(CASE WHEN {has(iso)} THEN {ex(iso, 3)} WHEN {has(dmy)} THEN {ex(dmy, 1)} WHEN {has(mdy)} THEN {ex(mdy, 2)} END)"
    rest = (f"(CASE WHEN {has(iso)} THEN regexp_replace({t}, '{iso}', ' ', 'g') WHEN {has(dmy)} THEN regexp_replace({t}, '{dmy}', ' ', 'g') "
            f"ELSE regexp_replace({t}, '{mdy}', ' ', 'g') END)")
    clk = "(\\d{1,2}):(\\d{2})(?::\\d{2})?\\s*(am|pm|a\\.m\\.|p\\.m\\.)?"
    h, mi, ap = (f"regexp_extract({rest}, '{clk}', {g})" for g in (1, 2, 3))
    hour0 = f"(CASE WHEN {h} = '' THEN 0 ELSE TRY_CAST({h} AS INTEGER) END)"
    hour = (f"(CASE WHEN starts_with({ap}, 'p') AND {hour0} < 12 THEN {hour0} + 12 "
            f"WHEN starts_with({ap}, 'a') AND {hour0} = 12 THEN 0 ELSE {hour0} END)")
    minute = f"(CASE WHEN {mi} = '' THEN 0 ELSE TRY_CAST({mi} AS INTEGER) END)"
    off = f"regexp_extract({rest}, '\\d{{1,2}}:\\d{{2}}(?::\\d{{2}})?(?:\\.\\d+)?\\s*(z|[+-]\\d{{2}}:?\\d{{2}})', 1)"
    digits = f"regexp_replace({off}, '[^0-9]', '', 'g')"
    off_min = (f"(CASE WHEN {off} = '' OR {off} = 'z' THEN 0 ELSE (CASE WHEN starts_with({off}, '-') THEN -1 ELSE 1 END) * "
               f"(TRY_CAST(substr({digits}, 1, 2) AS INTEGER) * 60 + TRY_CAST(substr({digits}, 3, 2) AS INTEGER)) END)")
    y, m, d = f"TRY_CAST({year} AS INTEGER)", month, f"TRY_CAST({day} AS INTEGER)"
    valid = f"({m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31 AND {d} <= day(last_day(make_date({y}, {m}, 1))) AND {hour} BETWEEN 0 AND 23 AND {minute} BETWEEN 0 AND 59)"
    stamp = f"make_timestamp({y}, {m}, {d}, {hour}, {minute}, 0.0)"
    return f"(CASE WHEN {year} IS NOT NULL AND {year} <> '' AND {valid} THEN {stamp} - to_minutes(CAST({off_min} AS BIGINT)) END)"
