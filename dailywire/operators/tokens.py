"""Shared token table and per-document lexicon lookups.

Pattern used by the lexicon-driven operators (N2, N5, N7, N9):

1. ``explode_outer`` the tokens of each document (narrow: a document's tokens stay in the map
   task that read the document, and a document without tokens keeps one row);
2. left-join the lexicon - broadcast behind a row-count check, otherwise a shuffle join whose hot
   tokens AQE splits;
3. group by the input row: partial aggregation collapses every row to one inside its map task,
   so the shuffle carries one small row per document - never the text, never the tokens.

A row's key is its number in its partition (``row_key``), not its id: rows that share an id, or have
none, keep a result each, and null ids don't meet in one group.

Per-document columns that are not aggregated (counts computed from the text, other small
columns) ride along with ``first``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailywire.session import DEFAULT_BROADCAST_ROWS, broadcast_if_small

#: Rows of a lookup table that may be inlined into the plan, at most, and those whose words are also listed as a
#: set, which tells words that are not in the table sooner.
INLINE_ROWS, SET_ROWS = 20_000, 1_000


ROW = "_row"


def row_key() -> Column:
    """Number of an input row: its partition and place there. Used only to bring a row's tokens together."""
    return F.monotonically_increasing_id()


def token_table(df: DataFrame, id_col: str, tokens: Column, keep_empty: bool = False, outer: bool = False,
                carry: Sequence[str] = ()) -> DataFrame:
    """(id, *carry, pos, token) rows; ``pos`` is the token's index in the document.

    ``outer=True`` keeps documents without (non-empty) tokens as one row with NULL pos / token.
    """
    if not keep_empty:
        tokens = F.filter(tokens, lambda x: x != "")
    gen = F.posexplode_outer(tokens) if outer else F.posexplode(tokens)
    return df.select(F.col(id_col), *[F.col(c) for c in carry], gen.alias("pos", "token"))


def one_per_word(lexicon: DataFrame, word_col: str = "word") -> DataFrame:
    """One row per word: of repeated entries the smallest, compared column by column (NULL first), so
    that a word listed twice neither repeats a token nor counts twice."""
    others = [c for c in lexicon.columns if c != word_col]
    if not others:
        return lexicon.distinct()
    return lexicon.groupBy(word_col).agg(F.min(F.struct(*others)).alias("_entry")).select(word_col, "_entry.*")


def lookup(tokens: DataFrame, lexicon: DataFrame, word_col: str = "word", how: str = "inner",
           max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join tokens to a lexicon, one entry per ``word_col`` (broadcast only behind a row check)."""
    lex = broadcast_if_small(one_per_word(lexicon, word_col), max_broadcast_rows)
    return tokens.join(lex, tokens["token"] == lex[word_col], how).drop(lex[word_col])


def inline_lookup(table: DataFrame, word_col: str = "word", max_rows: int = INLINE_ROWS) -> Callable[..., Column] | None:
    """A function from a word to the struct of its other columns (NULL if not listed), or None if ``table``, one
    row per word, has more than ``max_rows`` rows. Given ``of`` and ``other`` too, it returns ``of`` the struct, or
    ``other`` for a word that is not listed.

    The table becomes one constant of the plan, dealt into as many maps as it has words, so a lookup costs the
    same whatever its size and tokens need not leave their array: no explode, no join, no regrouping.
    """
    entry = F.struct(*[c for c in table.columns if c != word_col])
    rows = table.where(F.col(word_col).isNotNull()).select(F.xxhash64(word_col), F.to_json(F.struct(F.col(word_col).alias("w"))), F.to_json(entry), word_col).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    n = max(1, len(rows))
    buckets: list[list[str]] = [[] for _ in range(n)]
    for h, word, value, _ in rows:
        # {"w":"word"} and {...}: the word's own JSON text is the key
        buckets[h % n].append(f"{word[5:-1]}:{value}")
    shape = table.select(entry.alias("e")).schema["e"].dataType.simpleString()
    maps = F.from_json(F.lit("[" + ",".join("{" + ",".join(b) + "}" for b in buckets) + "]"), f"array<map<string,{shape}>>")
    words = [r[3] for r in rows]

    def found(t: Column, of: Callable[[Column], Column] | None = None, other: Column | None = None) -> Column:
        entry = F.try_element_at(F.get(maps, F.pmod(F.xxhash64(t), F.lit(n)).cast("int")), t)
        if of is None:
            return entry
        if len(words) > SET_ROWS:
            listed = entry.isNotNull()
        else:
            listed = t.isin(words) if words else F.lit(False)
        return F.when(listed, of(entry)).otherwise(other)

    return found


def per_document(docs: DataFrame, id_col: str, tokens: Column, lexicon: DataFrame, aggs: Sequence[Column],
                 word_col: str = "word", carry: dict[str, Column] | None = None,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """(id, *carry, *aggs) for every input row: explode_outer -> lexicon left join -> group by row.

    ``carry`` are per-document expressions evaluated on the document row before the explode
    (e.g. a token count) and passed through with ``first``.
    """
    carry = carry or {}
    pre = docs.select(row_key().alias(ROW), F.col(id_col), tokens.alias("_toks"), *[c.alias(n) for n, c in carry.items()])
    toks = token_table(pre, ROW, F.col("_toks"), outer=True, carry=[id_col, *carry])
    hit = lookup(toks, lexicon, word_col, how="left", max_broadcast_rows=max_broadcast_rows)
    return hit.groupBy(ROW).agg(*[F.first(n).alias(n) for n in (id_col, *carry)], *aggs).drop(ROW)
