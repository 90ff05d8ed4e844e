"""Filter interaction audit: what every order of the filters keeps, from one truth-table word per document.

Five filters, each with a failure condition on the whole text (words are runs of characters other than
ASCII blanks):

A: fewer than 50 words; B: 100 * distinct words < 65 * words; C: 100 * capitals A-Z > 5 * code points;
D: holds one of ``#$%&*|``; E: the same text has a smaller doc_id anywhere in the table.

A set S of filters keeps a document that fails none of them, so a document is a 32-bit word: bit S is
set if S keeps it, S being read as a binary number with A as its lowest digit. A failed filter clears the
subsets that hold it, so the word is the conjunction of at most five fixed patterns. Positional popcounts
over the words give the survivors of all 32 subsets at once. They are taken by carry-save adders: three
words become a sum word and a carry word, until a few words of every weight are left. Each Arrow batch
yields one row of counts per part and label class, which Spark adds up. Every figure of every order
follows from the 32 survivor counts.

E needs no text beyond its digest: the smallest doc_id of each SHA-256 digest is taken by partial
aggregation and met again by (doc_id, digest), a key that no group of copies makes hot.

Defined cases: null text is empty, null source is the part ''; a null doc_id neither fails E nor makes
another row fail it, and has no label; rows that repeat a doc_id count each, and are not smaller than
one another; a doc_id with several label rows has a label if one of them says so; an empty table
has no parts and gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailywire.session import checkpoint

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
FULL = SUBSETS - 1
#: Bit S of WITHOUT[i] is set if the subset S does not hold filter i.
WITHOUT = [sum(1 << s for s in range(SUBSETS) if not s >> i & 1) for i in range(len(FILTERS))]

_COUNTS = "part string, subset int, kept long, good long, toxic long"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def failures(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text without nulls and its words."""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 65,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit set, by carry-save addition."""
    counts, layer, weight = np.zeros(32, np.int64), words.astype(np.uint32), 0
    while len(layer):
        carries = []
        while len(layer) > 2:
            third = len(layer) // 3
            a, b, c = layer[:third], layer[third : 2 * third], layer[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            layer = np.concatenate([half ^ c, layer[3 * third :]])
        for word in layer.tolist():
            counts += (word >> np.arange(32) & 1) << weight
        layer = np.concatenate(carries) if carries else layer[:0]
        weight += 1
    return counts


def _popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("part").dictionary_encode()
        words = np.asarray(batch.column("word")).astype(np.uint32)
        group = np.asarray(parts.indices).astype(np.int64) * 4 + np.asarray(batch.column("label"))
        order = np.argsort(group, kind="stable")
        group, words = group[order], words[order]
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        counts = np.zeros((len(parts.dictionary), 3, SUBSETS), np.int64)
        for lo, hi in zip(cuts, [*cuts[1:], len(group)], strict=True):
            own, label = positional_counts(words[lo:hi]), int(group[lo]) % 4
            for column, belongs in enumerate((True, label & 1, label & 2)):
                if belongs:
                    counts[group[lo] // 4, column] += own
        n = len(parts.dictionary)
        yield pa.RecordBatch.from_arrays(
            [parts.dictionary.take(pa.array(np.repeat(np.arange(n), SUBSETS))), pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), n)), *(pa.array(counts[:, i].ravel()) for i in range(3))],
            names=["part", "subset", "kept", "good", "toxic"],
        )


def survival_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, label, word) of every document; label: 1 for quality, 2 for toxic, added."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    x = x.withColumn("words", words_of(F.col("text")))
    word = F.lit((1 << SUBSETS) - 1)
    for letter, fails in failures(F.col("text"), F.col("words")).items():
        word = word.bitwiseAND(F.when(fails, F.lit(WITHOUT[FILTERS.index(letter)])).otherwise(F.lit((1 << SUBSETS) - 1)))
    x = checkpoint(x.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), word.alias("word")))
    named = x.where("doc_id is not null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    of = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    of = of.agg((F.max(F.expr("int(quality <=> 1)")) + 2 * F.max(F.expr("int(toxic <=> 1)"))).alias("label"))
    again = F.when(F.col("first").isNull(), F.lit(WITHOUT[FILTERS.index("E")])).otherwise(F.lit((1 << SUBSETS) - 1))
    named = named.join(first, ["doc_id", "digest"], "left").join(of, "doc_id", "left")
    named = named.select("part", F.coalesce("label", F.lit(0)).alias("label"), F.col("word").bitwiseAND(again).alias("word"))
    return named.union(x.where("doc_id is null").select("part", F.lit(0), "word"))


def subset_survivors(words: DataFrame) -> DataFrame:
    """(part, subset, kept, good, toxic): the documents that each of the 32 subsets of filters keeps."""
    batches = words.mapInArrow(_popcounts, _COUNTS)
    return batches.groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in ("kept", "good", "toxic")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    survivors = subset_survivors(survival_words(docs, labels))
    by_part = survivors.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "kept", "good", "toxic"))).alias("n"))
    x = by_part.select("part", *(F.col(f"n.{c}").alias(c) for c in ("kept", "good", "toxic")))

    def at(counts: str, subset: Column) -> Column:
        return F.get(F.col(counts), subset)

    def shapley(i: int) -> Column:
        """Removed by filter i over all orders: |S|! * (others)! of them have the set S before it."""
        total = F.lit(0).cast("long")
        for s in range(SUBSETS):
            if not s >> i & 1:
                times = factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())
                total = total + times * (at("kept", F.lit(s)) - at("kept", F.lit(s | 1 << i)))
        return total

    x = x.withColumn("shares", F.array(*(shapley(i) for i in range(len(FILTERS)))))
    orders = " ".join("".join(order) for order in permutations(FILTERS))
    x = x.withColumn("filter_order", F.explode(F.split(F.lit(orders), " "))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def letters(holds) -> Column:
        """The set of filters whose place in the order satisfies ``holds``, as a binary number."""
        return sum((F.when(holds(F.instr(F.col("filter_order"), letter)), 1 << i).otherwise(0) for i, letter in enumerate(FILTERS)), F.lit(0))

    x = x.withColumns({"before": letters(lambda at: at < F.col("step")), "after": letters(lambda at: at <= F.col("step")), "filter": letters(lambda at: at == F.col("step"))})
    removed = at("kept", F.col("before")) - at("kept", F.col("after"))
    return x.select(
        "part",
        "filter_order",
        "step",
        at("kept", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (at("kept", F.lit(0)) - at("kept", F.col("filter")) - removed).alias("redundant"),
        (at("kept", F.lit(FULL) - F.col("filter")) - at("kept", F.lit(FULL))).alias("unique_fails"),
        (at("good", F.col("before")) - at("good", F.col("after"))).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", F.col("after"))).alias("toxic_lost"),
        F.get("shares", F.ascii(F.substring("filter_order", F.col("step"), F.lit(1))) - ord("A")).alias("shapley"),
    )
