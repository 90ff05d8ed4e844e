"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

Documents hang on a tree of levels, domain / language / source by default. A weight may be given for
each child below its parent; a child without one has weight 1. The token budget goes down the tree: a
node's budget is shared among its children in proportion to their weights, no child gets more than
its subtree can supply (its tokens times ``epochs``), and what such a child leaves goes to its
siblings, in proportion again. Because a subtree's supply is known at every level, a shortage is met by
siblings first and by the siblings of an ancestor only where these are used up. Shares are whole
tokens: fractions are cut off and the tokens left over go one each to the first unsaturated children.

A leaf with budget b and t tokens is read b div t whole epochs; the next epoch takes the prefix of
its documents, in the epoch's seeded order, whose tokens before them are fewer than b mod t, so the
last document is the one that reaches the budget (``take`` is its part within it).

Order keys are md5 of seed, epoch and id, so their leading digits split a leaf of any size into equal
ranges: tokens are summed per range (partial aggregation), a window over at most 256 sums finds
the range in which the budget ends, then the same within it by the next two digits, and only the
documents of that last range are sorted. No window or task sees a whole leaf, and text is read once,
to count its tokens.

A token is a word here, a run of characters other than ASCII blanks; the counting column is a
parameter.

Defined cases: null text has no tokens and is never taken; null domain, language or source is the
child named ''; a null doc_id is ordered as ``row``, a column that names the row by its content and is
handed through, or as '' without one (then no digits split such ids); rows that repeat a doc_id are ordered by their tokens
and count each; a weight of 0 or less gives a child nothing before its siblings are used up; an empty
table or a budget of 0 gives no rows; a budget beyond the supply takes all of it. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailywire.session import checkpoint

LEVELS = ("domain", "lang", "source")
SEED = 20240101
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def domain_of(source: Column, n: int = 4) -> Column:
    """A domain by the number that ends a source's name; sources without one are 'other'."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (F.when(number != "", number).cast("int") % n).cast("string"))).otherwise(F.lit("other"))


def _whole(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def share(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Budget of each child from its parent's ``budget``, its ``supply`` and ``weight`` (whole numbers).

    Children are taken in the order of supply per weight: one is saturated if its supply is at most
    its share of what the children before it leave. Windows over the children of one node.
    """
    by_need = Window.partitionBy(*parent).orderBy((F.col("supply") / F.col("weight").cast("double")).asc(), F.col(name))
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_need.rowsBetween(0, Window.unboundedFollowing)
    zero = F.lit(0).cast("decimal(38,0)")
    x = children.withColumn("left", F.col("budget") - F.coalesce(F.sum("supply").over(before), F.lit(0))).withColumn("among", F.sum("weight").over(onward))
    # decimals: the products of two counts are exact
    full = _whole(F.col("supply")) * _whole(F.col("among")) <= _whole(F.greatest(F.col("left"), F.lit(0))) * _whole(F.col("weight"))
    x = x.withColumn("full", full)
    # from the first unsaturated child on none is saturated
    x = x.withColumn("full", F.min(F.col("full")).over(by_need.rowsBetween(Window.unboundedPreceding, 0)))
    node = Window.partitionBy(*parent)
    rest = F.greatest(F.max("budget").over(node) - F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(node), F.lit(0)), F.lit(0))
    x = x.withColumn("rest", rest).withColumn("open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(node), F.lit(0)))
    part = F.when(F.col("full"), F.col("supply")).otherwise(F.expr("cast((cast(rest as decimal(38,0)) * cast(weight as decimal(18,0))) div greatest(open, 1) as bigint)"))
    x = x.withColumn("part", part)
    extra = F.col("rest") - F.coalesce(F.sum(F.when(~F.col("full"), F.col("part"))).over(node), F.lit(0))
    turn = F.row_number().over(Window.partitionBy(*parent, "full").orderBy((F.col("supply") / F.col("weight").cast("double")).desc(), F.col(name)))
    x = x.withColumn("extra", extra).withColumn("turn", turn)
    given = F.when(F.col("full"), F.col("part")).otherwise(F.col("part") + F.when(F.col("turn") <= F.col("extra"), 1).otherwise(0))
    return x.withColumn("budget", F.least(given, F.col("supply")).cast("long")).drop("left", "among", "full", "rest", "open", "part", "extra", "turn")


def leaf_budgets(tokens: DataFrame, budget: Column, weights: DataFrame | None, epochs: int, levels: Sequence[str] = LEVELS) -> DataFrame:
    """(levels, tokens, budget) of the leaves. ``budget`` is an expression over ``total`` tokens;
    ``weights`` has (level, path, weight), path being the names down to the child, joined by '/'."""
    leaves = tokens.groupBy(*levels).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    nodes = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total")).select(F.least(budget.cast("long"), F.col("total") * epochs).alias("budget")).withColumn("root", F.lit(0))
    above: list[str] = ["root"]
    for i, level in enumerate(levels):
        down = list(levels[: i + 1])
        children = leaves.groupBy(*down).agg(F.sum("tokens").alias("tokens")).withColumn("root", F.lit(0)).withColumn("supply", F.col("tokens") * epochs)
        if weights is not None:
            own = weights.where(F.col("level") == level).select(F.col("path").alias("_path"), F.col("weight").cast("long").alias("weight"))
            children = children.withColumn("_path", F.concat_ws("/", *down)).join(own, "_path", "left").drop("_path")
        else:
            children = children.withColumn("weight", F.lit(None).cast("long"))
        # weight 0 would divide by zero: all others outweigh a million times
        children = children.withColumn("weight", F.when(F.coalesce("weight", F.lit(1)) <= 0, 1).otherwise(F.coalesce("weight", F.lit(1)) * 1_000_000))
        nodes = checkpoint(share(children.join(nodes, above), above, level).select("root", *down, "tokens", "budget"))
        above = ["root", *down]
        if i + 1 < len(levels):
            nodes = nodes.drop("tokens")
    return nodes.drop("root")


def mixed(docs: DataFrame, domain: Column, share_of_tokens: Column, weights: DataFrame | None = None, epochs: int = 1, seed: int = SEED, tokens: Column | None = None, row: Column | None = None) -> DataFrame:
    """(doc_id, domain, lang, source, epoch, tokens, take, and row if given): a row for each time a document is read."""
    text = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(domain, F.lit("")).alias("domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), (word_count(F.col("text")) if tokens is None else tokens).alias("tokens"),
        *([] if row is None else [row.cast("string").alias("row")]),
    )
    counted = checkpoint(text.where("tokens > 0"))
    leaves = leaf_budgets(counted, share_of_tokens, weights, epochs).where("budget > 0").withColumn("whole", F.expr("budget div tokens")).withColumn("part", F.expr("budget % tokens"))
    leaves = checkpoint(leaves.select(*LEVELS, "whole", "part"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("") if row is None else F.col("row"))).cast("binary"))
    ordered = checkpoint(counted.join(leaves, list(LEVELS)).withColumn("key", key).withColumn("a", F.substring("key", 1, 2)).withColumn("b", F.substring("key", 3, 2)))

    def last(rows: DataFrame, keys: Sequence[str], digit: str) -> DataFrame:
        """The range in which the part ends, and the tokens before it."""
        w = Window.partitionBy(*keys).orderBy(digit)
        sums = rows.groupBy(*keys, "part", "before", digit).agg(F.sum("tokens").alias("n"))
        sums = sums.withColumn("before", F.col("before") + F.sum("n").over(w) - F.col("n"))
        return sums.where((F.col("before") < F.col("part")) & (F.col("before") + F.col("n") >= F.col("part"))).select(*keys, digit, "before")

    partly = ordered.where("part > 0").withColumn("before", F.lit(0).cast("long"))
    one = last(partly, LEVELS, "a").withColumnRenamed("a", "end_a").withColumnRenamed("before", "before_a")
    inner = partly.drop("before").join(one, list(LEVELS)).where("a = end_a").withColumnRenamed("before_a", "before")
    two = last(inner, LEVELS, "b").withColumnRenamed("b", "end_b").withColumnRenamed("before", "before_b")
    ends = checkpoint(one.drop("before_a").join(two, list(LEVELS)))
    x = ordered.join(ends, list(LEVELS), "left")
    full = x.where("whole > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, whole - 1)"))).withColumn("take", F.col("tokens"))
    early = x.where("part > 0 and (a < end_a or a = end_a and b < end_b)").withColumn("epoch", F.col("whole")).withColumn("take", F.col("tokens"))
    w = Window.partitionBy(*LEVELS).orderBy("key", F.col("doc_id").asc_nulls_first(), "tokens").rowsBetween(Window.unboundedPreceding, -1)
    at_end = x.where("part > 0 and a = end_a and b = end_b").withColumn("start", F.col("before_b") + F.coalesce(F.sum("tokens").over(w), F.lit(0)))
    at_end = at_end.where("start < part").withColumn("epoch", F.col("whole")).withColumn("take", F.least(F.col("tokens"), F.col("part") - F.col("start")))
    out = ["doc_id", *LEVELS, "epoch", "tokens", "take", *([] if row is None else ["row"])]
    return full.select(out).union(early.select(out)).union(at_end.select(out))
