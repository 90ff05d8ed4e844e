"""Merkle manifest of a table of documents, with the leaf coordinates from ranked doc_id bitmaps.

Every row is a leaf: the SHA-256 (lowercase hex) of doc_id, source, lang, n_chars and text, each ``-`` if null,
else its UTF-8 byte count, ``:`` and its value. Per lang the leaves ascend by doc_id; every 8 consecutive
nodes of a level (the last run may be shorter, one node even) become the hash of their hex digests,
until one node is left, the lang's subroot. The subroots, ordered by lang (null first, by bytes), make the
root in the same way.

1. Coordinates: each lang's doc_ids are bitmaps of 512 bits, kept as eight words for those ranges that
   hold an id, merged by partial aggregation (a bitwise or). A directory holds the number of leaves
   before each bitmap: running sums over range partitions, whose offsets are one row a partition. A
   leaf's coordinate is its directory entry and the popcount of the bits below its own; no task sorts
   the leaves of a lang.
2. Levels: nodes go to the block of 512 coordinates (three levels) that they are in, fill that block's
   array of slots and are reduced there. A pass leaves one row in 512.
3. Proofs go down the same blocks: a block gets the siblings on the way from its top to the root once,
   and gives each of its nodes that way with the up to three levels of its own before it.

``proofs`` also folds each leaf, or the leaf of a tampered row, with the siblings to a root.

Defined cases: rows without a doc_id come first in their lang; rows that share lang and doc_id are
leaves of their own, ordered by their leaf hash (found by the hash's first two bytes, then within them, so
that no window holds all rows of one id); equal rows take consecutive coordinates and are returned as often
as they occur; a lone leaf is its lang's subroot and a lone subroot the root, and a level without
siblings adds nothing to the proof; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailywire.session import broadcast_if_small, checkpoint

from . import common, groups

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node are 1 << FAN; a block holds the nodes of PASS levels.
FAN, PASS = 3, 3
BLOCK_BITS = FAN * PASS
BITS, WORDS = 9, 8

_NODE = "g long, idx long, hash binary"
_WAY = "g long, idx long, slots binary, siblings array<string>, subroot string, root string"
_PROOF = "doc_id long, idx long, leaf string, subroot string, root string, slots binary, proof_sha256 string, folded_root string, siblings array<string>"


def leaf_hash(**values: Column) -> Column:
    """The leaf of a row, given its fields as strings."""
    parts = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in (values[f] for f in FIELDS)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _h(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def block_levels(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of a block and of the ``levels`` above them, as hex digests."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([_h(b"".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return out


def siblings_of(levels: list[list[bytes]], i: int) -> list[tuple[int, bytes]]:
    """(slot of the node on the way, its siblings joined) of every level above node ``i``."""
    out = []
    for row in levels[:-1]:
        run = row[i >> FAN << FAN : (i >> FAN) + 1 << FAN]
        slot = i & 7
        out.append((slot, b"".join(run[:slot] + run[slot + 1 :])))
        i >>= FAN
    return out


def fold(node: bytes, way: list[tuple[int, bytes]]) -> bytes:
    """The top of the way from a node, with its siblings."""
    for slot, others in way:
        node = _h(others[: 64 * slot] + node + others[64 * slot :])
    return node


def _spans(table: pa.Table, bounds) -> Iterator[tuple[int, int]]:
    return zip(bounds.tolist(), [*bounds[1:].tolist(), len(table)], strict=True)


def _reduce(table: pa.Table, bounds) -> pa.Table:
    hashes, levels, g, block = (table[c].to_pylist() for c in ("hash", "levels", "g", "block"))
    slot = table["slot"].to_pylist()
    out = []
    for lo, hi in _spans(table, bounds):
        nodes: list[bytes] = [b""] * (hi - lo)
        for row in range(lo, hi):
            nodes[slot[row]] = hashes[row].hex().encode()
        top = block_levels(nodes, levels[lo])[-1]
        out.append((g[lo], block[lo], bytes.fromhex(top[0].decode())))
    return pa.table({c: pa.array([r[i] for r in out], k) for i, (c, k) in enumerate({"g": pa.int64(), "idx": pa.int64(), "hash": pa.binary()}.items())})


def _blocks(table: pa.Table, bounds):
    """(rows of the nodes by slot, their levels, the block's header) of each block."""
    hashes, levels, slot = (table[c].to_pylist() for c in ("hash", "levels", "slot"))
    head = {c: table[c].to_pylist() for c in ("slots", "siblings", "subroot", "root")}
    for lo, hi in _spans(table, bounds):
        rows, top = [-1] * (hi - lo - 1), lo
        for row in range(lo, hi):
            if slot[row] < 0:
                top = row
            else:
                rows[slot[row]] = row
        way = list(zip(head["slots"][top], (s.encode() for s in head["siblings"][top]), strict=True))
        tree = block_levels([hashes[r].hex().encode() for r in rows], levels[rows[0]])
        yield rows, tree, way, head["subroot"][top], head["root"][top]


def _hand_down(table: pa.Table, bounds) -> pa.Table:
    g, block, out = table["g"].to_pylist(), table["block"].to_pylist(), []
    for rows, tree, above, subroot, root in _blocks(table, bounds):
        for i, row in enumerate(rows):
            way = siblings_of(tree, i) + above
            out.append((g[row], block[row] << BLOCK_BITS | i, bytes(s for s, _ in way), [x.decode() for _, x in way], subroot, root))
    kinds = {"g": pa.int64(), "idx": pa.int64(), "slots": pa.binary(), "siblings": pa.list_(pa.string()), "subroot": pa.string(), "root": pa.string()}
    return pa.table({c: pa.array([r[i] for r in out], k) for i, (c, k) in enumerate(kinds.items())})


def _prove(with_siblings: bool):
    def handle(table: pa.Table, bounds) -> pa.Table:
        ids, block, tampered = (table[c].to_pylist() for c in ("doc_id", "block", "tampered"))
        out = []
        for rows, tree, above, subroot, root in _blocks(table, bounds):
            joined = b"".join(x for _, x in above)
            for i, row in enumerate(rows):
                own = siblings_of(tree, i)
                way = own + above
                proof = hashlib.sha256(b"".join(x for _, x in own) + joined).hexdigest()
                leaf = tree[0][i]
                start = leaf if tampered[row] is None else tampered[row].hex().encode()
                slots = bytes(s for s, _ in way)
                out.append((ids[row], block[row] << BLOCK_BITS | i, leaf.decode(), subroot, root, slots, proof, fold(start, way).decode(), [x.decode() for _, x in way] if with_siblings else None))
        kinds = {"doc_id": pa.int64(), "idx": pa.int64(), "leaf": pa.string(), "subroot": pa.string(), "root": pa.string(), "slots": pa.binary(), "proof_sha256": pa.string(), "folded_root": pa.string(), "siblings": pa.list_(pa.string())}
        return pa.table({c: pa.array([r[i] for r in out], k) for i, (c, k) in enumerate(kinds.items())})

    return handle


def _by_block(rows: DataFrame, handle, schema: str) -> DataFrame:
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(width, "g", "block").sortWithinPartitions("g", "block")
    return dealt.mapInArrow(lambda batches: groups.whole_groups(batches, ["g", "block"], handle), schema)


def _in_blocks(nodes: DataFrame, trees: DataFrame, done: int) -> DataFrame:
    """Nodes with their block, slot and the levels that this pass reduces (``trees``: g, height)."""
    left = F.least(F.lit(PASS), F.greatest(F.col("height") - done, F.lit(0))).cast("int")
    x = nodes.join(trees.select("g", "height"), "g").withColumn("levels", left).drop("height")
    return x.withColumn("block", F.shiftright("idx", BLOCK_BITS)).withColumn("slot", F.col("idx").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int")).drop("idx")


def height(leaves: Column) -> Column:
    """Levels above ``leaves`` nodes: the powers of 8 below that number."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(20)), lambda k: F.pow(F.lit(8.0), k) < leaves)).cast("int")


def reduce_levels(nodes: DataFrame, trees: DataFrame) -> list[DataFrame]:
    """The tables (g, idx, hash) of every third level, the last with one node for each g."""
    highest = trees.agg(F.max("height")).first()[0] or 0
    out = [nodes]
    for done in range(0, highest, PASS):
        x = _in_blocks(out[-1].select("g", "idx", "hash"), trees, done)
        out.append(checkpoint(_by_block(x, _reduce, _NODE)))
    return out


def _headed(nodes: DataFrame, way: DataFrame, trees: DataFrame, level: int) -> DataFrame:
    """Nodes of a level with, per block, a header row that holds the way from its top to the root."""
    x = _in_blocks(nodes, trees, level * PASS)
    head = way.withColumn("block", F.col("idx")).withColumn("slot", F.lit(-1)).drop("idx")
    return x.unionByName(head, allowMissingColumns=True)


def hand_down(levels: list[DataFrame], way: DataFrame, trees: DataFrame) -> DataFrame:
    """The way to the root of the nodes of ``levels[0]``, from that of the last level's."""
    for level in range(len(levels) - 2, -1, -1):
        way = checkpoint(_by_block(_headed(levels[level], way, trees, level), _hand_down, _WAY))
    return way


def numbered_langs(leaves: DataFrame) -> DataFrame:
    """(lang, g, n, height): langs in order, null first, with their number of leaves."""
    langs = checkpoint(leaves.groupBy("lang").agg(F.sum("copies").alias("n")))
    x = common.running_total(langs.withColumn("one", F.lit(1).cast("long")), [F.col("lang").asc_nulls_first()], "one", "g").drop("one")
    return checkpoint(x.withColumn("height", height(F.col("n"))))


def _ties(rows: DataFrame) -> DataFrame:
    """Rows that share g and doc_id with other leaves: ``tie`` is the number of leaves before them."""
    digits = F.hex(F.substring("leaf", 1, 2))
    x = rows.withColumn("digits", digits)
    per = Window.partitionBy("g", "doc_id").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("g", "doc_id", "digits").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    before = x.groupBy("g", "doc_id", "digits").agg(F.sum("copies").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(per), F.lit(0))).drop("n")
    before = before.select(*(F.col(c).alias(f"_{c}") for c in before.columns))
    same = F.col("g").eqNullSafe(F.col("_g")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("digits").eqNullSafe(F.col("_digits"))
    x = x.withColumn("within", F.coalesce(F.sum("copies").over(inner), F.lit(0))).join(before, same)
    return x.withColumn("tie", F.col("_before") + F.col("within")).select(*rows.columns, "tie")


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves`` (g, doc_id, leaf, copies, ...) with ``idx``, the first of its coordinates among those of g."""
    named = leaves.where("doc_id is not null")
    block, bit = F.shiftright("doc_id", BITS), F.col("doc_id").bitwiseAND((1 << BITS) - 1)
    bits = [F.bit_or(F.when(F.shiftright(bit, 6) == w, F.expr("shiftleft(1L, cast(doc_id & 63 as int))")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(WORDS)]
    bitmaps = named.groupBy("g", block.alias("block")).agg(*bits, F.sum("copies").alias("n"))
    repeated = checkpoint(named.groupBy("g", "doc_id").agg(F.sum("copies").alias("n"), F.count("*").alias("leaves")).where("n > 1"))
    more = repeated.groupBy("g", block.alias("block")).agg(F.collect_list(F.struct("doc_id", (F.col("n") - 1).alias("more"))).alias("more"))
    directory = checkpoint(common.running_total(checkpoint(bitmaps.join(more, ["g", "block"], "left")), [F.col("g"), F.col("block")], "n", "before"))
    nulls = leaves.where("doc_id is null").groupBy("g").agg(F.sum("copies").alias("nulls"))
    start = directory.groupBy("g").agg(F.min("before").alias("start")).join(nulls, "g", "left").select("g", (F.coalesce("nulls", F.lit(0)) - F.col("start")).alias("shift"))
    directory = directory.join(start, "g").withColumn("before", F.col("before") + F.col("shift")).drop("shift", "n")

    below = F.lit(0).cast("long")
    for w in range(WORDS):
        word, at = F.col(f"w{w}"), F.shiftright(bit, 6)
        own = F.bit_count(word.bitwiseAND(F.expr("~shiftleft(-1L, cast(doc_id & 63 as int))")))
        below = below + F.when(at > w, F.bit_count(word)).when(at == w, own).otherwise(0)
    extra = F.when(F.col("more").isNull(), 0).otherwise(F.aggregate("more", F.lit(0).cast("long"), lambda a, x: a + F.when(x["doc_id"] < F.col("doc_id"), x["more"]).otherwise(0)))

    tied = repeated.where("leaves > 1").select("g", "doc_id", F.lit(True).alias("tied"))
    ranked = named.withColumn("block", block).join(directory, ["g", "block"]).withColumn("idx", F.col("before") + below + extra)
    ranked = checkpoint(ranked.select(*leaves.columns, "idx").join(tied, ["g", "doc_id"], "left"))
    alone = ranked.where("tied is null").select(*leaves.columns, "idx")
    shared = ranked.where("tied").select(*leaves.columns, "idx").union(leaves.where("doc_id is null").withColumn("idx", F.lit(0).cast("long")))
    return alone.union(_ties(shared).select(*leaves.columns, (F.col("idx") + F.col("tie")).alias("idx")))


def proofs(docs: DataFrame, tampered: Column, with_siblings: bool = False) -> DataFrame:
    """Per row (doc_id, idx, leaf, subroot, root, slots, proof_sha256, folded_root, verified, siblings).

    ``tampered`` is an expression over the columns doc_id, source, lang, n_chars and text: the text that is
    folded instead, or null where the row's own text is. ``idx`` is the leaf's coordinate in its lang,
    ``slots`` one byte a level, ``siblings`` the siblings' digests by level (null unless asked for).
    """
    x = docs.select(*(F.col(f).cast("long" if f == "doc_id" else "string").alias(f) for f in FIELDS))
    values = {f: F.col(f).cast("string") for f in FIELDS}
    changed = F.when(F.col("changed").isNotNull(), leaf_hash(**(values | {"text": F.col("changed")})))
    leaves = x.withColumn("changed", tampered).select("doc_id", "lang", leaf_hash(**values).alias("leaf"), changed.alias("tampered"))
    leaves = checkpoint(leaves.groupBy("doc_id", "lang", "leaf", "tampered").agg(F.count("*").alias("copies")))
    langs = numbered_langs(leaves)
    small = broadcast_if_small(langs)
    leaves = leaves.join(small.select(F.col("lang").alias("_lang"), "g"), F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang", "lang")
    placed = coordinates(leaves)
    # a row's copies take the coordinates from its own on, in steps so that no array is long
    each = 1 << 16
    placed = placed.withColumn("step", F.explode(F.expr(f"sequence(0L, (copies - 1) div {each})")))
    placed = placed.withColumn("copy", F.explode(F.expr(f"sequence(step * {each}, least(copies, (step + 1) * {each}) - 1)")))
    placed = checkpoint(placed.select("g", (F.col("idx") + F.col("copy")).alias("idx"), F.col("leaf").alias("hash"), "doc_id", "tampered"))

    trees = small.select("g", "height")
    levels = reduce_levels(placed, trees)
    one = checkpoint(langs.agg(F.lit(0).cast("long").alias("g"), height(F.count("*")).alias("height")))
    tops = reduce_levels(checkpoint(levels[-1].select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), "hash")), F.broadcast(one))
    root = tops[-1].select(F.col("g"), F.col("idx"), F.unhex(F.lit("")).alias("slots"), F.array().cast("array<string>").alias("siblings"), F.lit("").alias("subroot"), F.lower(F.hex("hash")).alias("root"))
    way = hand_down(tops, root, F.broadcast(one)).select(F.col("idx").alias("g"), "slots", "siblings", "root")
    # every lang's last level has its subroot alone
    way = levels[-1].join(way, "g").select("g", "idx", "slots", "siblings", F.lower(F.hex("hash")).alias("subroot"), "root")
    if len(levels) > 1:
        way = hand_down(levels[1:], way, small.select("g", (F.col("height") - PASS).alias("height")))
    out = _by_block(_headed(placed, way, trees, 0), _prove(with_siblings), _PROOF)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
