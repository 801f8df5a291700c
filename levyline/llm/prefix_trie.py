"""Prefix tree of conversations: which conversations share their first turns, and what sharing them saves.

A node is a distinct sequence of first turns. Its name is the exclusive or of 128 random bits per (turn, depth), so names are running
aggregates and no prefix is ever built as text. Sums over subtrees go by bands of `HEIGHT` depths: a node gives its
value only to its ancestors inside its band, added up along the path before anything is shuffled; the totals of the bands' top nodes
come from the same step on the tree of top nodes, which is `HEIGHT` times flatter, and then count as values at
their parents. So a tree of depth n takes log(n) steps to the base HEIGHT, and no node gives out more than HEIGHT rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyline.llm.turns import digest, numbered, placed
from levyline.session import written

HEIGHT = 32
SHARED = 5  # turns that a conversation may take over at most
FAMILY = 100  # conversations of one head
NODE = ["depth", "a", "b"]


def light(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, chars; null roles and texts are empty, rows without a conversation are left out."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest(role, text).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )


def shared_heads(turns: DataFrame, label: str = "trie") -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first one of their hundred does, as (turns, lengths).

    Conversation c takes the first h turns of conversation c - c % 100 (none if there is no such), h = crc32(c) % 6, and goes on with its own
    turns after its first h. turns: conv_id, depth (from 1), digest, chars; lengths: conv_id, n_turns, 0 included.
    """
    rows = written(numbered(placed(turns, f"{label}-placed")), f"{label}-turns")
    h = F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)
    lengths = rows.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h)
    heads = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    lengths = lengths.withColumn("of", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, F.col("of") == F.col("base"), "left")
    lengths = written(lengths.select("conv_id", "of", "n", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), f"{label}-lengths")
    own = rows.filter(F.col("position") > h).join(lengths.select("conv_id", "taken"), "conv_id")
    own = own.select("conv_id", (F.col("position") - h + F.col("taken")).alias("depth"), "digest", "chars")
    first = rows.filter(F.col("position") <= SHARED).select(F.col("conv_id").alias("of"), "position", "digest", "chars")
    head = lengths.select("conv_id", "of", "taken").join(first, "of").filter("position <= taken")
    head = head.select("conv_id", F.col("position").alias("depth"), "digest", "chars")
    n_turns = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return own.unionByName(head), lengths.select("conv_id", n_turns.alias("n_turns"))


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every prefix of every conversation: conv_id, depth, its name (a, b), its parent's name (pa, pb), chars of its last turn, and whether the conversation ends here."""
    rows = turns.withColumn("band", F.floor(F.col("depth") / HEIGHT))
    for name, seed in (("a", 1), ("b", 2)):
        rows = rows.withColumn(f"k{name}", F.xxhash64(F.lit(seed), "digest", "depth"))
    inside = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("a", F.bit_xor("ka").over(inside)).withColumn("b", F.bit_xor("kb").over(inside))
    bands = rows.groupBy(F.col("conv_id").alias("b_conv"), F.col("band").alias("b_band")).agg(F.bit_xor("ka").alias("xa"), F.bit_xor("kb").alias("xb"))
    earlier = Window.partitionBy("b_conv").orderBy("b_band").rowsBetween(Window.unboundedPreceding, -1)
    for name in ("xa", "xb"):
        bands = bands.withColumn(f"{name}_before", F.coalesce(F.bit_xor(name).over(earlier), F.lit(0)))
    bands = bands.filter("b_band > 0")  # nothing comes before the first band
    rows = rows.join(bands, (F.col("conv_id") == F.col("b_conv")) & (F.col("band") == F.col("b_band")), "left")
    for name in ("a", "b"):
        rows = rows.withColumn(name, F.col(name).bitwiseXOR(F.coalesce(f"x{name}_before", F.lit(0))))
    rows = rows.select(
        "conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("ka")).alias("pa"), F.col("b").bitwiseXOR(F.col("kb")).alias("pb"), "chars"
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    top = lengths.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("chars"))
    ends = lengths.select(F.col("conv_id").alias("e_conv"), "n_turns")
    joined = rows.unionByName(top).join(ends, F.col("conv_id") == F.col("e_conv"))
    return joined.withColumn("ends", F.col("depth") == F.col("n_turns")).drop("e_conv", "n_turns")


def subtree_sums(values: DataFrame, paths: DataFrame, deepest: int, names: list[str], height: int = HEIGHT, label: str = "trie") -> DataFrame:
    """depth, a, b and, under `names`, the sums of the values of every node and all below it.

    paths: conv_id, depth, a, b for every depth from 0 to the conversation's end; values: conv_id, depth and the value columns, each
    meant for the node that the conversation's path has at that depth. Nodes with no value in their subtree are left out.
    """
    def sums():
        return [F.sum(c).alias(c) for c in names]

    if deepest >= height:
        flat = values.groupBy("conv_id", F.floor(F.col("depth") / height).alias("depth")).agg(*sums())
        tops = paths.filter(F.col("depth") % height == 0).select("conv_id", (F.col("depth") / height).cast("long").alias("depth"), "a", "b")
        done = subtree_sums(flat, tops, deepest // height, names, height, f"{label}-up")
        above = done.filter("depth > 0").select("conv_id", (F.col("depth") * height - 1).alias("depth"), *names)
        values = values.select("conv_id", "depth", *names).unionByName(above).groupBy("conv_id", "depth").agg(*sums())
    v = values.select(F.col("conv_id").alias("v_conv"), F.col("depth").alias("v_depth"), *names)
    rows = paths.join(v, (F.col("conv_id") == F.col("v_conv")) & (F.col("depth") == F.col("v_depth")), "left")
    below = Window.partitionBy("conv_id", F.floor(F.col("depth") / height)).orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    given = rows.select("conv_id", *NODE, *(F.sum(c).over(below).alias(c) for c in names)).filter(F.col(names[0]).isNotNull())
    return written(given.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *sums()), f"{label}-sums")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node over its blocks of ids, which come in order; only the running hash is held."""
    mark, state, out = None, None, []
    for batch in batches:
        for *node, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if node != mark:
                if mark is not None:
                    out.append((*mark, state.hexdigest()))
                mark, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if len(out) >= 10_000:
            yield _hashed(out)
            out = []
    if mark is not None:
        out.append((*mark, state.hexdigest()))
    yield _hashed(out)


def _hashed(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*NODE, "ends_sha256"])


def ends_digest(prefix_rows: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256: the hash of the ids, ascending and joined by commas, of the conversations that end at a node.

    Ids are joined in blocks of 4,096 numbers first, so the task that hashes a node reads few rows and holds one block.
    """
    block = F.shiftright("conv_id", 12).alias("block")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = prefix_rows.filter("ends").groupBy(*NODE, block).agg(ids.alias("ids"))
    inside = blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids")
    return inside.mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")


def nodes(turns: DataFrame, lengths: DataFrame, label: str = "trie", height: int = HEIGHT) -> DataFrame:
    """One row per node of the prefix tree.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    turns: conv_id, depth, digest, chars, depths from 1 without gaps; lengths: conv_id, n_turns. A conversation without turns is a member
    of the root alone. No conversations give no rows. Turns are equal if their 256-bit digests are.
    """
    paths = written(prefixes(turns, lengths), f"{label}-paths")
    tree = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"),
    )
    tree = written(tree, f"{label}-nodes")
    counts = tree.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    tree = tree.join(counts.agg(F.count("*").alias("n_children")), NODE, "left").fillna(0, ["n_children"])
    saved, leaf = (F.col("n_convs") - 1) * F.col("chars"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    tree = written(tree.withColumn("saved_tokens", saved).withColumn("n_leaves", leaf), f"{label}-tree")
    deepest = tree.agg(F.max("depth")).first()[0]
    names = ["saved_tokens", "n_leaves"]
    if deepest is None:
        totals = tree.select(*NODE, *names)
    else:
        totals = subtree_sums(tree.select("conv_id", "depth", *names), paths.select("conv_id", *NODE), deepest, names, height, label)
    above = tree.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    whole = tree.drop(*names).join(totals.select(*NODE, *names), NODE).join(above, ["depth", "pa", "pb"], "left").join(ends_digest(paths), NODE, "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )

