"""Chat formatting: reply trees, their root-to-leaf paths and one text per chosen path.

A message names its parent. Iterative self-joins double the distance that is known of every message's ancestors, so a
chain of n messages takes log2(n) joins. The branch of a leaf is ranked by the sum of the scores on its path, and each
chosen path becomes one text in which every turn is marked and the control strings inside texts are escaped.

Only built-in column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyline.session import written

# The template: a turn is OPEN role NEWLINE text CLOSE. "<" starts every control string and "&" every escape.
OPEN, CLOSE = "<s>", "</s>"


def escaped(text: Column, in_role: bool = False) -> Column:
    """Text in which no control string can occur; `unescaped` gives back the original."""
    out = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit("\n"), F.lit("&#10;")) if in_role else out


def unescaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("&#10;"), F.lit("\n")), F.lit("&lt;"), F.lit("<"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def reply_chain(rows: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as messages in which each row answers the one before it.

    Rows of one conversation that share a turn follow each other by role and text. Null conversations are one
    conversation with a null id; a null turn comes first; a null role or text is empty. Other columns are left out.
    """
    turns = rows.select(
        F.col("conv_id").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    node = F.row_number().over(order)
    return turns.select(
        "tree", node.cast("long").alias("node"), F.when(node > 1, node - 1).cast("long").alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def _ancestors(links: DataFrame, label: str) -> DataFrame:
    """Rows (tree, leaf, node, dist): each leaf with every message on its way to the root.

    Two tables double in reach with every self-join: the jump from a message to its 2^k-th ancestor, and the messages
    found so far of each leaf. A parent that does not exist ends a path; so does one that is not older (of a smaller
    number) than its reply, which keeps loops out.
    """
    up = links.filter("parent < node").select("tree", F.col("parent").alias("node")).distinct()
    leaves = links.join(
        up, links.tree.eqNullSafe(up.tree) & (links.node == up.node), "left_anti"
    ).select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("dist"))
    jump = links.filter("parent < node").select("tree", "node", F.col("parent").alias("above"))
    known = links.select("tree", F.col("node").alias("above"))
    jump = jump.join(known.alias("k"), jump.tree.eqNullSafe(F.col("k.tree")) & (jump.above == F.col("k.above")), "left_semi")
    found, reach = written(leaves, f"{label}-paths"), 1
    jump = written(jump, f"{label}-jumps")
    while not jump.isEmpty():
        j = jump.select(F.col("tree").alias("j_tree"), F.col("node").alias("j_node"), F.col("above").alias("j_above"))
        longer = found.join(j, found.tree.eqNullSafe(F.col("j_tree")) & (found.node == F.col("j_node"))).select(
            "tree", "leaf", F.col("j_above").alias("node"), (F.col("dist") + reach).alias("dist")
        )
        found = written(found.unionByName(longer), f"{label}-paths")
        jump = written(
            jump.join(j, jump.tree.eqNullSafe(F.col("j_tree")) & (jump.above == F.col("j_node")))
            .select("tree", "node", F.col("j_above").alias("above")),
            f"{label}-jumps",
        )
        reach *= 2
    return found


def branches(messages: DataFrame, best: int = 1, label: str = "replies") -> DataFrame:
    """The `best` branches of every tree: rows (tree, branch_rank, leaf, score, turns), turns from root to leaf.

    messages: tree, node (long), parent (null for a root), role, text, score; other columns are left out. Trees may have
    several roots. Ties of the branch score go to the smaller leaf. A null score counts as 0. Of rows that share tree and
    node the least by parent, role and text stays; rows without a node are left out.
    """
    row = F.min(F.struct("parent", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("row")
    messages = messages.filter("node IS NOT NULL").groupBy("tree", "node").agg(row).select("tree", "node", "row.*")
    messages = written(messages, label)
    paths = _ancestors(messages.select("tree", "node", "parent"), label)
    sums = messages.select(F.col("tree").alias("m_tree"), F.col("node").alias("m_node"), "score")
    scored = (
        paths.join(sums, paths.tree.eqNullSafe(F.col("m_tree")) & (paths.node == F.col("m_node")))
        .groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    )
    by_score = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = scored.withColumn("branch_rank", F.row_number().over(by_score)).filter(F.col("branch_rank") <= best)
    chosen = chosen.select(F.col("tree").alias("c_tree"), F.col("leaf").alias("c_leaf"), F.col("score").alias("branch_score"), "branch_rank")
    steps = paths.join(chosen, paths.tree.eqNullSafe(F.col("c_tree")) & (paths.leaf == F.col("c_leaf"))).select(
        "tree", "leaf", "node", "dist", "branch_rank", "branch_score"
    )
    texts = messages.select(F.col("tree").alias("m_tree"), F.col("node").alias("m_node"), "role", "text")
    whole = steps.join(texts, steps.tree.eqNullSafe(F.col("m_tree")) & (steps.node == F.col("m_node")))
    turn = F.struct((-F.col("dist")).alias("at"), "role", "text")
    return whole.groupBy("tree", "leaf", "branch_rank").agg(
        F.first("branch_score").alias("score"), F.sort_array(F.collect_list(turn)).alias("turns")
    )


def format_branches(chosen: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """One text per branch with its loss mask: (tree, branch_rank, text, loss_spans).

    loss_spans are pairs of code points [start, end) of `text` that hold the escaped texts of `learn_role`.
    """
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escaped(t.role, True), F.lit("\n")).alias("head"),
        escaped(t.text).alias("body"), (t.role == learn_role).alias("learn"),
    ))
    # the start of a body is the length of all before it: 3 lists of equal length, no list grows inside another
    sizes = F.transform("parts", lambda p: F.length(p.head) + F.length(p.body) + F.lit(len(CLOSE)))
    ends = F.aggregate(
        "sizes", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda acc, x: F.struct((acc.at + x).alias("at"), F.array_append(acc.starts, acc.at).alias("starts")),
        lambda acc: acc.starts,
    )
    spans = F.transform(
        F.filter(F.arrays_zip("parts", "starts"), lambda z: z.parts.learn),
        lambda z: F.struct(
            (z.starts + F.length(z.parts.head)).alias("start"),
            (z.starts + F.length(z.parts.head) + F.length(z.parts.body)).alias("end"),
        ),
    )
    text = F.array_join(F.transform("parts", lambda p: F.concat(p.head, p.body, F.lit(CLOSE))), "")
    return (
        chosen.withColumn("parts", parts).withColumn("sizes", sizes).withColumn("starts", ends)
        .select("tree", "branch_rank", text.alias("text"), spans.alias("loss_spans"))
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Formatted texts as turns and as the text under the loss mask, both unescaped: (tree, branch_rank, text, turns, loss)."""
    pieces = F.filter(F.split("text", CLOSE, -1), lambda p: p.startswith(OPEN))
    turns = F.transform(pieces, lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, F.lit(len(OPEN) + 1), F.length(p)), "\n", 1)).alias("role"),
        unescaped(F.substring(p, F.position(F.lit("\n"), p) + 1, F.length(p))).alias("text"),
    ))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("text"), s.start + 1, s.end - s.start))), "")
    return formatted.select("tree", "branch_rank", "text", turns.alias("turns"), loss.alias("loss"))
