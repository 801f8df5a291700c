"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same share of copies, target / size of the source. Its whole part is taken as it is. The
fractional parts are rounded together: two documents meet, words move from one to the other by a fair random choice until
one of them is whole, and the other goes on. So the words that a source takes stay what they were, up to the
last document. Blocks of documents are rounded side by side, and what each block leaves over meets in the blocks of the
next level, a reduction tree with one document per source at its root.

Only built-in column functions are used; chances are hashes, so that reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyline.llm.textsets import free_names, own_columns
from levyline.session import written

BLOCK = 128  # documents that meet in one block
WORD = r"[^\x20\x09-\x0D]+"
_NEAR = 1e-9  # a share this close to 0 or 1 counts as whole


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target: one row per source of (source, size).

    Sources in code-point order, null last, take the weights in turn. Targets share `share` times all words by
    weight; none is above `most` times its source, and what is cut off is shared again. That is one level L with
    target = min(most * size, L * weight), found with a running sum over the sources by size per weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(everything) - 1) % len(weights) + 1).cast("int"))
    rows = totals.withColumn("weight", weight).withColumn("top", F.col("source_size") * most)
    whole = Window.partitionBy()
    by_top = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_top.rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / (
        F.sum("weight").over(by_top.rowsBetween(0, Window.unboundedFollowing)))
    # the first source whose top lies above the level that the rest would share fixes the level
    levels = rows.withColumn("level", level).withColumn("open", F.col("top") > F.col("level") * F.col("weight"))
    fixed = levels.withColumn("fixed", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_top.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("fixed").isNull(), F.col("top")).otherwise(F.least("top", F.col("fixed") * F.col("weight")))
    return fixed.select("source", "source_size", target.alias("target"))


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its arguments."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def _meet(level: int, seed: int):
    """One step inside a block: the held document meets the next; gives (held, those that became whole)."""

    def step(acc, new):
        old = acc.held
        old_words, new_words = old.p * old.size, new.p * new.size
        to_old = F.least(old.size - old_words, new_words)  # words that can move from new to old
        to_new = F.least(old_words, new.size - new_words)
        up = _chance(F.lit(seed), F.lit(level), old.id, new.id, old.size, new.size) * (to_old + to_new) < to_new
        moved = F.when(up, to_old).otherwise(-to_new)
        old_p, new_p = (old_words + moved) / old.size, (new_words - moved) / new.size
        old_done = (old_p < _NEAR) | (old_p > 1 - _NEAR)
        item = lambda d, p: F.struct(d.id.alias("id"), d.tie.alias("tie"), d.size.alias("size"), d.base.alias("base"), p.alias("p"))
        done = F.when(old_done, item(old, F.round(old_p))).otherwise(item(new, F.round(new_p)))
        held = F.when(old_done, item(new, new_p)).otherwise(item(old, old_p))
        return F.struct(held.alias("held"), F.array_append(acc.done, done).alias("done"))

    return step


def pivotal_copies(shares: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Whole copies per document: (source, id, tie, size, copies) of rows (source, id, tie, size, copies as a double).

    tie only tells rows with the same id apart. No document takes more than one copy above the whole part of its share.
    """
    base = F.floor("copies")
    rows = shares.select("source", "id", "tie", "size", base.cast("long").alias("base"), (F.col("copies") - base).alias("p"))
    rows = rows.withColumns({
        "base": F.col("base") + F.when(F.col("p") > 1 - _NEAR, 1).otherwise(0),
        "p": F.when((F.col("p") < _NEAR) | (F.col("p") > 1 - _NEAR) | (F.col("size") == 0), 0.0).otherwise(F.col("p"))})
    rows = written(rows, "mix-shares")
    finished = [rows.filter("p = 0").select("source", "id", "tie", "size", F.col("base").alias("copies"))]
    open_rows, level = rows.filter("p > 0"), 0
    schema = "array<struct<id:bigint,tie:bigint,size:bigint,base:bigint,p:double>>"
    while True:
        # one block per source at last: as many as its rows fill
        counts = open_rows.groupBy("source").agg(F.ceil(F.count("*") / block).alias("n_blocks"))
        most = counts.agg(F.max("n_blocks")).first()[0]
        if most is None:
            break
        number = F.pmod(F.xxhash64("id", "tie", F.lit(level), F.lit(seed)), F.col("n_blocks"))
        c = counts.select(F.col("source").alias("c_source"), "n_blocks")
        placed = open_rows.join(c, open_rows.source.eqNullSafe(F.col("c_source"))).withColumn("block", number)
        item = F.struct("id", "tie", "size", "base", "p")
        gathered = placed.groupBy("source", "block").agg(F.sort_array(F.collect_list(item)).alias("items"))
        start = F.struct(F.element_at("items", 1).alias("held"), F.array().cast(schema).alias("done"))
        met = F.aggregate(F.slice("items", 2, F.greatest(F.size("items") - 1, F.lit(1))), start, _meet(level, seed))
        met = written(gathered.select("source", met.alias("met")), "mix-level")
        done = met.select("source", F.explode("met.done").alias("d"))
        finished.append(done.select("source", "d.id", "d.tie", "d.size", (F.col("d.base") + F.col("d.p").cast("long")).alias("copies")))
        held = met.select("source", "met.held.*")
        whole = (F.col("p") < _NEAR) | (F.col("p") > 1 - _NEAR)
        if most == 1:  # the root: one document per source, rounded by itself
            up = (_chance(F.lit(seed), F.lit(-1), F.col("id"), F.col("tie")) < F.col("p")).cast("long")
            last = F.when(whole, F.round("p").cast("long")).otherwise(up)
            finished.append(held.select("source", "id", "tie", "size", (F.col("base") + last).alias("copies")))
            break
        finished.append(held.filter(whole).select("source", "id", "tie", "size", (F.col("base") + F.round("p").cast("long")).alias("copies")))
        open_rows, level = held.filter(~whole), level + 1
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def _mixed(docs: DataFrame, weights: Sequence[float], share: float, most: float, seed: int) -> DataFrame:
    """doc_id, tie (hash of the text), size, source_size, target, copies of every row of `docs`."""
    sized = written(docs.select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = written(source_targets(sized, weights, share, most), "mix-targets")
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    with_target = sized.join(t, sized.source.eqNullSafe(F.col("t_source"))).drop("t_source")
    shares = with_target.withColumn("copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    copies = pivotal_copies(shares, seed)
    return copies.join(t, copies.source.eqNullSafe(F.col("t_source"))).select(
        F.col("id").alias("doc_id"), "tie", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row of `docs` (doc_id, text, source; others are left out).

    A null text has size 0; null sources are one source, the last. Rows that repeat a doc_id are documents of their own; those
    alike in every column are interchangeable. An empty table gives no rows. taken = copies * size.
    """
    rows = _mixed(docs, weights, share, most, seed).drop("tie")
    return rows.withColumn("taken", F.col("copies") * F.col("size"))


def repeated(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """The rows of `docs`, with all their columns, each as often as the mix takes it. Rows without words are not taken."""
    rows = _mixed(docs, weights, share, most, seed).filter("size > 0")
    # rows alike in id and text share their copies evenly
    key, copies, alike, times, time = free_names(docs, "key", "copies", "alike", "times", "time")
    per_key = rows.groupBy(F.xxhash64("doc_id", "tie").alias(key)).agg(F.sum("copies").alias(copies), F.count("*").alias(alike))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", F.xxhash64("text"))).join(per_key, key)
    nth = F.row_number().over(Window.partitionBy(key).orderBy("source"))
    own = F.floor(F.col(copies) / F.col(alike)) + F.when(nth <= F.col(copies) % F.col(alike), 1).otherwise(0)
    many = keyed.withColumn(times, own).filter(F.col(times) > 0)
    return many.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*own_columns(docs))
