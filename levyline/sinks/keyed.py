"""A collection of points by id that can say which ids it lacks without reading itself.

Data folders are cut by a prefix of the hash of the id, so deep that a prefix holds some 20,000 points. Beside each folder lies a filter: a word of
64 bits for every four points, in which each id sets four bits. A batch of ids reads only the words it falls on, and opens only the data files whose words
hold all four bits of one of its ids: files that have the id, and one in some hundred that do not. What a batch reads follows the batch, and not the
collection; ids that are new open next to nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.sinks.manifest import GONE, ServingTable, Snapshot

ROWS_PER_PREFIX, ROWS_PER_WORD = 20_000, 4
WORDS = ROWS_PER_PREFIX // ROWS_PER_WORD
MOST_LISTED = 10_000  # prefixes or files named in one plan; beyond that a batch touches most of the collection anyway


def prefix_of(key: str, bits: int) -> Column:
    """The first bits of the hash of an id."""
    return F.shiftrightunsigned(F.shiftrightunsigned(F.xxhash64(key), 1), 63 - bits).cast("int") if bits else F.lit(0)


def word_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(WORDS)).cast("int")


def mask_of(key: str) -> Column:
    """Four of 64 bits."""
    h = F.xxhash64(F.lit(2), key)
    mask = F.lit(0).cast("long")
    for k in range(4):
        at = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return mask


class KeyedTable(ServingTable):
    """A serving table with one text column as its key. Keys are cut by prefix, one prefix per file and commit."""

    def __init__(self, spark, path: str, schema: str, key: str):
        super().__init__(spark, path, schema, [key])
        self.key = key

    def rows(self, at: Snapshot | None = None) -> DataFrame:
        return super().rows(at).drop("prefix")

    def lacking(self, ids: DataFrame, at: Snapshot | None = None) -> DataFrame:
        """The rows of `ids` whose key no live row has. Reads the filter words of these keys, and the keys of the files they point to."""
        at = at or self.snapshot()
        files = self.candidates(ids, at)
        if not files:
            return ids
        schema = f"{self.key} STRING, {GONE} BOOLEAN"
        if files is None or len(files) > MOST_LISTED:
            held = self.rows(at).where(~F.col(GONE)).select(self.key)
        else:
            paths = [f"{self.path}/data/seq={s}/prefix={p}" for s, p in files]
            held = self.spark.read.schema(schema).parquet(*paths).where(~F.col(GONE)).select(self.key)
        return ids.join(held, self.key, "left_anti")

    def candidates(self, ids: DataFrame, at: Snapshot) -> list[tuple[int, int]]:
        """(seq, prefix) of the data files that may hold one of the keys."""
        found = []
        keys = ids.select(self.key).distinct()
        for bits in sorted(set(at.layout.values())):
            asked = keys.select(prefix_of(self.key, bits).alias("prefix"), word_of(self.key).alias("word"), mask_of(self.key).alias("mask"))
            folders = [f"{self.path}/filter/seq={s}" for s in at.live if at.layout[s] == bits]
            words = self.spark.read.schema("prefix INT, word INT, bits BIGINT, seq BIGINT").option("basePath", f"{self.path}/filter").parquet(*folders)
            touched = [r[0] for r in asked.select("prefix").distinct().limit(MOST_LISTED + 1).collect()]
            if len(touched) <= MOST_LISTED:
                words = words.where(F.col("prefix").isin(touched))
            hits = words.join(asked, ["prefix", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
            # one row per file and prefix at most
            found += [(r.seq, r.prefix) for r in hits.select("seq", "prefix").distinct().collect()]
        return found

    def _store(self, rows: DataFrame, seq: int) -> int:
        rows = rows.persist()
        try:
            n = rows.count()
            bits = max(0, math.ceil(math.log2(max(1, n) / ROWS_PER_PREFIX)))
            placed = rows.withColumn("prefix", prefix_of(self.key, bits))
            placed.repartition("prefix").write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}/data/seq={seq}")
            words = placed.groupBy("prefix", word_of(self.key).alias("word")).agg(F.bit_or(mask_of(self.key)).alias("bits"))
            # sorted, so that readers of a few prefixes skip row groups and pages
            words.repartitionByRange("prefix", "word").sortWithinPartitions("prefix", "word").write.mode("overwrite").parquet(f"{self.path}/filter/seq={seq}")
        finally:
            rows.unpersist()
        return bits
