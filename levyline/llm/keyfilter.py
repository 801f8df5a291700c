"""A join reducer: a bitmap of hashed keys, by which rows that certainly have no partner skip the shuffle.

The bitmap has `BITS` bits whatever the data, as rows of 64 bits, so broadcasting it is bounded. Hashes may collide, so
rows that pass still have to be joined; the more keys, the more rows pass, and never is one lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.llm.textsets import free_names
from levyline.session import written

BITS = 2**24


def with_maybe_among(rows: DataFrame, column: Column, keys: DataFrame, flag: str) -> DataFrame:
    """`rows` with the boolean column `flag`: false only if no row of the one long column of `keys` has the value of `column`.

    The bitmap is a broadcast table and no Python function: that would start a second worker in tasks that run another one.
    """
    slot, word, bits = free_names(rows, "slot", "word", "bits")
    (name,) = keys.columns

    def slot_of(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(BITS))

    bit = F.expr(f"shiftleft(1L, cast(`{slot}` % 64 as int))")
    words = keys.select(slot_of(F.col(f"`{name}`")).alias(slot)).groupBy(F.shiftright(slot, 6).alias(word)).agg(F.bit_or(bit).alias(bits))
    words = F.broadcast(written(words, "key-bits"))
    placed = rows.withColumn(slot, slot_of(column)).withColumn(word, F.shiftright(slot, 6)).join(words, word, "left")
    known = F.coalesce(F.col(bits), F.lit(0)).bitwiseAND(bit) != 0
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], known.alias(flag))
