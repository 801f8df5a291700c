"""Joins against a table with one row per key that survive a key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 1 / 256


def hot_keys(counts: DataFrame, key: str, n: str, share: float = HOT_SHARE, tasks: int = 2) -> DataFrame:
    """Keys holding more than `share` of all rows, at most 1 / share of them, and how many of `tasks` even tasks they fill."""
    total = counts.agg(F.sum(n).alias("total")).scalar()
    own = F.greatest(F.lit(2), F.ceil(F.col(n) * F.lit(tasks) / total)).cast("int")
    return counts.where(F.col(n) > total * F.lit(share)).select(F.col(key).alias("_hot"), own.alias("_salts"))


def salted_lookup(
    left: DataFrame, right: DataFrame, key: str, row_id: Column,
    counts: DataFrame | None = None, n: str = "n", salts: int | None = None, share: float = HOT_SHARE,
) -> DataFrame:
    """LEFT JOIN of `left` to `right` (one row per `key`), hot keys spread over tasks by their share of the rows.

    `salts` is the number of tasks that all rows would fill, twice the shuffle partitions by default.

    `counts` has the rows of `left` per key; when the caller has none it is computed, which reads
    the key column once more. The broadcast set of hot keys is bounded by 1 / share rows. The salt
    hashes `row_id`, so a retried task gives the same rows. NULL keys are spread as well.
    """
    if counts is None:
        counts, n = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")), "n"
    salts = salts or 2 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(counts, key, n, share, salts))
    own = F.when(F.col(key).isNull(), F.lit(salts)).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = F.pmod(F.xxhash64(row_id), own).cast("int")
    salted_left = left.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", spread).drop("_hot", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = (
        right.where(F.col(key).isNotNull()).join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", F.explode(copies)).drop("_hot", "_salts")
    )
    return salted_left.join(salted_right, [key, "_salt"], "left").drop("_salt")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in `order`, which should end in a tie-break.

    The rank filter lets Spark drop all but one row per key and task before the shuffle, so a key
    with many copies does not collect in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
