"""Running totals and ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def range_bounds(df: DataFrame, column: str, n_ranges: int) -> list[float]:
    """At most n_ranges - 1 cut points that split the values about evenly."""
    steps = [i / n_ranges for i in range(1, n_ranges)]
    if not steps:
        return []
    row = df.agg(F.percentile_approx(column, steps, 10_000)).first()
    return sorted({float(x) for x in (row[0] or [])})


def running_totals(df: DataFrame, order: str, sums: dict[str, str], n_ranges: int | None = None) -> DataFrame:
    """Adds running sums from the highest value of `order` (a number, unique per row) downward.

    The values are cut into ranges; sums per range (one row each) give the offsets, and only the
    rows of one range are sorted together. The cut points are fixed up front, so a retried task
    puts every row in the same range.
    """
    spark = df.sparkSession
    bounds = range_bounds(df, order, n_ranges or spark.sparkContext.defaultParallelism)
    if bounds:
        splits = [float("-inf"), *bounds, float("inf")]
        cut = Bucketizer(splits=splits, inputCol="_order", outputCol="_range", handleInvalid="keep")
        ranged = cut.transform(df.withColumn("_order", F.col(order).cast("double"))).drop("_order")
    else:
        ranged = df.withColumn("_range", F.lit(0.0))
    per_range = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    # one row per range: a window over all of them stays small
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "_range", *[F.coalesce(F.sum(f"_sum_{c}").over(above), F.lit(0)).alias(f"_before_{c}") for c in sums]
    )
    inside = Window.partitionBy("_range").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_local_{c}") for c in sums])
    joined = local.join(F.broadcast(offsets), "_range")
    return joined.select(
        *df.columns, *[(F.col(f"_local_{c}") + F.col(f"_before_{c}")).alias(name) for c, name in sums.items()]
    )


def hash_ranked(df: DataFrame, id_col: str, group: str, seed: int, bits: int = 12) -> DataFrame:
    """Adds `hash_rank` (1-based, random but reproducible) and `group_size` within each value of `group`.

    `group` is a class label with a handful of values, so ranking by a window on it alone would put
    a whole class in one task. The top bits of the hash cut each class into 2**bits even slices;
    their sizes (at most values x 2**bits rows) give the offsets and only slices are sorted.
    `id_col` must be unique within the table.
    """
    sliced = df.withColumn("_hash", F.xxhash64(F.col(id_col), F.lit(seed))).withColumn(
        "_slice", F.shiftrightunsigned("_hash", 64 - bits)
    )
    sizes = sliced.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(group).orderBy("_slice")
    offsets = sizes.select(
        F.col(group).alias("_group"), F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(group)).alias("group_size"),
    )
    place = F.row_number().over(Window.partitionBy(group, "_slice").orderBy("_hash", id_col))
    return (
        sliced.withColumn("_place", place)
        .join(F.broadcast(offsets), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_of")))
        .withColumn("hash_rank", F.col("_before") + F.col("_place"))
        .drop("_hash", "_slice", "_place", "_group", "_of", "_before")
    )
