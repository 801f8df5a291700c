"""Joins on a key and event time: the interval join and the as-of lookup.

Both cut time into buckets and make the bucket part of the join key. A key that holds a large
share of all rows is then spread over as many tasks as it has buckets, instead of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _seconds(column) -> Column:
    return F.unix_seconds(F.col(column) if isinstance(column, str) else column)


def interval_left_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str,
    before_seconds: int, after_seconds: int, left_id: str, bucket_seconds: int | None = None,
) -> DataFrame:
    """LEFT JOIN on the key and `right_time BETWEEN left_time - before AND left_time + after`.

    A left row lies in exactly one bucket; a right row is copied to each bucket its interval
    touches (one or two with the default bucket), so every pair meets exactly once and an
    unmatched left row comes out exactly once. NULL keys can match nothing; they get a key of
    their own so that they do not gather in one task. Works on two watermarked streams as well.
    """
    bucket = bucket_seconds or 2 * (before_seconds + after_seconds)
    keyed_left = left.withColumn(
        "_bucket", F.floor(_seconds(left_time) / F.lit(bucket))
    ).withColumn(
        "_key", F.coalesce(F.col(left_key), F.concat(F.lit("\u0000"), F.col(left_id)))
    )
    first = F.floor((_seconds(right_time) - F.lit(after_seconds)) / F.lit(bucket))
    last = F.floor((_seconds(right_time) + F.lit(before_seconds)) / F.lit(bucket))
    keyed_right = right.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull()).withColumn(
        "_right_bucket", F.explode(F.sequence(first, last))
    )
    within = F.expr(
        f"{right_time} BETWEEN {left_time} - INTERVAL {before_seconds} SECONDS "
        f"AND {left_time} + INTERVAL {after_seconds} SECONDS"
    )
    return keyed_left.join(
        keyed_right,
        (F.col("_key") == F.col(right_key)) & (F.col("_bucket") == F.col("_right_bucket")) & within,
        "left",
    ).drop("_key", "_bucket", "_right_bucket")


BUCKET = 6 * 3600


def _bucket(second: Column, bucket_seconds: int) -> Column:
    return F.floor(second / F.lit(bucket_seconds))


def _moments(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, copies: Column, bucket_seconds: int,
) -> DataFrame:
    """One row per key, bucket and second: the right row of that second and whether a left row asks for it.

    `copies` is the array of buckets a right row belongs to. The aggregate runs before the shuffle
    as well, so many rows of one key and second travel as one; a (key, bucket) group holds at most
    one row per second of the time it covers, whatever the input.
    """
    values = [c for c in right.columns if c != key]
    row = F.struct(_seconds(right_time).alias("_t"), *values)
    offered = (
        right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull())
        .select(key, _seconds(right_time).alias("_at"), row.alias("_row"))
        .select(key, F.explode(copies).alias("_bucket"), "_at", "_row", F.lit(False).alias("_asked"))
    )
    asked = (
        left.where(F.col(key).isNotNull() & F.col(left_time).isNotNull())
        .select(key, _seconds(left_time).alias("_at"))
        .select(key, _bucket(F.col("_at"), bucket_seconds).alias("_bucket"), "_at",
                F.lit(None).cast(offered.schema["_row"].dataType).alias("_row"), F.lit(True).alias("_asked"))
    )
    return offered.unionByName(asked).groupBy(key, "_bucket", "_at").agg(
        F.max("_row").alias("_row"), F.max("_asked").alias("_asked")
    )


def _around(moments: DataFrame, key: str) -> DataFrame:
    """Adds the nearest right row at or before, and at or after, each moment of its bucket.

    Both are running frames, one per direction: a frame that reaches to the end of the group would
    be walked again for every row.
    """
    group = Window.partitionBy(key, "_bucket")
    nearest = F.last("_row", ignorenulls=True)

    def running(order: Column):
        return group.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    return moments.withColumns({
        "before": nearest.over(running(F.asc("_at"))), "after": nearest.over(running(F.desc("_at"))),
    })


def _attach(left: DataFrame, found: DataFrame, key: str, left_time: str) -> DataFrame:
    """Back to the left rows; NULL keys or times simply find nothing."""
    seen = found.withColumnRenamed("_at", "_found_at").withColumnRenamed(key, "_found_key")
    return left.join(
        seen, (F.col(key) == F.col("_found_key")) & (_seconds(left_time) == F.col("_found_at")), "left"
    ).drop("_found_key", "_found_at")


def asof_left_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, bucket_seconds: int = BUCKET,
) -> DataFrame:
    """Each left row with a struct `found`: the newest right row of its key at or before its time.

    No pairs are formed. Inside a bucket a running last finds the row; what lies further back comes
    from a table with the last row of each key and bucket, which is small: one row per bucket.
    """
    here = F.array(_bucket(F.col("_at"), bucket_seconds))
    moments = _moments(left, right, key, left_time, right_time, here, bucket_seconds)
    inside = _around(moments, key).where(F.col("_asked")).select(key, "_bucket", "_at", "before")
    ends = moments.groupBy(key, "_bucket").agg(F.max(F.when(F.col("_row").isNotNull(), F.struct("_at", "_row")))["_row"].alias("_end"))
    along = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "_bucket", F.last("_end", ignorenulls=True).over(along).alias("_earlier"))
    found = inside.join(carried, [key, "_bucket"], "left").select(
        key, "_at", F.coalesce("before", "_earlier").alias("found")
    )
    return _attach(left, found, key, left_time)


def nearest_left_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    before_seconds: int, after_seconds: int, bucket_seconds: int | None = None,
) -> DataFrame:
    """Each left row once, with a struct `found`: the right row closest in time within the interval.

    Of two equally close rows the later one is taken. Right rows are copied to the buckets their
    interval touches, so a bucket sees everything its left rows may match; no pairs are formed.
    """
    bucket = bucket_seconds or 2 * (before_seconds + after_seconds)
    touched = F.sequence(
        _bucket(F.col("_at") - after_seconds, bucket), _bucket(F.col("_at") + before_seconds, bucket)
    )
    moments = _moments(left, right, key, left_time, right_time, touched, bucket)
    near = _around(moments, key).where(F.col("_asked"))
    gap_before = F.col("_at") - F.col("before._t")
    gap_after = F.col("after._t") - F.col("_at")
    has_before = F.coalesce(gap_before <= before_seconds, F.lit(False))
    has_after = F.coalesce(gap_after <= after_seconds, F.lit(False))
    found = (
        F.when(has_after & (~has_before | (gap_after <= gap_before)), F.col("after"))
        .when(has_before, F.col("before"))
    )
    return _attach(left, near.select(key, "_at", found.alias("found")), key, left_time)
