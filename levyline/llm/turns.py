"""Turns of conversations in order, without a task that has to hold a whole conversation.

Rows are dealt out by ranges of (conversation, turn, role, digest) and sorted inside the range, so a conversation with very many turns
lies in many tasks, one piece after the other. Texts are not sorted: a digest stands for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyline.session import written

PART_BITS = 33  # monotonically_increasing_id: the task above these bits, the row inside the task below


def digest(role: Column, text: Column) -> Column:
    """32 bytes that stand for a role and a text."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def placed(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a table with a `place` (long) that counts up in the order of conv_id, turn (nulls first), role and digest.

    Places of one conversation follow each other without a gap inside a task; equal rows follow each other in any order.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    inside = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(inside.withColumn("place", F.monotonically_increasing_id()), label)


def numbered(rows: DataFrame) -> DataFrame:
    """Placed rows with their `position` in the conversation, from 1. Counts of pieces are added up, rows are not sorted again."""
    rows = rows.withColumn("part", F.shiftright("place", PART_BITS))
    pieces = rows.groupBy(F.col("conv_id").alias("p_conv"), F.col("part").alias("p_part")).agg(
        F.min("place").alias("p_first"), F.count("*").alias("p_n")
    )
    earlier = Window.partitionBy("p_conv").orderBy("p_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("p_before", F.coalesce(F.sum("p_n").over(earlier), F.lit(0)))
    joined = rows.join(pieces, rows.conv_id.eqNullSafe(F.col("p_conv")) & (rows.part == F.col("p_part")))
    position = F.col("place") - F.col("p_first") + F.col("p_before") + 1
    return joined.withColumn("position", position).drop("part", "p_conv", "p_part", "p_first", "p_n", "p_before")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Lists of rows that share the keys, from batches in which such rows follow each other."""
    held, mark = [], None
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[k] for k in keys)
            if held and now != mark:
                yield held
                held = []
            mark = now
            held.append(row)
    if held:
        yield held
