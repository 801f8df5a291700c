"""Incremental sync and full load of a vector collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from levyline.functions.text import uuid5
from levyline.operators.retrieval import Embedder, hashing_embedder, record_points
from levyline.operators.skew import latest_per_key
from levyline.sinks.keyed import KeyedTable
from levyline.sinks.serving import upsert_batch

POINT = (
    "application_id STRING, customer_id STRING, taxable_income DOUBLE, employment_type STRING, "
    "employment_status STRING, filing_status STRING, province STRING, risk_score DOUBLE, is_fraud BOOLEAN, "
    "processed_at STRING, vector ARRAY<DOUBLE>, point_id STRING"
)
POINT_COLUMNS = [part.strip().split(" ")[0] for part in POINT.split(", ")]


def points_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, POINT, "point_id")


def collection(spark: SparkSession, path: str) -> DataFrame:
    return points_table(spark, path).current()


def add_new(records: DataFrame, batch_id: int, path: str, embed: Embedder | None = None, stream: str = "sync") -> None:
    """Embed and store the records the collection lacks; the others never reach the embedder.

    What the collection has is asked of its filters, so a batch reads little of it however large it is. A batch that was committed
    before is left out when it comes again.
    """
    table = points_table(records.sparkSession, path)
    at = table.snapshot()
    if at.done.get(stream, -1) >= batch_id:
        return
    once = latest_per_key(
        records.where(F.col("application_id").isNotNull()), ["application_id"],
        [F.desc("flink_processed_at")] if "flink_processed_at" in records.columns else [F.desc("application_id")],
    ).withColumn("point_id", uuid5(F.col("application_id"))).persist()
    try:
        points = record_points(table.lacking(once, at).drop("point_id"), embed).select(*POINT_COLUMNS)
        table.upsert(points, [F.desc("application_id")], (stream, batch_id))
    finally:
        once.unpersist()


def start_sync(records: DataFrame, path: str, checkpoint: str, name: str = "vector_sync",
               embed: Embedder | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Keep the collection in step with a stream of cleaned records.

    The offset of a batch is committed only after the batch function returned, so a failing
    embedder leaves it unread and the next start tries again.
    """
    return (
        records.writeStream.queryName(name).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .foreachBatch(lambda batch, batch_id: add_new(batch, batch_id, path, embed, name)).start()
    )


def load_all(records: DataFrame, path: str, embed: Embedder | None = None) -> None:
    """Full load: upsert all records as one batch."""
    points = record_points(records, embed).select(*POINT_COLUMNS)
    points_table(records.sparkSession, path).upsert(points, [F.desc("application_id")])


def load_chunks(chunks: DataFrame, path: str, embed: Embedder | None = None, batch_id: int = 0) -> None:
    """Full load of text chunks with `chunk_id` and `point_id`; of two chunks with one id the later section stays."""
    points = (embed or hashing_embedder())(chunks, "text", "vector")
    upsert_batch(points, batch_id, path, ["point_id"], [F.desc("position")])
