"""Serving tables kept up to date from micro-batches.

A serving table is a Parquet folder with one sub-folder per batch. Writing a batch touches only
that batch's folder, so a replayed batch replaces its own rows and nothing else; reading takes the
newest row per key. `compact` folds the batches into one.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from levyline.operators.skew import latest_per_key


def upsert_batch(df: DataFrame, batch_id: int, path: str, keys: list[str], order: list[Column]) -> None:
    latest_per_key(df, keys, order).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path)


def read_current(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Newest row per key."""
    return latest_per_key(read_batches(spark, path, schema), keys, [F.desc("batch_id")]).drop("batch_id")


def compact(spark: SparkSession, path: str, target: str, schema: str, keys: list[str]) -> None:
    """Write the current rows to a new folder under the highest batch id seen."""
    rows = read_batches(spark, path, schema)
    top = rows.agg(F.max("batch_id").alias("b")).first()["b"]
    read_current(spark, path, schema, keys).write.mode("overwrite").parquet(f"{target}/batch_id={top}")


def start_upsert(
    df: DataFrame, path: str, checkpoint: str, name: str, keys: list[str], order: list[Column],
    output_mode: str = "append", trigger: dict | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch; `after` runs once the batch is written (refresh of a cache, say)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, path, keys, order)
        if after:
            after(batch, batch_id)

    return (
        df.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"})).foreachBatch(write).start()
    )


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 100, **properties) -> None:
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_rows), **properties
    ).save()


def start_jdbc_append(df: DataFrame, url: str, table: str, checkpoint: str, name: str, batch_rows: int = 100,
                      trigger: dict | None = None, **properties) -> StreamingQuery:
    """At-least-once append of each micro-batch to a database table."""
    return (
        df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .foreachBatch(lambda batch, _: append_jdbc(batch, url, table, batch_rows, **properties)).start()
    )


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON texts for a broker, optionally keyed."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.col(key).alias("key"), value) if key else df.select(value)


def start_messages(df: DataFrame, location: str, topic: str, checkpoint: str, name: str, fmt: str = "kafka",
                   key: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """JSON messages to a topic, or to a folder of text files with fmt='text'."""
    if fmt == "kafka":
        writer = as_messages(df, key).writeStream.format("kafka").option(
            "kafka.bootstrap.servers", location
        ).option("topic", topic)
    elif fmt == "text":
        writer = as_messages(df).writeStream.format("text").option("path", f"{location}/{topic}")
    else:
        raise ValueError(f"unknown message format {fmt!r}")
    return (
        writer.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"})).start()
    )
