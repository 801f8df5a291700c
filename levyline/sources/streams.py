"""Stream sources and the tolerant JSON decode."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.functions.text import event_time


@dataclass(frozen=True)
class StreamSpec:
    """Where a topic comes from. `starting` is earliest or latest and only matters for a broker."""

    topic: str
    location: str
    format: str = "kafka"
    starting: str = "earliest"
    group: str | None = None
    options: dict = field(default_factory=dict)


def read_stream(spark: SparkSession, spec: StreamSpec) -> DataFrame:
    """One `value` text column per message."""
    if spec.starting not in ("earliest", "latest"):
        raise ValueError(f"starting must be earliest or latest, not {spec.starting!r}")
    reader = spark.readStream.options(**spec.options)
    if spec.format == "kafka":
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", spec.location)
            .option("subscribe", spec.topic)
            .option("startingOffsets", spec.starting)
        )
        if spec.group:
            reader = reader.option("kafka.group.id", spec.group)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if spec.format == "text":
        return reader.format("text").load(f"{spec.location}/{spec.topic}")
    raise ValueError(f"unknown stream format {spec.format!r}")


END_OF_TOPIC = "2200-01-01T00:00:00"  # Python states read times as nanoseconds, which end in 2262


def end_of_topic(stamp: str = "_produced_at") -> str:
    """The message that says that nothing follows: its time is beyond every other.

    Its own window and its own join row never close, so it is in no result. It has a key of its own, as joins may leave
    rows without one out before they see their time.
    """
    return json.dumps({stamp: END_OF_TOPIC, "customer_id": f"end of topic {uuid.uuid4()}"})


def heartbeats(spark: SparkSession, idle: str = "10 seconds", stamp: str = "_produced_at") -> DataFrame:
    """Messages with nothing but a time, `idle` behind the clock: union them with a topic that may fall silent.

    They move the watermark on while no event comes, so open windows close; `without_heartbeats` takes them out again
    behind the watermark.
    """
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    at = F.date_format(F.col("timestamp") - F.expr(f"INTERVAL {idle}"), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    return clock.select(F.to_json(F.struct(at.alias(stamp))).alias("value"))


def without_heartbeats(timed: DataFrame, key: str = "application_id") -> DataFrame:
    """Rows with a key. The condition names the event time, or Spark would move it in front of the watermark."""
    return timed.where(F.col(key).isNotNull() | F.col("event_time").isNull())


def topic_volume(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """Messages kept per topic, from a batch read of the broker."""
    messages = (
        spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).load()
    )
    return volume_by_topic(messages)


def volume_by_topic(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


OK, BAD_FIELD, NOT_JSON = "ok", "bad_field", "not_json"


def decode_json(messages: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Columns of `schema` plus `_raw` and `_status`.

    A field of the wrong type becomes NULL and the row is kept (`bad_field`); a text that is no
    JSON object at all is marked `not_json` so that the caller can route it to a reject output.
    """
    parsed = F.from_json(
        F.col(value), f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    # inline, not a projection: a filter on the parsed columns would otherwise move below and parse again
    rows = messages.select(F.col(value).alias("_raw"), F.inline(F.array(parsed)))
    status = (
        F.when(F.col("_corrupt").isNull() & F.col("_raw").isNotNull(), F.lit(OK))
        .when(_is_object("_raw"), F.lit(BAD_FIELD))
        .otherwise(F.lit(NOT_JSON))
    )
    return rows.withColumn("_status", status).drop("_corrupt")


def _is_object(text: str) -> Column:
    kind = F.schema_of_variant(F.try_parse_json(F.col(text)))
    return F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("_status") != NOT_JSON).drop("_raw", "_status")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("_status") == NOT_JSON).select("_raw")


def with_event_time(df: DataFrame, delay: str | None = "30 seconds", stamp: str = "_produced_at") -> DataFrame:
    """Adds `event_time`; on a stream also the watermark. Rows without a readable stamp are kept."""
    timed = df.withColumn("event_time", event_time(stamp))
    return timed.withWatermark("event_time", delay) if df.isStreaming and delay else timed


def unreadable_stamps(df: DataFrame, stamp: str = "_produced_at") -> DataFrame:
    """Rows whose stamp does not parse: they would silently fall out of every window."""
    return df.where(event_time(stamp).isNull())


def first_arrivals(df: DataFrame, key: str = "application_id") -> DataFrame:
    """One row per key: on a stream within the watermark delay, in a batch over all rows."""
    return df.dropDuplicatesWithinWatermark([key]) if df.isStreaming else df.dropDuplicates([key])
