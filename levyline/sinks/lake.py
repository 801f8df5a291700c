"""Date-partitioned lake sinks, for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_lake(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Batch write by `dt`. The rebalance lets Spark split a day with very many rows over several tasks."""
    df.hint("rebalance", "dt").write.mode(mode).partitionBy("dt").format(fmt).save(path)


def start_lake_sink(
    df: DataFrame, path: str, checkpoint: str, name: str, fmt: str = "parquet",
    trigger: dict | None = None, files_per_day: int | None = None, id_col: str = "application_id",
) -> StreamingQuery:
    """Append stream by `dt`, exactly once through the sink's own commit log.

    Rows of a day go to at most `files_per_day` tasks per batch, as many as the cluster has cores by default: a
    backfill of a single day keeps all of them busy. `compact_lake` makes few files of many.
    """
    files_per_day = files_per_day or max(2, df.sparkSession.sparkContext.defaultParallelism)
    spread = F.pmod(F.xxhash64(F.coalesce(F.col(id_col), F.lit(""))), F.lit(files_per_day))
    return (
        df.repartition(F.col("dt"), spread).writeStream.queryName(name).outputMode("append")
        .partitionBy("dt").format(fmt).option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"})).start()
    )


def compact_lake(spark: SparkSession, path: str, target: str, schema: str, rows_per_file: int = 5_000_000,
                 fmt: str = "parquet") -> None:
    """Rewrite many small files into few per day, in a new folder that readers switch to."""
    rows = spark.read.schema(schema).format(fmt).load(path)
    rows.hint("rebalance", "dt").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("dt").format(fmt).save(target)
