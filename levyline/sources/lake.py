"""Reads of the date-partitioned lake: newest partitions, newest files, recent arrivals."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.schemas import CLEANED

RECENT_PARTITIONS = 7


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = CLEANED) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file: path, partition, size and write time. No content is read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select(
            "path",
            F.regexp_extract("path", r"dt=([^/]+)", 1).alias("dt"),
            F.col("length").alias("n_bytes"),
            F.col("modificationTime").alias("written_at"),
        )
    )


def partition_inventory(spark: SparkSession, path: str) -> DataFrame:
    return file_inventory(spark, path).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_bytes").alias("n_bytes"),
        F.max("written_at").alias("last_written_at"),
    )


def has_files(spark: SparkSession, path: str) -> bool:
    return not file_inventory(spark, path).limit(1).isEmpty()


def newest_partitions(df: DataFrame, n: int = RECENT_PARTITIONS, partitions: DataFrame | None = None) -> DataFrame:
    """Rows of the n newest `dt` values.

    `partitions` may hold the known values (say, from partition_inventory) so that the data need
    not be scanned for them. The bound is a scalar subquery on the partition column: it prunes
    folders at run time.
    """
    known = df if partitions is None else partitions
    newest = known.select("dt").where(F.col("dt").isNotNull()).distinct().orderBy(F.desc("dt")).limit(n)
    oldest_kept = newest.agg(F.min("dt").alias("oldest_kept"))
    return df.where(F.col("dt") >= oldest_kept.scalar())


def newest_files(spark: SparkSession, path: str, since: datetime | None = None, max_files: int | None = None) -> DataFrame:
    """Files by write time, newest first, optionally only those written after `since` or the newest `max_files`."""
    files = file_inventory(spark, path)
    if since is not None:
        files = files.where(F.col("written_at") > F.lit(since))
    ordered = files.orderBy(F.desc("written_at"), F.desc("path"))
    return ordered if max_files is None else ordered.limit(max_files)


def read_arrivals(
    spark: SparkSession, path: str, since: datetime | None = None, max_files: int | None = None,
    overlap: timedelta = timedelta(0), fmt: str = "parquet", schema: str = CLEANED,
) -> tuple[DataFrame, datetime | None]:
    """Rows of the files written after `since`, and the write time to pass as `since` next time.

    With `max_files` the oldest unread files come first, with all of the same write time as the last of them, so nothing is
    skipped. `overlap` reads files again that were written that long before `since`, for stores that show a file late; the
    reader then drops rows it has. The scan opens only the files between the two times; no file name reaches the driver.
    """
    new = file_inventory(spark, path)
    if since is not None:
        new = new.where(F.col("written_at") > F.lit(since))
    if max_files is not None:
        new = new.orderBy("written_at", "path").limit(max_files)
    until = new.agg(F.max("written_at")).first()[0]
    if until is None:
        return spark.createDataFrame([], schema), since
    written_at = F.col("_metadata.file_modification_time")
    rows = read_lake(spark, path, fmt, schema)
    columns = rows.columns
    rows = rows.where(written_at <= F.lit(until))
    if since is not None:
        rows = rows.where(written_at > F.lit(since - overlap))
    return rows.select(*columns), until


def scoring_columns(fill_income: bool = True) -> list[Column]:
    income = F.coalesce("taxable_income", F.lit(0.0)) if fill_income else F.col("taxable_income")
    unknown = F.lit("UNKNOWN")
    return [
        F.col("application_id"),
        F.col("customer_id"),
        F.coalesce("province", unknown).alias("province"),
        income.alias("taxable_income"),
        F.coalesce("employment_type", unknown).alias("employment_type"),
        F.coalesce("employment_status", unknown).alias("employment_status"),
        F.coalesce("filing_status", unknown).alias("filing_status"),
        F.coalesce("is_fraud", F.lit(False)).alias("is_fraud"),
    ]


def recent_arrivals(
    spark: SparkSession, path: str, since: datetime | None = None, max_files: int | None = None,
    overlap: timedelta = timedelta(0), fmt: str = "parquet",
) -> tuple[DataFrame, datetime | None]:
    rows, until = read_arrivals(spark, path, since, max_files, overlap, fmt)
    return rows.where(F.col("application_id").isNotNull()).select(*scoring_columns(), "flink_processed_at"), until


def ml_dataset(df: DataFrame, n_rows: int | None = 50000) -> DataFrame:
    """Labelled rows for training; of more than `n_rows` those with the lowest hash of their id, None takes everything."""
    rows = df.where(F.col("application_id").isNotNull() & (F.col("taxable_income") >= 0)).select(*scoring_columns())
    return rows if n_rows is None else rows.orderBy(F.xxhash64("application_id"), "application_id").limit(n_rows)


def ml_dataset_from_lake(spark: SparkSession, path: str, n_rows: int | None = 50000, fmt: str = "parquet") -> DataFrame:
    """Training rows from the whole lake."""
    return ml_dataset(read_lake(spark, path, fmt), n_rows)


def recent_events(df: DataFrame, n_rows: int = 50, stamp: str = "flink_processed_at") -> DataFrame:
    return (
        df.where(F.col("application_id").isNotNull())
        .select(*scoring_columns(), stamp)
        .orderBy(F.desc_nulls_last(stamp), F.asc("application_id"))
        .limit(n_rows)
    )
