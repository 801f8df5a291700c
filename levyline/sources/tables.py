"""Serving tables over JDBC or Parquet, and folders of markdown files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_table(
    spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
    partition: tuple[str, int, int, int] | None = None, **properties,
) -> DataFrame:
    """A table, or a query whose ORDER BY / LIMIT runs in the database.

    `partition` = (column, lower, upper, n) splits a large table read over n tasks.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table and query")
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if query is not None:
        return reader.option("query", query).load()
    if partition:
        column, lower, upper, n = partition
        reader = (
            reader.option("partitionColumn", column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", n)
        )
    return reader.option("dbtable", table).load()


def markdown_folder(spark: SparkSession, path: str) -> DataFrame:
    """One row per markdown file of a folder, README left out."""
    return (
        spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
        .where(F.lower("file") != "readme.md")
    )
