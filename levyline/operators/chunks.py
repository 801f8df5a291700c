"""Markdown files as section chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.functions.text import stripped, uuid5


def _field(text: str, name: str) -> Column:
    """Rest of the first line `Name: ...`, empty when there is none."""
    return stripped(F.coalesce(F.regexp_extract(F.col(text), rf"(?md)^{name}:\s*(.+)$", 1), F.lit("")))


def section_chunks(files: DataFrame) -> DataFrame:
    """One chunk per second-level heading of each file. Needs columns `file` and `text`."""
    blocks = (
        files.where(F.lower("file") != "readme.md")
        .select("file", _field("text", "Authority").alias("authority"),
                F.posexplode(F.split("text", r"(?md)^## ")).alias("position", "block"))
        .where(F.col("position") > 0)
    )
    title = stripped(F.substring_index("block", "\n", 1))
    body = F.when(
        F.contains(F.col("block"), F.lit("\n")), stripped(F.expr("substr(block, instr(block, '\\n') + 1)"))
    ).otherwise(F.lit(""))
    parts = blocks.select("file", "authority", "position", title.alias("section"), body.alias("body"))
    return parts.select(
        "file", "position", "section",
        _field("body", "Source").alias("source"),
        _field("body", "Status").alias("status"),
        "authority",
        F.concat("section", F.lit("\n"), "body").alias("text"),
    )


def with_point_ids(chunks: DataFrame, origin: str = "file") -> DataFrame:
    """Adds `chunk_id` (origin::section) and the point id made of it."""
    return chunks.withColumn("chunk_id", F.concat_ws("::", origin, "section")).withColumn(
        "point_id", uuid5(F.col("chunk_id"))
    )
