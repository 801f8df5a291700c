"""The corpus pipeline: language, near copies, benchmark leaks, source mix and token files, one stage after the other.

Each stage takes (spark, docs, sf_dir) and gives a table that is written as Parquet and read again as the next one's docs.
All but the last give rows with the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from levyline.llm import decontaminate, langid, mixing, ngram_join, tokenfiles
from levyline.llm.queries import ORACLES as OPERATOR_ORACLES
from levyline.llm.queries import QUERIES as OPERATOR_QUERIES
from levyline.llm.queries import table, vocabulary
from levyline.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts without letters, or unlike every language, go."""
    return langid.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component of the join on 5-word shingles at a similarity of 0.8."""
    return ngram_join.one_per_component(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in the token files."""
    return tokenfiles.token_table(docs, vocabulary(), escape=False)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
    ("token_files", token_files),
]
# SQL has no random letter vectors, no pivotal rounding that could be compared row by row, and no byte-level BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**OPERATOR_QUERIES, "pipeline": run}
ORACLES = {**OPERATOR_ORACLES}
