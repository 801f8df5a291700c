"""Embedding of texts and exact cosine search.

One side of a search is written to the shared folder in files of at most `block` rows; the other flows through
once, and each task reads the files one at a time. No pairs leave a task (only the best k do), nothing goes
through the driver, and memory is bounded by the block, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyline.functions.text import uuid5
from levyline.functions.vectors import letter_profile
from levyline.session import work_folder

BLOCK = 4096
SCORE_DIGITS = 6
SLICE = 512  # queries scored at once against a block

Embedder = Callable[[DataFrame, str, str], DataFrame]


def hashing_embedder(dim: int = 64) -> Embedder:
    """Token hashing with Spark ML, unit length. No model files needed."""

    def embed(df: DataFrame, text: str, output: str = "vector") -> DataFrame:
        stages = Pipeline(stages=[
            Tokenizer(inputCol="_text", outputCol="_tokens"),
            HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=dim),
            Normalizer(inputCol="_counts", outputCol="_unit"),
        ])
        ready = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        embedded = stages.fit(ready).transform(ready)
        return embedded.withColumn(output, vector_to_array("_unit")).drop("_text", "_tokens", "_counts", "_unit")

    return embed


def letter_embedder(df: DataFrame, text: str, output: str = "vector") -> DataFrame:
    """Letter counts; any SQL engine can recompute them. The search brings vectors to unit length itself."""
    return df.withColumn(output, letter_profile(text))


def model_embedder(encode: Callable[[list[str]], np.ndarray]) -> Embedder:
    """A user's model: texts in, one row of numbers per text out, run on Arrow batches in the tasks."""

    def embed(df: DataFrame, text: str, output: str = "vector") -> DataFrame:
        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def vectors(texts):
            import pandas as pd

            raw = np.asarray(encode(texts.fillna("").tolist()), dtype=np.float64)
            lengths = np.linalg.norm(raw, axis=1, keepdims=True)
            return pd.Series(list((raw / np.where(lengths == 0, 1.0, lengths)).astype(np.float32)))

        return df.withColumn(output, vectors(F.col(text)))

    return embed


def _units(column: pa.Array) -> np.ndarray:
    """Vectors of an Arrow list column as unit rows; a zero vector stays zero and scores 0."""
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths == 0, 1.0, lengths)


def _best(scores: np.ndarray, ranks: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, place from 0) of the k highest scores of every row; ties go to the lower rank of the column."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        row, column = np.nonzero(scores >= least[:, None])
    else:
        row, column = np.indices(scores.shape).reshape(2, -1)
    order = np.lexsort((ranks[column], -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k], place[place < k]


def _ranks(ids: pa.Array) -> np.ndarray:
    """Place of every id in their order."""
    order = pc.sort_indices(ids).to_numpy()
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.arange(len(order))
    return ranks


def _stored(fixed: DataFrame, id_col: str, vector: str, block: int) -> str:
    """A shared folder with the fixed side, in files of at most `block` rows. Tasks read it file by file."""
    folder = work_folder(fixed.sparkSession, "search")
    rows = fixed.where(F.col(vector).isNotNull()).select(id_col, F.col(vector).cast("array<double>").alias(vector))
    rows.hint("rebalance").write.option("maxRecordsPerFile", block).parquet(folder)
    return folder


def _blocks(folder: str) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and unit vectors of one stored file after the other."""
    store, place = fs.FileSystem.from_uri(folder)
    for found in sorted(store.get_file_info(fs.FileSelector(place)), key=lambda f: f.path):
        if found.path.endswith(".parquet"):
            table = pq.read_table(found.path, filesystem=store).combine_chunks()
            if table.num_rows:
                yield table.column(0).chunk(0), _units(table.column(1).chunk(0))


def search_index(
    index: DataFrame, queries: DataFrame, index_id: str, query_id: str, k: int = 5,
    index_vector: str = "vector", query_vector: str = "vector", payload: list[str] | None = None, block: int = BLOCK,
) -> DataFrame:
    """Best k index rows per query when the index is the large side.

    Columns: query id, index id, similarity, rank and the payload columns of the index row.
    Scores are compared after rounding to six digits, ties go to the lower id.
    """
    payload = payload or []
    flowing = index.where(F.col(index_vector).isNotNull()).select(
        index_id, F.col(index_vector).cast("array<double>").alias("_v"), *payload
    )
    schema = T.StructType(
        [queries.schema[query_id], index.schema[index_id], T.StructField("similarity", T.DoubleType())]
        + [index.schema[name] for name in payload]
    )
    folder = _stored(queries, query_id, query_vector, block)

    def scan(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            units, ranks = _units(batch.column("_v")), _ranks(batch.column(index_id))
            for query_ids, matrix in _blocks(folder):
                for first in range(0, len(matrix), SLICE):
                    scores = np.round(matrix[first:first + SLICE] @ units.T, SCORE_DIGITS)
                    row, column, _ = _best(scores, ranks, k)
                    chosen = batch.take(pa.array(column))
                    yield pa.RecordBatch.from_arrays(
                        [query_ids.take(pa.array(row + first)), chosen.column(index_id), pa.array(scores[row, column])]
                        + [chosen.column(name) for name in payload],
                        names=[query_id, index_id, "similarity", *payload],
                    )

    # the rank filter prunes each task before the shuffle
    order = Window.partitionBy(query_id).orderBy(F.desc("similarity"), F.asc(index_id))
    found = flowing.mapInArrow(scan, schema)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def match_queries(
    queries: DataFrame, collection: DataFrame, query_id: str, match_id: str, k: int = 3,
    query_vector: str = "vector", match_vector: str = "vector", block: int = BLOCK, min_similarity: float | None = None,
) -> DataFrame:
    """Best k collection rows per query when the queries are the large side, e.g. a stream of questions.

    Nothing is shuffled: each task ranks its own queries over all blocks of the collection.
    """
    flowing = queries.where(F.col(query_vector).isNotNull()).select(
        query_id, F.col(query_vector).cast("array<double>").alias("_v")
    )
    schema = T.StructType([
        queries.schema[query_id], collection.schema[match_id],
        T.StructField("similarity", T.DoubleType()), T.StructField("rank", T.IntegerType()),
    ])
    folder = _stored(collection, match_id, match_vector, block)

    def scan(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            units, owners, ids, scores = _units(batch.column("_v")), [], [], []
            for match_ids, matrix in _blocks(folder):
                ranks = _ranks(match_ids)
                for first in range(0, len(units), SLICE):
                    part = np.round(units[first:first + SLICE] @ matrix.T, SCORE_DIGITS)
                    row, column, _ = _best(part, ranks, k)
                    owners.append(row + first)
                    ids.append(match_ids.take(pa.array(column)))
                    scores.append(part[row, column])
            if not owners:
                continue
            # the best of all blocks
            owner, score, every = np.concatenate(owners), np.concatenate(scores), pa.concat_arrays(ids)
            order = np.lexsort((_ranks(every), -score, owner))
            owner = owner[order]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            kept = order[place < k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(query_id).take(pa.array(owner[place < k])), every.take(pa.array(kept)), pa.array(score[kept]),
                 pa.array(place[place < k] + 1, pa.int32())],
                names=[query_id, match_id, "similarity", "rank"],
            )

    found = flowing.mapInArrow(scan, schema)
    return found if min_similarity is None else found.where(F.col("similarity") >= min_similarity)


def search_with_fallback(
    queries: DataFrame, first: DataFrame, second: DataFrame, query_id: str, match_id: str,
    k_first: int = 4, k_second: int = 3, **options,
) -> DataFrame:
    """Matches from the first collection, and from the second for queries the first answers nothing."""
    hits = match_queries(queries, first, query_id, match_id, k_first, **options)
    hits = hits.withColumn("collection", F.lit("first"))
    unanswered = queries.join(hits.select(query_id).distinct(), query_id, "left_anti")
    rest = match_queries(unanswered, second, query_id, match_id, k_second, **options)
    return hits.unionByName(rest.withColumn("collection", F.lit("second")))


def plain_number(name: str) -> Column:
    """Text of a number without an exponent, at least one digit after the point; 0 when NULL."""
    text = F.col(name).cast("double").cast("string")
    # Spark writes small and large numbers as d.dddE+n: the digits stay, the point moves
    sign, whole = F.regexp_extract(text, r"^(-?)", 1), F.regexp_extract(text, r"^-?(\d+)", 1)
    after = F.regexp_replace(F.regexp_extract(text, r"\.(\d+)E", 1), "0+$", "")
    by = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    digits, n = F.concat(whole, after), F.length(after)
    moved = (
        F.when(by < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -by - 1), digits))
        .when(by >= n, F.concat(digits, F.repeat(F.lit("0"), by - n), F.lit(".0")))
        .otherwise(F.concat(F.substring(digits, F.lit(1), by + 1), F.lit("."), F.substring(digits, by + 2, n)))
    )
    return F.coalesce(F.when(by.isNotNull(), F.concat(sign, moved)).otherwise(text), F.lit("0"))


def record_text() -> Column:
    """The sentence a filing is embedded as."""
    def part(word, name, default):
        return F.concat(F.lit(word), F.coalesce(F.col(name).cast("string"), F.lit(default)))

    return F.concat(
        part("Province ", "province", "unknown"), F.lit(" income "), plain_number("taxable_income"),
        part(" employment ", "employment_type", "unknown"), part(" status ", "employment_status", "unknown"),
        part(" filing ", "filing_status", "unknown"),
        F.lit(" fraud "), F.initcap(F.coalesce(F.col("is_fraud"), F.lit(False)).cast("string")),
    )


def payload_columns(df: DataFrame) -> list[Column]:
    """Typed payload of a vector point, defaults filled."""
    def text(name, default):
        return F.coalesce(F.col(name).cast("string"), F.lit(default)).alias(name)

    risk = F.col("risk_score").cast("double") if "risk_score" in df.columns else F.lit(0.0)
    processed = F.col("flink_processed_at").cast("string") if "flink_processed_at" in df.columns else F.lit(None).cast("string")
    return [
        text("application_id", ""), text("customer_id", ""),
        F.coalesce(F.col("taxable_income").cast("double"), F.lit(0.0)).alias("taxable_income"),
        text("employment_type", "UNKNOWN"), text("employment_status", "UNKNOWN"), text("filing_status", "UNKNOWN"),
        text("province", "UNKNOWN"),
        F.coalesce(risk, F.lit(0.0)).alias("risk_score"),
        F.coalesce(F.col("is_fraud"), F.lit(False)).alias("is_fraud"),
        processed.alias("processed_at"),
    ]


def record_points(records: DataFrame, embed: Embedder | None = None) -> DataFrame:
    """Vector points of filings: id, vector and payload."""
    ready = records.select(*payload_columns(records), record_text().alias("_record"))
    embedded = (embed or hashing_embedder())(ready, "_record", "vector").drop("_record")
    return embedded.withColumn("point_id", uuid5(F.col("application_id")))


def new_records(records: DataFrame, points: DataFrame) -> DataFrame:
    """Records whose point is not in the collection yet."""
    return records.withColumn("point_id", uuid5(F.col("application_id"))).join(
        points.select("point_id"), "point_id", "left_anti"
    )


def similar_case_evidence(matches: DataFrame, query_id: str, similar: float = 0.85, enough: int = 3, shown: int = 3,
                          case_id: str = "application_id") -> DataFrame:
    """Per query: matching fraud cases above `similar`, the shown cases and the risk without a model score."""
    close = F.col("is_fraud") & (F.round("similarity", 4) > similar)
    top = F.filter(
        F.array_sort(F.collect_list(F.when(F.col("rank") <= shown, F.struct("rank", F.col(case_id).cast("string").alias("case"))))),
        lambda x: x.isNotNull(),
    )
    return matches.groupBy(query_id).agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.count_if(close).alias("similar_fraud"),
        F.round(F.max("similarity"), 4).alias("best_similarity"),
        F.array_join(F.transform(top, lambda x: x["case"]), ", ").alias("shown_cases"),
    ).withColumn("risk", F.when(F.col("similar_fraud") >= enough, "ELEVATED").otherwise("UNAVAILABLE"))


NO_CONTEXT = "No relevant regulatory information found."


def kb_context(questions: DataFrame, hits: DataFrame, query_id: str) -> DataFrame:
    """Numbered context text per question from its ranked hits.

    Hits with a `file` value get the curated header (file, section, source, status), others the plain
    one (source_doc, section). A question has at most k hits, so its list is small by construction.
    """
    def value(name, default):
        return F.coalesce(F.col(name), F.lit(default)) if name in hits.columns else F.lit(default)

    number = F.col("rank").cast("string")
    curated = F.concat(
        F.lit("[Source "), number, F.lit(": "), value("file", ""), F.lit(" - "), value("section", "?"),
        F.lit(" | origin: "), value("source", "n/a"), F.lit(" | status: "), value("status", "n/a"), F.lit("]"),
    )
    plain = F.concat(F.lit("[Source "), number, F.lit(": "), value("source_doc", "unknown"), F.lit(" §"), value("section", "?"), F.lit("]"))
    has_file = F.col("file").isNotNull() if "file" in hits.columns else F.lit(False)
    blocks = hits.select(
        query_id, "rank",
        F.concat(F.when(has_file, curated).otherwise(plain), F.lit("\n"), value("text", "")).alias("block"),
    )
    texts = blocks.groupBy(query_id).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "block"))), lambda x: x["block"]), "\n\n").alias("context")
    )
    return questions.select(query_id).distinct().join(texts, query_id, "left").select(
        query_id, F.coalesce("context", F.lit(NO_CONTEXT)).alias("context")
    )
