"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its `PREFIX` nearest pivots in order of distance. The vectors are cut into segments; a segment posts
each vector, with the place of the pivot in its order, in the inverted file of every one of these pivots. A query reads the files of its
own pivots and adds up the footrule distance: how far apart the places are, a pivot that is missing counting as the last place.
The `SHARE` of a segment with the least footrule is compared exactly.

Queries come in blocks, and each block meets each segment in a task of its own, so a task has a bounded size. Every row is indexed;
only the pivots are a sample of bounded size.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyline.session import written

PIVOTS = 512  # documented bound of the sample: the vectors with the lowest hash of their id
PREFIX = 128
SHARE = 0.25
LEAST = 100  # candidates of a segment at least
SEGMENT_ROWS = 16_384
QUERY_ROWS = 4_096


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd) & F.exists(vector, lambda x: x != 0)


def orders(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of every vector, nearest first; ties by number."""
    out = np.empty((len(vectors), min(PREFIX, len(pivots))), np.int64)
    for a in range(0, len(vectors), 2048):
        far = (pivots**2).sum(axis=1) - 2 * vectors[a:a + 2048] @ pivots.T
        out[a:a + 2048] = np.argsort(far, axis=1, kind="stable")[:, :out.shape[1]]
    return out


class Segment:
    """The inverted files of one segment."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray):
        near = orders(vectors, pivots)
        self.length = near.shape[1]
        by_pivot = np.argsort(near.ravel(), kind="stable")
        self.rows, self.places = by_pivot // self.length, by_pivot % self.length
        self.first = np.searchsorted(near.ravel()[by_pivot], np.arange(len(pivots) + 1))
        self.n = len(vectors)

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of every vector to a query's order."""
        files = [slice(self.first[p], self.first[p + 1]) for p in order]
        rows = np.concatenate([self.rows[f] for f in files])
        gain = np.concatenate([np.abs(self.places[f] - place) - (self.length - place) for place, f in enumerate(files)])
        missing = (self.length - np.arange(len(order))).sum()
        return missing + np.bincount(rows, weights=gain, minlength=self.n)


def nearest(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest found of every query.

    vectors: vec_id, embedding; other columns are left out; `queries` marks the rows that are queries. Candidates are all rows but
    those with the query's id; ties go to the smaller vec_id. Rows without an id, and vectors that are not `usable`, take no
    part; vectors of unlike length do not compare; equal rows are one. No rows give no rows.
    """
    base = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    base = base.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct().withColumn("dims", F.size("vector"))
    base = written(base, "vectors")
    n, n_asks = base.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    by_hash = Window.partitionBy("dims").orderBy(F.xxhash64("vec_id"), "vec_id", "vector")
    sample = base.withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= PIVOTS).select("dims", "nth", "vector")
    pivots = written(sample, "pivots")
    segments, blocks = max(1, -(-n // SEGMENT_ROWS)), max(1, -(-n_asks // QUERY_ROWS))
    part = lambda seed, m: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    index = base.select("dims", part(1, segments).alias("segment"), "vec_id", "vector", F.lit(False).alias("asks")).withColumn("block", every(blocks))
    asked = base.filter("asks").select("dims", part(2, blocks).alias("block"), "vec_id", "vector", "asks").withColumn("segment", every(segments))
    keys = ["dims", "segment", "block"]
    # PIVOTS vectors per length
    shared = base.sparkSession.sparkContext.broadcast(_by_length(pivots))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            rows, asks = np.stack(left["vector"].to_numpy()), np.stack(right["vector"].to_numpy())
            own = shared.value[rows.shape[1]]
            segment, ids = Segment(rows, own), left["vec_id"].to_numpy()
            count = min(len(ids), max(LEAST, int(np.ceil(SHARE * len(ids)))))
            for query, vector, order in zip(right["vec_id"].to_numpy(), asks, orders(asks, own), strict=True):
                distance = segment.footrule(order)
                near = np.argpartition(distance, count - 1)[:count]
                near = near[ids[near] != query]
                score = np.sqrt(((rows[near] - vector) ** 2).sum(axis=1))
                best = np.lexsort((ids[near], score))[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[near[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.distinct().withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _by_length(pivots: DataFrame) -> dict[int, np.ndarray]:
    rows = pivots.orderBy("dims", "nth").collect()
    lengths = sorted({r.dims for r in rows})
    return {d: np.array([r.vector for r in rows if r.dims == d]) for d in lengths}
