"""Connected components of a table of links, as distributed union-find.

Every partition first joins its own links into trees. Then each round hangs all larger neighbours of a node below the
smallest one it knows (large star) and the smaller ones likewise (small star) until nothing changes. Minima are
aggregated before the shuffle and joined back, so a node with very many links is split like any skewed join key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyline.session import written


def forest(pairs: np.ndarray) -> np.ndarray:
    """The same components as `pairs` (n x 2), each node below the smallest of its tree."""
    names, at = np.unique(pairs, return_inverse=True)
    parent = np.arange(len(names))
    at = at.reshape(-1, 2)
    while True:  # names are sorted, so the smaller index is the smaller node
        a, b = parent[at[:, 0]], parent[at[:, 1]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            break
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    below = parent != np.arange(len(names))
    return np.stack([names[below], names[parent[below]]], axis=1)


def _local(batches):
    for batch in batches:
        pairs = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
        out = forest(pairs) if len(pairs) else pairs
        yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["u", "v"])


def _with_minimum(rows: DataFrame) -> DataFrame:
    low = rows.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    return rows.join(low, rows.u == F.col("m_u")).drop("m_u")


def components(links: DataFrame, label: str = "links", forests: bool = False) -> DataFrame:
    """node, root for every node of the two long columns of `links`; the root is the component's smallest node.

    `forests`: the links come as forests out of Python tasks. Joining them first would start a second worker in each task.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    now = written((links if forests else links.mapInArrow(_local, "u long, v long")).distinct(), label)
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        kept = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = _with_minimum(large).select(F.inline(kept)).filter("u <> v").distinct()
        now = written(small, label)
