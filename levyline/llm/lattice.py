"""Near-duplicate vectors by hashing to the E8 lattice.

A vector of length one is projected to 8 x `blocks` random directions, and every 8 of them are decoded to the nearest point of the lattice E8; the
points are the vector's cell in one table. In every table a vector is posted under its own cell and under those
`PROBES` neighbouring cells that are nearest to it, one block moved by one of the 240 shortest lattice vectors. Two
vectors meet where the own cell of one is among the cells of the other.

Postings carry 128 signs of random projections. Only vectors that have a partner within `FAR` unlike signs in their cell are fetched, and
their cosine is computed in double precision. Links are counted in the first cell in which a pair meets, so every link counts once; cells give out
counts and a forest, never pairs. Equal vectors are one class, so copies are never compared.

The number of blocks follows the number of vectors (an own cell holds 256 of a label at the most, if they are spread evenly), the number of
tables follows the chance of a pair at the threshold, simulated with fixed random vectors, to be found: 0.999.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.llm.components import components, forest
from levyline.session import written

LEAST = 0.93
SCALE, PROBES = 0.5, 4
CELL_BITS = 7.5  # of one block at SCALE, as measured on evenly spread vectors
CELL_ROWS = 256
FOUND = 0.999
FAR = 36  # of 128 signs; a pair at 0.93 has 15 unlike signs on average, with a standard deviation of 3.7
BLOCK = 1024  # vectors of a cell that meet in one task, twice


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for x, y in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = x, y
            out.append(v)
    out += [np.array(signs) for signs in itertools.product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates and an even sum: rounded, the worst coordinate the other way where the sum is odd."""
    near = np.rint(x)
    rest = x - near
    worst = np.abs(rest).argmax(axis=-1)[..., None]
    other = np.where(np.take_along_axis(rest, worst, -1) >= 0, 1.0, -1.0)
    moved = near.copy()
    np.put_along_axis(moved, worst, np.take_along_axis(near, worst, -1) + other, -1)
    return np.where(near.sum(axis=-1, keepdims=True) % 2 != 0, moved, near)


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, the union of D8 and D8 moved by a half, for the last axis of 8."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=-1, keepdims=True) <= ((x - half) ** 2).sum(axis=-1, keepdims=True)
    return np.where(closer, whole, half)


def points(y: np.ndarray, probes: int = PROBES) -> np.ndarray:
    """(n, 1 + probes, blocks, 8) doubled coordinates of the own point of each row of y (n, blocks, 8) and of its nearest neighbours."""
    n, blocks, _ = y.shape
    own = nearest_e8(y)
    gain = ((y - own) @ ROOTS.T).reshape(n, blocks * len(ROOTS))
    out = np.repeat(own[:, None], 1 + probes, axis=1)
    if probes:
        near = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
        for p in range(probes):
            out[np.arange(n), 1 + p, near[:, p] // len(ROOTS)] += ROOTS[near[:, p] % len(ROOTS)]
    return np.rint(out * 2).astype(np.int64)


@lru_cache(maxsize=8)
def _directions(dims: int, blocks: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([8, dims, blocks])
    signs = rng.standard_normal((dims, 128))
    return rng.standard_normal((dims, tables * blocks * 8)) * SCALE, signs


@lru_cache(maxsize=8)
def _mixers(blocks: int) -> np.ndarray:
    return np.random.default_rng([64, blocks]).integers(0, 1 << 63, size=(blocks, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def cells(units: np.ndarray, labels: np.ndarray, blocks: int, tables: int) -> np.ndarray:
    """(n, tables, 1 + PROBES) names of the own cell and its neighbours. Names of unlike cells may collide: cosines are computed anyway."""
    n, dims = units.shape
    y = (units @ _directions(dims, blocks, tables)[0]).reshape(n * tables, blocks, 8)
    step = max(1, 20_000 // blocks)  # decoding compares every block with 240 neighbours
    with np.errstate(over="ignore"):
        mixed = [(points(y[a:a + step]).astype(np.uint64) * _mixers(blocks)).sum(axis=(2, 3), dtype=np.uint64) for a in range(0, len(y), step)]
        names = np.concatenate(mixed).reshape(n, tables, 1 + PROBES)
        names += labels.astype(np.uint64)[:, None, None] + np.uint64(dims) * np.uint64(0x9E3779B97F4A7C15)
        names += np.arange(tables, dtype=np.uint64)[None, :, None] * np.uint64(0xD6E8FEB86659FD93)
        names ^= names >> np.uint64(32)
        names *= np.uint64(0xD6E8FEB86659FD93)
        names ^= names >> np.uint64(29)
    return names.view(np.int64)


def sketches(units: np.ndarray, blocks: int, tables: int) -> np.ndarray:
    """(n, 2) words of 64 signs each."""
    signs = units @ _directions(units.shape[1], blocks, tables)[1] > 0
    return np.packbits(signs, axis=1).view(np.uint64)


def meet_first(own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows with their cells (n, tables, 1 + PROBES): the first table in which they meet (or the number of tables), and there the cell."""
    left = (own[:, :, :1] == other).any(axis=2)  # the own cell of the first is among those of the second
    right = (other[:, :, :1] == own).any(axis=2)
    met = left | right
    table = np.where(met.any(axis=1), met.argmax(axis=1), met.shape[1])
    at = np.minimum(table, met.shape[1] - 1)
    row = np.arange(len(own))
    a, b = own[row, at, 0], other[row, at, 0]
    cell = np.where(left[row, at] & right[row, at], np.minimum(a, b), np.where(left[row, at], a, b))
    return table, cell


@lru_cache(maxsize=16)
def tables_for(blocks: int, least: float = LEAST, dims: int = 64) -> int:
    """Tables that a pair at the threshold needs to be found with the chance FOUND, from 2,000 fixed random pairs."""
    rng = np.random.default_rng(93)
    x = rng.standard_normal((2000, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((2000, dims))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = least * x + math.sqrt(max(0.0, 1 - least * least)) * z
    label = np.zeros(2000, np.int64)
    a, b = cells(x, label, blocks, 4), cells(y, label, blocks, 4)
    chance = np.mean([(meet_first(a[:, [t]], b[:, [t]])[0] == 0).mean() for t in range(4)])
    return max(2, math.ceil(math.log(1 - FOUND) / math.log(max(1e-9, 1 - min(chance, 0.999)))))


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd) & F.exists(vector, lambda x: x != 0)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[offsets[i]:offsets[i + 1]] for i in range(len(column))]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the 256-bit digest of the vector; minus zero is zero."""
    for batch in batches:
        names = [hashlib.sha256((v + 0.0).tobytes()).digest() for v in _vectors(batch.column("vector"))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.binary())], names=[*batch.schema.names, "digest"])


def _unit(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of length one; the largest component goes first, so that no square overflows."""
    rows = np.stack(vectors)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _label_numbers(labels: list) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(str(x).encode(), digest_size=8).digest()[:7], "big") for x in labels], np.int64)


def _posted(blocks: int, tables: int):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, nodes = _vectors(batch.column("vector")), batch.column("node").to_numpy()
            labels, sizes = _label_numbers(batch.column("label").to_pylist()), np.array([len(v) for v in vectors])
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                units = _unit([vectors[i] for i in at])
                names, signs = cells(units, labels[at], blocks, tables), sketches(units, blocks, tables)
                each = names.shape[1] * names.shape[2]
                own = np.tile(np.arange(each) % names.shape[2] == 0, len(at))
                yield pa.RecordBatch.from_arrays([
                    pa.array(names.reshape(-1)), pa.array(np.repeat(nodes[at], each)), pa.array(own),
                    *(pa.array(np.repeat(signs[:, k].view(np.int64), each)) for k in (0, 1)),
                ], names=["cell", "node", "own", "s0", "s1"])

    return post


def met(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (cell, node, own, ...) dealt out so that any two rows of a cell, one of them own, share a task of bounded size: with columns i, j, and b.

    A cell of more than `block` rows is cut into blocks b by a hash of the node, and each pair of blocks i <= j meets. Cells without two nodes, or
    without an own one, are left out.
    """
    sizes = rows.groupBy(F.col("cell").alias("c_cell")).agg(F.count("*").alias("n"), F.max("own").alias("any_own")).filter("n > 1 AND any_own")
    n_blocks = F.ceil(F.col("n") / block).cast("long")
    held = rows.join(sizes, rows.cell == F.col("c_cell")).withColumn("n_blocks", n_blocks)
    held = held.withColumn("b", F.pmod(F.xxhash64("node"), F.col("n_blocks")))
    held = held.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    held = held.withColumn("i", F.least("b", "with")).withColumn("j", F.greatest("b", "with"))
    return held.drop("c_cell", "n", "any_own", "n_blocks", "with")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of rows that share the first columns, which are long, from batches in which such rows follow each other."""
    held: list[pa.RecordBatch] = []
    mark = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        names = np.stack([batch.column(k).to_numpy() for k in range(keys)], axis=1)
        edges = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        bounds = [0, *edges.tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:], strict=False):
            now = tuple(names[start])
            if held and now != mark:
                yield pa.Table.from_batches(held)
                held = []
            mark = now
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _pairs(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows of a group compare: one own at least, not the same node, and in the task of two blocks only across them."""
    own, node, b = (group.column(c).to_numpy() for c in ("own", "node", "b"))
    may = (own[:, None] | own[None, :]) & (node[:, None] < node[None, :])
    if group.column("i")[0] != group.column("j")[0]:
        may &= b[:, None] != b[None, :]
    return may, node, own


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a partner within FAR unlike signs."""
    for group in _groups(batches, 3):
        if group.num_rows > 1:
            may, node, own = _pairs(group)
            far = np.zeros(may.shape, np.int64)
            for c in ("s0", "s1"):
                word = group.column(c).to_numpy().view(np.uint64)
                far += np.bitwise_count(word[:, None] ^ word[None, :])
            may &= far <= FAR
            keep = may.any(axis=0) | may.any(axis=1)
            if keep.any():
                cell = group.column("cell").to_numpy()[keep]
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(node[keep]), pa.array(own[keep])], names=["cell", "node", "own"])


def _linked(blocks: int, tables: int, least: float):
    """Rows (node, other, links): `links` other vectors are linked to node in this cell first; `other` hangs it into the cell's forest, or is null."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            vectors, labels = _vectors(group.column("vector").combine_chunks()), group.column("label").to_pylist()
            sizes, codes = np.array([len(v) for v in vectors]), np.unique(np.array([str(x) for x in labels]), return_inverse=True)[1]
            may, node, _ = _pairs(group)
            cell, weight = group.column("cell")[0].as_py(), group.column("copies").to_numpy()
            links, ties = np.zeros(len(node), np.int64), []
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                units, names = _unit([vectors[i] for i in at]), None
                near = may[np.ix_(at, at)] & (codes[at][:, None] == codes[at][None, :]) & (units @ units.T >= least)
                x, y = np.nonzero(near)
                if len(x):
                    names = cells(units, _label_numbers([labels[i] for i in at]), blocks, tables)
                for a in range(0, len(x), 20_000):
                    p, q = x[a:a + 20_000], y[a:a + 20_000]
                    table, first = meet_first(names[p], names[q])
                    here = (table < tables) & (first == cell)
                    p, q = at[p[here]], at[q[here]]
                    np.add.at(links, p, weight[q])
                    np.add.at(links, q, weight[p])
                    ties.append(np.stack([node[p], node[q]], axis=1))
            pairs = forest(np.concatenate(ties)) if ties and sum(map(len, ties)) else np.empty((0, 2), np.int64)
            counted = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([node[counted], pairs[:, 0]])),
                pa.array([None] * len(counted) + pairs[:, 1].tolist(), pa.int64()),
                pa.array(np.concatenate([links[counted], np.zeros(len(pairs), np.int64)])),
            ], names=["node", "other", "links"])

    return link


def near_duplicates(vectors: DataFrame, least: float = LEAST, label: str = "lattice", block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label; other columns are left out).

    Vectors link if their labels are equal and not null, their lengths are equal, and their cosine is `least` or more; pairs below are never
    linked, and a pair at the threshold is found with a chance of 0.999. Every row is a vector, so repeated rows link with each other. A vector that
    is not `usable`, or without a label, links with nothing. component_id is the smallest id reachable (null if all are null); kept means that it
    is the own one. No rows give no rows.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    part = F.col("label").isNotNull() & usable(F.col("vector"))
    own_type = vectors.schema["vec_id"].dataType.simpleString()
    named = rows.filter(part).mapInArrow(_named, f"vec_id {own_type}, vector array<double>, label string, digest binary")
    classes = named.groupBy("label", "digest").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), f"{label}-classes")
    largest = classes.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 1
    blocks = max(1, math.ceil(math.log2(largest / CELL_ROWS) / CELL_BITS))
    tables = tables_for(blocks, least)
    posted = classes.select("node", "label", "vector").mapInArrow(_posted(blocks, tables), "cell long, node long, own boolean, s0 long, s1 long")
    posted = written(posted, f"{label}-posted")
    grouped = met(posted, block).select("cell", "i", "j", "b", "node", "own", "s0", "s1").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    likely = grouped.mapInArrow(_likely, "cell long, node long, own boolean").groupBy("cell", "node").agg(F.max("own").alias("own"))
    likely = written(likely, f"{label}-likely")
    fetched = met(likely, block).join(classes.select("node", "label", "copies", "vector"), "node")
    fetched = fetched.select("cell", "i", "j", "b", "node", "own", "label", "copies", "vector").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    links = written(fetched.mapInArrow(_linked(blocks, tables, least), "node long, other long, links long"), f"{label}-links")
    counts = links.groupBy(F.col("node").alias("n_node")).agg(F.sum("links").alias("outside"))
    roots = components(links.filter("other IS NOT NULL").select("node", "other"), f"{label}-stars")
    sums = classes.select("label", "digest", "low", "copies", "node").join(counts, F.col("node") == F.col("n_node"), "left").drop("n_node")
    sums = sums.join(roots.select(F.col("node").alias("r_node"), "root"), F.col("node") == F.col("r_node"), "left").withColumn("root", F.coalesce("root", "node"))
    least_id = sums.groupBy(F.col("root").alias("l_root")).agg(F.min("low").alias("component_id"))
    sums = written(sums.join(least_id, F.col("root") == F.col("l_root")).select("label", "digest", "copies", F.coalesce("outside", F.lit(0)).alias("outside"), "component_id"), f"{label}-sums")
    linked = named.select("vec_id", "label", "digest").join(sums, ["label", "digest"]).select(
        "vec_id", (F.col("copies") - 1 + F.col("outside")).alias("n_links"), "component_id"
    )
    alone = rows.filter(~F.coalesce(part, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
