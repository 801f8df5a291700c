"""Whole columns of texts as arrays: words, shingles and sets of 64-bit hashes, without a loop over characters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 250_000  # text handled at once, so that its arrays stay in the cache; a longer document is handled alone
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_R_INVERSE = np.uint64(pow(int(_R), -1, 2**64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


BATCH_ROWS = 500  # texts that a Python worker receives at once


def small_batches(docs: DataFrame) -> None:
    """Bounds the Arrow batches of the session: ten thousand texts, Spark's default, can be any number of megabytes."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names for inner columns that no column of `docs` has, whatever a user called theirs."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def own_columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def map_rows(docs: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """mapInArrow to rows of the same columns, whatever their names hold: inside they are numbered."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(function, plain.schema).toDF(*docs.columns)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, base in (("up", _R), ("down", _R_INVERSE)):
            factors = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"][:n]


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets of the rows in them); null texts are empty."""
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (ASCII white space ends words, A-Z lower-cased) and the number of words before each document."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts]), np.searchsorted(starts, offsets)


def shingle_sets(words: np.ndarray, before: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per document its sorted distinct shingles of k words; fewer words are one shingle, no word gives none."""
    factors = [np.uint64(int(_R) ** (2 * j + 3) % 2**64) for j in range(k)]
    n = len(words) - k + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        grams += words[j:j + n] * factors[j]
    grams = mix(grams)
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= k:
            found = np.sort(grams[a:b - k + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            short = np.zeros(1, np.uint64)
            for j in range(b - a):
                short += words[a + j:a + j + 1] * factors[j]
            yield mix(short + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def word_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in text_slices(column):
        yield from shingle_sets(*word_hashes(data, offsets), k)


def set_hash(found: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set, as two signed 64-bit numbers; (0, 0) for the empty set."""
    a, b = mix(found).sum(dtype=np.uint64), mix(found ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))
