"""Fuzzy line dedup: MinHash banding, exact verification, and one line kept per component.

A line is the set of its character shingles (`Q` bytes of the lower-cased line with single spaces). One hash of every shingle gives
all minima: hash space is cut into `BINS` ranges and the smallest hash in each range is one value of the signature; empty ranges borrow from the
next. Bands of `ROWS` values make lines meet. Most lines that meet are unlike, so they meet as sketches: bit g of a sketch tells whether
an odd number of shingles falls into group g, so two sketches differ in at most as many bits as the sets do in shingles, and no link
is lost. Lines within that bound, directly or over others, form a family; only lines of families are fetched and compared exactly, and
links are joined to components by distributed union-find, as in the n-gram join. Of every component the first line by document and
place stays.

Equal sets are one line to the banding, so a line that a third of all documents hold meets others once per partition. Lines that share
a band are compared in cells of `CELL` lines by `CELL`, however many share it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyline.llm.components import components, forest
from levyline.llm.decontaminate import qgrams
from levyline.llm.keyfilter import with_maybe_among
from levyline.llm.ngram_join import Threshold, blocks, seats, verified_links
from levyline.llm.textsets import free_names, mix, small_batches, text_slices
from levyline.session import written

Q = 5
BINS, ROWS, BANDS = 32, 3, 10  # a pair at 0.8 shares a band with a chance of 0.999
SIMILAR = Threshold(80, 100)
CELL = 8192  # lines of a band that meet in one task
HELD = 30_000  # rows of whole cells compared at once
WORDS = 4  # of 64 bits in the sketch of a short line
_BITS = 44  # of a shingle's hash next to the number of its line
_LOW = np.uint64(2**_BITS - 1)
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[[9, 11, 12, 13]] = 32


def line_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines before each document, line of each shingle, hash of each shingle); blank lines have no shingle.

    Lines end at a line feed or at the end of their document; every document has one line at least.
    """
    clean = _CLEAN[data]
    feed = clean == 10
    feeds = np.cumsum(feed)
    # a byte's line: the feeds before it plus the documents before it
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    line = feeds - feed + doc
    per_doc = np.concatenate([[0], feeds])[offsets] + np.arange(len(offsets))
    # one space between words, none at the ends
    letter = ~feed & (clean != 32)
    kept = letter.copy()
    kept[1:] |= letter[:-1] & ~feed[1:] & (line[1:] == line[:-1])
    at = np.flatnonzero(kept)
    text, line = clean[at], line[at]
    blank = np.flatnonzero(text == 32)
    last = blank[(blank + 1 == len(text)) | (line[np.minimum(blank + 1, len(text) - 1)] != line[blank])]
    if len(last):
        stay = np.ones(len(text), bool)
        stay[last] = False
        text, line = text[stay], line[stay]
    if not len(text):
        return per_doc, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    wide = text.astype(np.uint64)
    grams = qgrams(np.append(text, np.zeros(8 - Q, np.uint8))) & np.uint64(2 ** (8 * Q) - 1)
    whole = line[:len(grams)] == line[Q - 1:] if len(grams) else np.zeros(0, bool)
    grams, owner = grams[whole], line[:len(whole)][whole]
    # a shorter line is one shingle
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    lengths = np.diff(np.append(first, len(line)))
    few = first[lengths < Q]
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for j in range(Q - 1):
            inside = j < lengths[lengths < Q]
            short[inside] |= wide[few[inside] + j] << np.uint64(8 * j)
        grams, owner = np.concatenate([grams, short | np.uint64(1 << 60)]), np.concatenate([owner, line[few]])
    return per_doc, owner, mix(grams + np.uint64(1))


def line_sets(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines, where each begins, shingles): the distinct shingles of every line, sorted, with the line above their bits."""
    both = np.sort((owner.astype(np.uint64) << np.uint64(_BITS)) | (hashes >> np.uint64(64 - _BITS)))
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    line = (both >> np.uint64(_BITS)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(both) else np.zeros(0, np.int64)
    return line[begins], begins, both


def bands(begins: np.ndarray, both: np.ndarray) -> np.ndarray:
    """One row of BANDS hashes per line."""
    number = np.zeros(len(both), np.int64)
    number[begins[1:]] = 1
    number = np.cumsum(number)
    shift = np.uint64(_BITS - 5)  # 32 bins
    place = both >> shift
    lowest = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    values = np.full((len(begins), BINS), 2**64 - 1, np.uint64)
    missing = np.ones((len(begins), BINS), bool)
    row, column = number[lowest], (place[lowest] & np.uint64(BINS - 1)).astype(np.int64)
    values[row, column] = both[lowest] & _LOW
    missing[row, column] = False
    own, had = values.copy(), ~missing
    for step in range(1, BINS):
        if not missing.any():
            break
        there = np.roll(had, -step, axis=1) & missing
        values[there] = (np.roll(own, -step, axis=1) + np.uint64(step << _BITS))[there]
        missing &= ~there
    out = np.zeros((len(begins), BANDS), np.uint64)
    for j in range(ROWS):
        out = mix(out + values[:, j:j + ROWS * BANDS:ROWS])
    return mix(out + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketches(begins: np.ndarray, both: np.ndarray, wanted: np.ndarray) -> pa.Array:
    """Of each wanted line the parities of its shingles by group, as bits; of others nothing.

    The groups are a power of two, 0.64 for each shingle at least: two unlike lines then differ in more bits than linked ones may.
    """
    sizes = np.diff(np.append(begins, len(both)))
    least = np.maximum(64 * WORDS, np.ceil(0.64 * sizes))
    bits = np.where(wanted, 2 ** np.ceil(np.log2(least)).astype(np.int64), 0)
    ends = np.concatenate([[0], np.cumsum(bits)])
    own = np.repeat(wanted, sizes)
    group = (both[own] & (np.repeat(bits, sizes)[own] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(ends[:-1], sizes)[own] + group, minlength=ends[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(bits), [None, pa.py_buffer((ends // 8).astype(np.int32)), pa.py_buffer(packed)])


def _lines(batches) -> Iterator[pa.RecordBatch]:
    """(key, line, h1, n, bands, sketch): every line that is not blank; the last two only where a set comes first in its partition."""
    seen: set[int] = set()
    for batch in batches:
        keys = batch.column(1).to_numpy(zero_copy_only=False)
        for first, last, data, offsets in text_slices(batch.column(0)):
            per_doc, owner, hashes = line_shingles(data, offsets)
            lines, begins, both = line_sets(owner, hashes)
            if not len(lines):
                continue
            low = both & _LOW
            h1 = np.add.reduceat(mix(low), begins).view(np.int64)
            n = np.diff(np.append(begins, len(both)))
            doc = np.searchsorted(per_doc, lines, "right") - 1
            new = np.array([h not in seen and not seen.add(h) for h in h1.tolist()])
            lists = bands(begins, both)[new]
            ends = np.concatenate([[0], np.cumsum(np.where(new, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first:last][doc]), pa.array(lines - per_doc[doc]), pa.array(h1), pa.array(n),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(lists.ravel())), sketches(begins, both, new)],
                names=["key", "line", "h1", "n", "bands", "sketch"])


def bounded_links(names: np.ndarray, sides: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, flat: np.ndarray, ends: np.ndarray, t: Threshold) -> np.ndarray:
    """A forest of the pairs of rows whose sizes and sketches allow a link; rows lie by cell (`names`), then by size.

    Row i's sketch is words `ends[i]` to `ends[i + 1]` of `flat`. Rows on one side of a cell of two blocks do not meet (side 2: all do).
    """
    wide = np.diff(ends)

    def halved(rows: np.ndarray, width: int, to: int) -> np.ndarray:
        words = flat[ends[rows][:, None] + np.arange(width)]
        return np.bitwise_xor.reduce(words.reshape(len(rows), -1, to), axis=1)

    def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) * (t.den + t.num)

    short = np.zeros((len(sizes), WORDS), np.uint64)
    for width in np.unique(wide).tolist():
        rows = np.flatnonzero(wide == width)
        short[rows] = halved(rows, width, WORDS)
    last = np.flatnonzero(np.concatenate([names[1:] != names[:-1], [True]]))
    # rows lie by size, so a row's partners end at the last one of its cell that is not too large
    stop = np.repeat(last, np.diff(np.concatenate([[-1], last])))
    found, label = np.unique(nodes, return_inverse=True)
    left, step = np.arange(len(sizes)), 1
    while len(left):
        left = left[left + step <= stop[left]]
        left = left[sizes[left + step] * t.num <= sizes[left] * t.den]
        right = left + step
        # a large group of near copies is connected after a step or two
        a = left[((sides[left] != sides[right]) | (sides[left] == 2)) & (label[left] != label[right])]
        b = a + step
        most = (t.den - t.num) * (sizes[a] + sizes[b])
        near = differing(short[a], short[b]) <= most
        a, b, most = a[near], b[near], most[near]
        linked = []
        for width in np.unique(wide[a]).tolist():
            # b is no smaller than a, so its sketch is no shorter
            for other in np.unique(wide[b][wide[a] == width]).tolist():
                these = (wide[a] == width) & (wide[b] == other)
                fits = differing(halved(a[these], width, width), halved(b[these], other, width)) <= most[these]
                linked.append(np.stack([label[a[these][fits]], label[b[these][fits]]], axis=1))
        if sum(map(len, linked)):
            below = forest(np.concatenate(linked))
            root = np.arange(len(found))
            root[below[:, 0]] = below[:, 1]
            label = root[label]
        step += 1
    below = np.flatnonzero(found[label] != nodes)
    return np.unique(np.stack([nodes[below], found[label[below]]], axis=1), axis=0)


def _bounded(batches) -> Iterator[pa.RecordBatch]:
    """u, v of bounded_links of rows (value, a, b, side, node, n, sketch) that lie by cell and size; whole cells are compared."""

    def links(table: pa.Table) -> pa.RecordBatch:
        keys = np.stack([table.column(c).to_numpy() for c in ("value", "a", "b")])
        names = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
        sketch = pa.concat_arrays(table.column("sketch").chunks)
        ends = np.frombuffer(sketch.buffers()[1], np.int32)[sketch.offset:sketch.offset + len(sketch) + 1]
        flat = np.frombuffer(sketch.buffers()[2], np.uint8)[ends[0]:ends[-1]].copy().view(np.uint64)
        side, node, n = (table.column(c).to_numpy() for c in ("side", "node", "n"))
        found = bounded_links(names, side, node, n, flat, (ends - ends[0]).astype(np.int64) // 8, SIMILAR)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < HELD:
            continue
        keys = [batch.column(c).to_numpy() for c in ("value", "a", "b")]
        begins = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if len(begins):  # what is held ends in this batch
            held[-1] = batch.slice(0, int(begins[-1]))
            yield links(pa.Table.from_batches(held))
            held = [batch.slice(int(begins[-1]))]
            rows = held[0].num_rows
    if held:
        yield links(pa.Table.from_batches(held))


def _met_in_cells(lines: DataFrame) -> DataFrame:
    """value, a, b, side, node, n: the cells of every line that shares a band with a line of a size that allows a link.

    Of lines of a band (`value`) in more than CELL rows each block meets itself (side 2) and, as one of two sides, each other one.
    """
    met = lines.select(F.explode("bands").alias("value"), F.col("h1").alias("node"), F.col("n").cast("int").alias("n"))
    order = Window.partitionBy("value").orderBy("n", "node")
    # the same set may come from several partitions
    one = met.withColumn("before", F.lag("node").over(order)).filter("before IS NULL OR before <> node").drop("before")
    sized = one.withColumns({"less": F.lag("n").over(order), "more": F.lead("n").over(order), "place": F.row_number().over(order)})
    rows = F.max("place").over(Window.partitionBy("value"))
    num, den = F.lit(SIMILAR.num).cast("long"), F.lit(SIMILAR.den).cast("long")
    near = (F.col("less") * den >= F.col("n") * num) | (F.col("n") * den >= F.col("more") * num)
    fit = sized.filter("less IS NOT NULL OR more IS NOT NULL").withColumn("blocks", F.ceil(rows / CELL)).filter(near)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("own")
    placed = fit.select("value", "node", "n", own, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    return placed.select("value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), side.alias("side"), "node", "n")


def families(lines: DataFrame, label: str) -> DataFrame:
    """node, root of all lines (h1, n, bands, sketch) whose sketch is within the bound of that of another one that shares a band."""
    first = lines.filter("size(bands) > 0")
    sketch = first.groupBy(F.col("h1").alias("node")).agg(F.min("sketch").alias("sketch"))
    cells = _met_in_cells(first).join(sketch, "node").select("value", "a", "b", "side", "node", F.col("n").cast("long").alias("n"), "sketch")
    cells = cells.repartition("value", "a", "b").sortWithinPartitions("value", "a", "b", "n")
    return components(cells.mapInArrow(_bounded, "u long, v long"), label, forests=True)


def _wanted_lines(batches) -> Iterator[pa.RecordBatch]:
    """(family, a, b, side, rep, tokens) of the wanted lines of each text, as they stand there."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            lines = text.split("\n")
            rows += [(w["family"], w["a"], w["b"], w["side"], w["rep"], lines[w["line"]].encode()) for w in wanted]
        numbers = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
        yield pa.RecordBatch.from_arrays([*numbers, pa.array([r[5] for r in rows], pa.binary())], names=["family", "a", "b", "side", "rep", "tokens"])


def _line_set(line: bytes) -> np.ndarray:
    return np.unique(line_shingles(np.frombuffer(line, np.uint8), np.array([0, len(line)]))[2])


def dropped_lines(docs: DataFrame, label: str = "lines") -> DataFrame:
    """key (hash of doc_id and text) and the numbers (from 0) of the lines that a document loses.

    Documents without a letter do not occur. The first line of a component is the least by doc_id (null last), key and number.
    """
    small_batches(docs)
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).filter("text IS NOT NULL")
    found = texts.select("text", "key").mapInArrow(_lines, "key long, line long, h1 long, n long, bands array<long>, sketch binary")
    lines = written(found, f"{label}-all")
    near = families(lines, f"{label}-families")
    near = near.unionByName(near.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "family")
    one = lines.filter("size(bands) > 0").groupBy("h1", "n").agg(F.min(F.struct("key", "line")).alias("at"))
    members = one.join(near, one.h1 == near.node).select("family", F.col("h1").alias("rep"), "n", "at.key", "at.line")
    placed = written(blocks(members), f"{label}-blocks")
    side = F.col("side").cast("long").alias("side")
    wanted = seats(placed, SIMILAR).groupBy("key").agg(F.collect_list(F.struct("family", "a", "b", side, "rep", "line")).alias("wanted"))
    near = with_maybe_among(texts, F.col("key"), placed.select("key"), "open").filter("open")
    rows = near.join(wanted, "key").select("text", "wanted").mapInArrow(_wanted_lines, "family long, a long, b long, side long, rep long, tokens binary")
    links = verified_links(rows, SIMILAR, _line_set)
    roots = components(links, f"{label}-links")
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key")).distinct()
    ranked = lines.select("key", "line", "h1").join(ids, "key").join(roots, F.col("h1") == roots.node, "left")
    ranked = ranked.select("key", "line", F.coalesce("root", "h1").alias("root"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("place"))
    firsts = ranked.groupBy(F.col("root").alias("f_root")).agg(F.min(F.struct("place", "key", "line")).alias("first"))
    judged = ranked.join(firsts, ranked.root == F.col("f_root"))
    lost = F.struct("place", "key", "line") != F.col("first")
    return judged.groupBy("key").agg(F.sort_array(F.collect_set(F.when(lost, F.col("line")))).alias("lost"))


def without_repeats(docs: DataFrame, label: str = "lines") -> DataFrame:
    """The rows of `docs`, with all their columns, without lines that are like an earlier one; adds n_lines and n_lost, which
    take the place of columns of these names.

    Blank lines stay. A text keeps its other lines in order, and is empty if it loses all. Null texts stay null. Rows alike
    in doc_id and text are one document and lose the same lines.
    """
    lost = written(dropped_lines(docs, label).filter("size(lost) > 0"), f"{label}-lost")
    own_key, open_, key, gone = free_names(docs, "own", "open", "key", "lost")
    lost = lost.select(F.col("key").alias(key), F.col("lost").alias(gone))
    own = with_maybe_among(docs.withColumn(own_key, F.xxhash64("doc_id", "text")), F.col(own_key), lost.select(key), open_)
    none = F.array().cast("array<bigint>")
    # documents that lose nothing need no shuffle
    whole = own.filter(~F.col(open_)).withColumn(gone, none)
    cut = own.filter(open_).join(lost, F.col(own_key) == F.col(key), "left").withColumn(gone, F.coalesce(gone, none))
    rows = whole.unionByName(cut.drop(key))
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(gone, i.cast("bigint")))
    text = F.when(F.size(gone) > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    filled = F.regexp_count("text", F.lit(r"[^ \t\x0b\x0c\r\n][^\n]*"))
    counts = [F.coalesce(filled, F.lit(0)).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_lost")]
    others = [c for c in docs.columns if c not in ("n_lines", "n_lost")]
    return rows.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in others], *counts)
