"""Exact Jaccard join of shingle sets with count vectors in an R-tree, and the components of its links.

1. Routing. |A| + |B| - 2|A n B| tells in how many places two sets differ; at similarity t and sizes up to U that is at most
   d = (1-t)/(1+t) * 2U. Hashes cut every set into G = d + 1 + e groups, of which two linked sets share e + 1 at least. A set
   posts a hash of each group but its e smallest ones: the largest shared group is then posted by both, so no link is lost.
   Of postings that the same sets share, one is enough.
2. Count vectors. Every set is a point: how many of its tokens fall into each of some groups, four tokens to a group about.
   Points that share a posting meet. Groups of points are cut into blocks in order of size, so that a block has a bounded
   number of tokens, and blocks of comparable sizes meet.
3. R-tree. Points of a block are packed into leaves by size and position; a leaf keeps its largest coordinates and its
   smallest size. The sum of the smaller coordinates bounds the overlap, first with a leaf, then with a point. Points
   within the bound, directly or over others, form a family; all links lie inside families.
4. Only now sets travel: those of a family meet in the same way, and pairs that survive are compared exactly, unless links
   found before already connect them. Only a spanning forest leaves a task.

Equal sets are one point: copies never meet in pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyline.llm.components import components
from levyline.llm.keyfilter import with_maybe_among
from levyline.llm.textsets import free_names, mix, own_columns, set_hash, small_batches, word_sets
from levyline.session import written

LEAF = 32
MOST_DIMS = 1024
BLOCK_TOKENS = 4_000_000
_NO_ID = 2**62  # numbers from here on stand for documents without an id


@dataclass(frozen=True)
class Threshold:
    """Similarity num / den, in whole numbers."""

    num: int
    den: int

    def differing(self, size: int) -> int:
        return (self.den - self.num) * 2 * size // (self.den + self.num)

    def overlap(self, a, b):
        """The least intersection of linked sets of these sizes, rounded up."""
        return -(-self.num * (a + b) // (self.num + self.den))


@lru_cache(maxsize=8)
def size_classes(t: Threshold, top: int = 2**31) -> np.ndarray:
    """Lower bounds of the classes; below the first only equal sets link."""
    low = next(n for n in range(1, 10**6) if t.differing(n) >= 1)
    bounds = [low]
    while bounds[-1] < top:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 7 // 5, -(-bounds[-1] * t.den // t.num)))
    return np.array(bounds, np.int64)


@lru_cache(maxsize=512)
def _groups(t: Threshold, number: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Of a class: how many groups are not posted, where groups begin in hash space, and a salt for each."""
    d = t.differing(int(size_classes(t)[number + 1]) - 1)
    spare = max(1, d // 4)
    n = d + 1 + spare
    begins = np.array([-(-g * 2**64 // n) for g in range(n)], dtype=np.uint64)
    return spare, begins, mix(np.arange(n, dtype=np.uint64) + np.uint64((number + 1) << 32))


def postings(found: np.ndarray, t: Threshold) -> np.ndarray:
    """Hashes under which a set is posted: in its own class and, if a partner can be there, in the next."""
    bounds, n = size_classes(t), len(found)
    own = int(np.searchsorted(bounds, n, "right")) - 1
    out = []
    for number in (own, own + 1):
        if number < 0 or number == own + 1 and n * t.den < int(bounds[number]) * t.num:
            continue
        spare, begins, salt = _groups(t, number)
        starts = np.searchsorted(found, begins)
        counts = np.diff(starts, append=n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(found), dtype=np.uint64)])
        content = sums[starts + counts] - sums[starts]
        out.append(mix(content ^ salt)[np.argsort(counts, kind="stable")[spare:]])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


Sets = Callable[[pa.RecordBatch], Iterator[np.ndarray]]
Pairs = Callable[[list[np.ndarray], np.ndarray, bool, Threshold], list[tuple[int, int]]]


def _post(sets_of: Sets, t: Threshold):
    """Postings of every set, once per partition and distinct set."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, values = [], []
            for found in sets_of(batch):
                node = set_hash(found)[0] if len(found) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                keys.append(postings(found, t))
                values.append(node)
                if len(keys) >= 500:
                    yield _posted(keys, values)
                    keys, values = [], []
            if keys:
                yield _posted(keys, values)

    return run


def _posted(keys: list[np.ndarray], nodes: list[int]) -> pa.RecordBatch:
    lengths = [len(k) for k in keys]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(nodes, np.int64), lengths))], names=["posting", "node"])


def shared_postings(units: DataFrame, sets_of: Sets, t: Threshold, label: str) -> DataFrame:
    """posting, node of the postings that more than one set has; of postings with the same sets only one."""
    posted = units.mapInArrow(_post(sets_of, t), "posting long, node long")
    order = Window.partitionBy("posting").orderBy("node")
    # the same set may come from several partitions: the last of its rows stays
    around = posted.withColumn("after", F.lead("node").over(order)).withColumn("low", F.min("node").over(order))
    met = written(around.filter("after <> node OR after IS NULL AND low <> node").select("posting", "node"), f"{label}-met")
    names = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in range(2)]
    alike = met.groupBy("posting").agg(*names, F.count("*").alias("sets"))
    one = alike.groupBy("x0", "x1", "sets").agg(F.min("posting").alias("posting"))
    return met.join(one.select("posting"), "posting", "left_semi")


def families(units: DataFrame, reps: DataFrame, sets_of: Sets, t: Threshold, label: str) -> DataFrame:
    """family, rep, n of every set of `reps` (h1, rep, n, point) whose point is within the bound of another one that shares a posting."""
    met = shared_postings(units, sets_of, t, label).select(F.col("posting").alias("family"), F.col("node").alias("h1"))
    placed = written(blocks(met.join(reps.select("h1", "rep", "n"), "h1")), f"{label}-cells")
    points = reps.select("h1", F.col("point").alias("tokens"))
    cells = seats(placed, t).join(points, "h1").select("family", "a", "b", "side", "rep", "tokens")
    found = components(verified_links(cells, t, as_point, bounded_pairs), f"{label}-families", forests=True)
    found = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    named = found.select(F.col("root").alias("family"), F.col("node").alias("rep"))
    return named.join(reps.select("rep", "n"), "rep").select("family", "rep", "n")


def blocks(members: DataFrame) -> DataFrame:
    """members (family, rep, n) with `cell` and `side`: once for each pair of blocks in which they take part."""
    salt = F.pmod(F.xxhash64("rep"), F.lit(1024))
    sized = members.withColumn("salt", salt)
    steps = sized.groupBy("family", "n", "salt").agg(F.sum("n").alias("tokens"))
    running = Window.partitionBy("family").orderBy("n", "salt").rowsBetween(Window.unboundedPreceding, -1)
    placed = steps.withColumn("block", F.floor(F.coalesce(F.sum("tokens").over(running), F.lit(0)) / BLOCK_TOKENS))
    return sized.join(placed.drop("tokens"), ["family", "n", "salt"]).drop("salt")


def meeting_blocks(placed: DataFrame, t: Threshold) -> DataFrame:
    """Pairs of blocks of a family whose sizes can link, each block with itself included."""
    ranges = placed.groupBy("family", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("rows"))
    a = ranges.select("family", F.col("block").alias("a"), F.col("most").alias("a_most"), F.col("rows").alias("a_rows"))
    b = ranges.select("family", F.col("block").alias("b"), F.col("least").alias("b_least"))
    near = (F.col("a") < F.col("b")) & (F.col("b_least") * t.num <= F.col("a_most") * t.den)
    alone = (F.col("a") == F.col("b")) & (F.col("a_rows") > 1)
    return a.join(b, "family").filter(near | alone).select("family", "a", "b")


def point(found: np.ndarray, dims: int = 64) -> np.ndarray:
    """How many tokens fall into each group; `dims` is a power of two."""
    return np.bincount((found & np.uint64(dims - 1)).astype(np.int64), minlength=dims)


def dims_of(size: int) -> int:
    """A group for every four tokens about: fewer tell unlike sets not apart, more make points as large as sets."""
    return min(MOST_DIMS, max(64, 1 << (max(size, 1) // 4).bit_length()))


def point_bytes(found: np.ndarray) -> bytes:
    """The point of a set as bytes: the width of a count, then the counts."""
    counts = point(found, dims_of(len(found)))
    width = 1 if counts.max() < 2**8 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def as_point(kept: bytes) -> np.ndarray:
    return np.frombuffer(kept, f"<u{kept[0]}", offset=1).astype(np.int64)


def folded(points: list[np.ndarray]) -> np.ndarray:
    """Points with the groups of the one that has fewest."""
    dims = min(len(p) for p in points)
    return np.stack([p.reshape(-1, dims).sum(axis=0) for p in points])


class RTree:
    """Points packed into leaves by size, then by their first coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        begins = np.arange(0, len(sizes), LEAF)
        self.tops = np.maximum.reduceat(self.points, begins, axis=0)
        self.least = self.sizes[begins]

    def near(self, a: np.ndarray, size: int, t: Threshold) -> np.ndarray:
        """Positions of the points whose bound allows a link with `a`."""
        bound = np.minimum(self.tops, a).sum(axis=1)
        leaves = np.flatnonzero(bound >= t.overlap(size, self.least))
        if not len(leaves):
            return leaves
        at = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < len(self.sizes)]
        fits = np.minimum(self.points[at], a).sum(axis=1) >= t.overlap(size, self.sizes[at])
        return self.order[at[fits]]


def _forest(points: np.ndarray, sizes: np.ndarray, side: np.ndarray, same: bool, t: Threshold,
            holds: Callable[[int, int], bool] | None) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of positions, of the pairs of both sides (`same`: of all) within the bound for which `holds` holds."""
    right = np.arange(len(sizes)) if same else np.flatnonzero(side == 1)
    left = np.arange(len(sizes)) if same else np.flatnonzero(side == 0)
    if not len(right) or not len(left):
        return []
    tree, label, out = RTree(points[right], sizes[right]), np.arange(len(sizes)), []
    for i in left.tolist():
        if len(out) == len(sizes) - 1:
            break
        near = right[tree.near(points[i], int(sizes[i]), t)]
        for j in near[label[near] != label[i]].tolist():
            if label[j] == label[i] or same and j <= i:
                continue
            if holds is None or holds(i, j):
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def linked_pairs(sets: list[np.ndarray], side: np.ndarray, same: bool, t: Threshold) -> list[tuple[int, int]]:
    """A spanning forest of the links between both sides (`same`: among all) as pairs of positions."""
    sizes = np.array([len(s) for s in sets], np.int64)

    def holds(i: int, j: int) -> bool:
        common = int(np.isin(sets[i], sets[j], assume_unique=True, kind="sort").sum())
        return t.den * common >= t.num * (sizes[i] + sizes[j] - common)

    dims = dims_of(int(sizes.min()))
    return _forest(np.stack([point(s, dims) for s in sets]), sizes, side, same, t, holds)


def bounded_pairs(points: list[np.ndarray], side: np.ndarray, same: bool, t: Threshold) -> list[tuple[int, int]]:
    """The same of the pairs whose points allow a link."""
    flat = folded(points)
    return _forest(flat, flat.sum(axis=1), side, same, t, None)


def _as_set(tokens: bytes) -> np.ndarray:
    return np.frombuffer(tokens, np.uint64)


def seats(placed: DataFrame, t: Threshold) -> DataFrame:
    """placed (family, rep, n, block, ...) with the cells (family, a, b) and the side in which each row meets others; without tokens, so light."""
    sides = F.array_distinct(F.array(F.struct(F.col("a").alias("block"), F.lit(0).alias("side")),
                                     F.struct(F.col("b").alias("block"), (F.col("a") != F.col("b")).cast("int").alias("side"))))
    pairs = meeting_blocks(placed, t)
    places = pairs.withColumn("place", F.explode(sides)).select("family", "a", "b", "place.block", "place.side")
    return placed.join(places, ["family", "block"])


def verified_links(rows: DataFrame, t: Threshold, decode: Callable[[bytes], np.ndarray] = _as_set, pairs: Pairs = linked_pairs) -> DataFrame:
    """Links (u, v) between rows (family, a, b, side, rep, tokens) that `pairs` finds; `decode` makes a set of tokens, a binary."""
    # whole cells lie in a task, one after the other; a call per cell would cost more than most cells
    cells = rows.repartition("family", "a", "b").sortWithinPartitions("family", "a", "b")

    def meet(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cuts = _cell_starts(batch)
            if len(cuts) and held and _cell(batch, 0) != _cell(held[-1], 0):
                yield _links_of(pa.Table.from_batches(held), t, decode, pairs)
                held = []
            if len(cuts) > 1:  # what is held ends in this batch
                last = int(cuts[-1])
                yield _links_of(pa.Table.from_batches([*held, batch.slice(0, last)]), t, decode, pairs)
                held, batch = [], batch.slice(last)
            if batch.num_rows:
                held.append(batch)
        if held:
            yield _links_of(pa.Table.from_batches(held), t, decode, pairs)

    return cells.mapInArrow(meet, "u long, v long")


def _cell(batch: pa.RecordBatch, row: int) -> tuple[int, ...]:
    return tuple(batch.column(c)[row].as_py() for c in ("family", "a", "b"))


def _cell_starts(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    keys = np.stack([table.column(c).to_numpy() for c in ("family", "a", "b")])
    return np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if keys.shape[1] else np.zeros(0, int)


def _links_of(table: pa.Table, t: Threshold, decode: Callable[[bytes], np.ndarray], pairs: Pairs) -> pa.RecordBatch:
    """Links inside every cell of a table of whole cells."""
    starts, links = _cell_starts(table), []
    a, b, side, rep = (table.column(c).to_numpy() for c in ("a", "b", "side", "rep"))
    tokens = table.column("tokens").to_pylist()
    for first, last in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=False):
        rows = list({(side[i], rep[i], tokens[i]): i for i in range(first, last)}.values())
        found = pairs([decode(tokens[i]) for i in rows], side[rows], bool(a[first] == b[first]), t)
        links += [(rep[rows[i]], rep[rows[j]]) for i, j in found]
    both = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["u", "v"])


def _components_of_rows(docs: DataFrame, words: int, t: Threshold, label: str) -> DataFrame:
    """doc_id, key (hash of id and text), n, number and root (numbers of the document and of its component) of every row."""
    small_batches(docs)
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))

    def classes(batches):
        for batch in batches:
            numbers, points = [], []
            for found in word_sets(batch.column(1), words):
                numbers.append((len(found), *set_hash(found)))
                points.append(point_bytes(found) if len(found) else None)
            rows = np.array(numbers, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(rows[:, i].copy()) for i in range(3)), pa.array(points, pa.binary())],
                names=["doc_id", "key", "n", "h1", "h2", "point"])

    per_doc = written(texts.mapInArrow(classes, "doc_id long, key long, n long, h1 long, h2 long, point binary"), f"{label}-documents")
    # a number for every row: its id, or one that no id has
    number = F.coalesce("doc_id", F.col("h1").bitwiseAND(_NO_ID - 1) + F.lit(_NO_ID))
    per_doc = per_doc.withColumn("number", number)
    filled = per_doc.filter("n > 0")
    reps = filled.groupBy("h1", "h2", "n").agg(F.min("number").alias("rep"))
    # a representative's point stands in its own row
    points = per_doc.select(F.col("number").alias("rep"), "h1", "point").join(reps.drop("h2"), ["rep", "h1"])
    members = families(texts, points.dropDuplicates(["rep", "h1"]), lambda batch: word_sets(batch.column(1), words), t, label)
    placed = written(blocks(members), f"{label}-blocks")

    def tokens(batches):
        for batch in batches:
            sets = list(word_sets(batch.column(1), words))
            own = [r if r is not None else (set_hash(s)[0] & (_NO_ID - 1)) + _NO_ID
                   for r, s in zip(batch.column(0).to_pylist(), sets, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["rep", "n", "tokens"])

    wanted = placed.select(F.col("rep").alias("doc_id")).distinct()
    near = with_maybe_among(texts.filter("doc_id IS NOT NULL"), F.col("doc_id"), wanted, "open").filter("open")
    named = near.join(wanted, "doc_id", "left_semi").select("doc_id", "text")
    chosen = named.unionByName(texts.filter("doc_id IS NULL").select("doc_id", "text"))
    with_tokens = chosen.mapInArrow(tokens, "rep long, n long, tokens binary")
    # tokens travel twice: to their seats, and to the cells of these
    links = verified_links(seats(placed, t).join(with_tokens, ["rep", "n"]).select("family", "a", "b", "side", "rep", "tokens"), t)
    # copies, and rows that share an id
    low = reps.select("h1", "h2", F.col("rep").alias("v"))
    same = filled.join(low, ["h1", "h2"]).filter("number <> v").select(F.col("number").alias("u"), "v")
    roots = components(links.unionByName(same), f"{label}-links", forests=True)
    joined = per_doc.join(roots, per_doc.number == roots.node, "left")
    return joined.select("doc_id", "key", "n", "number", F.coalesce("root", "number").alias("root"))


def jaccard_components(docs: DataFrame, words: int, num: int, den: int, label: str = "ngram-join") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text; other columns are left out).

    Two documents link when the Jaccard similarity of their sets of shingles of `words` words is num / den or more;
    component_id is the smallest doc_id that links reach. Texts that are null or have no word link with nothing. Rows that
    share a doc_id are one document. A row without a doc_id takes part; its component_id is null if no row with an
    id is reached. An empty table gives no rows.
    """
    rows = _components_of_rows(docs, words, Threshold(num, den), label)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root") < _NO_ID, F.col("root")).alias("component_id"))


def one_per_component(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, label: str = "near-copies") -> DataFrame:
    """The rows of `docs`, with all their columns, that stay when each component keeps its smallest doc_id.

    Of rows that share that id one stays. Texts without a word stay, one per doc_id; those without an id are one document.
    """
    rows = _components_of_rows(docs, words, Threshold(num, den), label)
    rows = written(rows.select("key", "number", "root"), f"{label}-rows")
    kept = rows.groupBy("root").agg(F.min(F.struct("number", "key")).alias("first"), F.count("*").alias("n"))
    kept = kept.select("root", F.col("first.key").alias("kept_key"), "n")
    # documents that share their component with no other row need no decision, and no shuffle
    shared = rows.join(kept.filter("n > 1"), "root").select("key")
    key, open_, nth = free_names(docs, "key", "open", "nth")
    keyed = with_maybe_among(docs.withColumn(key, F.xxhash64("doc_id", "text")), F.col(key), shared, open_)
    alone = keyed.filter(~F.col(open_)).select(*own_columns(docs))
    kept_keys = kept.select(F.col("kept_key").alias(key)).distinct()
    left = keyed.filter(open_).join(kept_keys, key, "left_semi")
    place = F.row_number().over(Window.partitionBy(key).orderBy("doc_id"))
    return alone.unionByName(left.withColumn(nth, place).filter(F.col(nth) == 1).select(*own_columns(docs)))
