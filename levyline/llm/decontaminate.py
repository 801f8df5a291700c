"""Benchmark decontamination by q-gram lemma filtering.

An item of which any window of m = SEGMENT characters (shorter items: the whole item) occurs in a document with at most
k = m * EDIT_SHARE edits is a leak. Such a region shares at least m - q + 1 - k * q of the window's q-grams, and all of
them on diagonals (place in the document less place in the item) no more than 2k apart. So shared q-grams are counted
in overlapping bands of diagonals, twice as wide as that and half overlapping, and inside a band within a sliding window.
All windows that reach the bound are verified by alignment inside the band, together. Long items are cut into overlapping pieces of SPAN
characters, so that every window lies in one.

Texts are compared in lower case with every run of other than letters and digits as one space. Segments shorter than q
characters tell nothing and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyline.llm.textsets import map_rows, small_batches, text_slices
from levyline.session import written

Q = 8  # eight bytes are one 64-bit number
SEGMENT, SPAN = 120, 240  # length of a window, and of the pieces that items are cut into
EDIT_SHARE = 0.1
BLOCK_SEGMENTS = 25_000  # pieces, twice as long as a window, searched for in one pass, the bound of what is broadcast
EXPAND = 2_000_000  # q-gram matches looked at together
_FILTER_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def edit_budget(length: int) -> int:
    """Edits allowed in a segment; never so many that no shared q-gram is left."""
    return max(0, min(int(length * EDIT_SHARE), (length - Q) // Q))


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of lower-case texts with single spaces, the texts' new offsets, and where each byte stood."""
    words = _WORD_BYTE[data]
    kept = words.copy()
    kept[1:] |= words[:-1]
    at = np.flatnonzero(kept)
    out = np.where(words[at], data[at], 32).astype(np.uint8)
    return out, np.searchsorted(at, offsets), at


def qgrams(data: np.ndarray) -> np.ndarray:
    """The number made of the Q bytes from every place on."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(data) - Q + 1,), "<u8", np.ascontiguousarray(data), 0, (1,)).copy()


def segments_of(text: str | None) -> list[bytes]:
    """Pieces of an item; every window of SEGMENT characters lies in one of them."""
    data = np.frombuffer((text or "").lower().encode(), np.uint8)
    out = normalised(data, np.array([0, len(data)]))[0].tobytes().strip() if len(data) else b""
    if len(out) <= SPAN:
        return [out] if len(out) >= Q else []
    starts = [*range(0, len(out) - SPAN, SPAN - SEGMENT + 1), len(out) - SPAN]
    return [out[s:s + SPAN] for s in starts]


@dataclass
class Index:
    """q-grams of the segments of one pass with their places."""

    items: np.ndarray
    segments: list[bytes]

    def __post_init__(self):
        grams = [qgrams(np.frombuffer(s, np.uint8)) for s in self.segments]
        counts = [len(g) for g in grams]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.arange(len(grams)), counts)[order]
        self.place = (np.concatenate([np.arange(c) for c in counts]) if grams else np.zeros(0, np.int64))[order]
        self.grams, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.known = np.zeros(1 << _FILTER_BITS, bool)
        self.known[self._slot(self.grams)] = True
        self.lengths = np.array([min(len(s), SEGMENT) for s in self.segments], np.int64)  # of a window
        self.room = np.array([len(s) for s in self.segments], np.int64) - self.lengths  # the last place where one begins
        self.edits = np.array([edit_budget(int(n)) for n in self.lengths], np.int64)
        self.needed = self.lengths - Q + 1 - self.edits * Q

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams * _SPREAD) >> np.uint64(64 - _FILTER_BITS)

    def matches(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of q-grams that some segment has, and their numbers."""
        grams = qgrams(data)
        at = np.flatnonzero(self.known[self._slot(grams)])
        if not len(at) or not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        number = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        same = self.grams[number] == grams[at]
        return at[same], number[same]

    def bands(self, at: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(segment, lowest diagonal, q-grams, starts of the windows) of the bands of one document where windows reach the bound."""
        parts = list(_bounded(at, number, self.count))
        # a segment that shares too few q-grams with the whole document has no band that reaches its bound
        total = np.zeros(len(self.segments), np.int64)
        for _, n in parts:
            total += np.bincount(self.owner[self._slots(n)], minlength=len(total))
        enough = total >= self.needed
        if not enough.any():
            return
        codes = []
        for a, n in parts:
            slots = self._slots(n)
            owner = self.owner[slots]
            stay = enough[owner]
            owner, place = owner[stay], self.place[slots[stay]]
            diagonal = np.repeat(a, self.count[n])[stay] - place
            band = (diagonal + SPAN) // (2 * self.edits[owner] + 1)  # no place is so far left that this is negative
            for b in (band, band - 1):
                codes.append(_distinct(((b + 1) * len(self.segments) + owner) * SPAN + place))
        every = _distinct(np.concatenate(codes))
        every, place = every // SPAN, every % SPAN
        owner = every % len(self.segments)
        # the places i .. j are just as many as needed, and lie in one window if they are close enough
        i = np.arange(len(every))
        j = i + self.needed[owner] - 1
        i, j = i[j < len(every)], j[j < len(every)]
        close = (every[i] == every[j]) & (place[j] - place[i] <= self.lengths[owner[i]] - Q)
        i, j = i[close], j[close]
        if not len(i):
            return
        cuts = np.flatnonzero(every[i][1:] != every[i][:-1]) + 1
        for a, b in zip(np.split(i, cuts), np.split(j, cuts), strict=True):
            o = int(owner[a[0]])
            low = (int(every[a[0]]) // len(self.segments) - 1) * (2 * int(self.edits[o]) + 1) - SPAN
            starts = np.zeros(int(self.room[o]) + 2, np.int64)
            np.add.at(starts, np.clip(place[b] - (self.lengths[o] - Q), 0, self.room[o]), 1)
            np.add.at(starts, np.minimum(place[a], self.room[o]) + 1, -1)
            yield o, low, int(b[-1] - a[0] + 1), np.flatnonzero(starts.cumsum() > 0)

    def _slots(self, number: np.ndarray) -> np.ndarray:
        """Every place in a segment that the q-grams of these numbers have."""
        reps = self.count[number]
        return np.repeat(self.first[number] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())


def _distinct(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)
    return numbers[np.concatenate([[True], numbers[1:] != numbers[:-1]])] if len(numbers) else numbers


def _bounded(at: np.ndarray, number: np.ndarray, count: np.ndarray):
    """Parts of the matches that stand for at most EXPAND places in segments."""
    ends = np.cumsum(count[number])
    first = 0
    while first < len(at):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + EXPAND, "right")))
        yield at[first:last], number[first:last]
        first = last


def aligned(segment: bytes, data: np.ndarray, low: int, width: int) -> tuple[int, int, int]:
    """Fewest edits of `segment` against a part of `data` on the diagonals low .. low + width - 1, and where that part lies."""
    edits, start, stop = aligned_windows(segment, np.zeros(1, np.int64), len(segment), data, low, width)
    return int(edits[0]), int(start[0]), int(stop[0])


def aligned_windows(
    segment: bytes, starts: np.ndarray, length: int, data: np.ndarray, low: int, width: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the windows of `length` characters that begin at `starts` in `segment`, on diagonals of the segment.

    One row of the table per character of a window, one column per diagonal, one layer per window.
    """
    letters = np.frombuffer(segment, np.uint8)
    columns = np.arange(width)
    far = length + 1
    base = starts[:, None] + low + columns  # where each diagonal meets a window's first character
    inside = lambda row: (row + base >= 0) & (row + base <= len(data))
    cost = np.where(inside(0), 0, far)
    start = base
    padded = np.concatenate([np.zeros(max(0, -low), np.uint8), data, np.zeros(max(0, low + width + len(segment) - len(data)), np.uint8)])
    shift = max(0, -low)
    edge = np.full((len(starts), 1), far)
    for row in range(1, length + 1):
        best = cost + (padded[base + (row - 1 + shift)] != letters[starts + (row - 1)][:, None])
        begin = start
        drop = np.concatenate([cost[:, 1:] + 1, edge], axis=1)  # a character of the window without a partner
        take = drop < best
        best, begin = np.where(take, drop, best), np.where(take, np.concatenate([start[:, 1:], 0 * edge], axis=1), begin)
        best = np.where(inside(row), best, far)
        # characters of the document without a partner: the least cost to the left, one more per column
        least = np.minimum.accumulate(best - columns, axis=1)
        from_left = np.maximum.accumulate(np.where(best - columns == least, columns, 0), axis=1)
        cost, start = least + columns, np.take_along_axis(begin, from_left, axis=1)
    end = cost.argmin(axis=1)
    each = np.arange(len(starts))
    return cost[each, end], start[each, end], length + base[each, end]


def exact_window(
    segment: bytes, starts: np.ndarray, length: int, data: np.ndarray, low: int, width: int,
) -> tuple[int, int] | None:
    """Where the first of the windows lies in `data` without any edit, on the first of the diagonals on which it does; or None.

    It is what `aligned_windows` gives for a window without edits, found by runs of equal characters alone.
    """
    letters = np.frombuffer(segment, np.uint8)
    places = np.arange(len(letters)) + low + np.arange(width)[:, None]
    inside = (places >= 0) & (places < len(data))
    same = inside & (data[np.clip(places, 0, len(data) - 1)] == letters)
    sums = np.concatenate([np.zeros((width, 1), np.int64), same.cumsum(axis=1)], axis=1)
    whole = sums[:, starts + length] - sums[:, starts] == length
    windows = np.flatnonzero(whole.any(axis=0))
    if not len(windows):
        return None
    start = int(starts[windows[0]]) + low + int(whole[:, windows[0]].argmax())
    return start, start + length


def leaks_in(column: pa.Array, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item position in `index.items`, start, end, edits) of one leak per row and item; start and end in code points."""
    if not index.segments:
        return
    for first, _, data, offsets in text_slices(pc.utf8_lower(column)):
        clean, ends, origin = normalised(data, offsets)
        at, number = index.matches(clean)
        row = np.searchsorted(ends, at, "right") - 1
        whole = at + Q <= ends[row + 1]
        at, number, row = at[whole], number[whole], row[whole]
        cuts = np.flatnonzero(np.diff(row)) + 1
        for a, n, r in zip(np.split(at, cuts), np.split(number, cuts), np.split(row, cuts), strict=True):
            if not len(r):
                continue
            i = int(r[0])
            begin, text = int(ends[i]), clean[ends[i]:ends[i + 1]]
            done: set[int] = set()
            for o, low, _, windows in sorted(index.bands(a - begin, n), key=lambda x: -x[2]):
                item = int(index.items[o])
                if item in done:
                    continue
                band = index.segments[o], windows, int(index.lengths[o]), text, low, 2 * (2 * int(index.edits[o]) + 1)
                exact = exact_window(*band)  # most leaks are copies
                if exact is not None:
                    edits, start, stop = 0, *exact
                else:
                    found = aligned_windows(*band)
                    edits, start, stop = (int(x[found[0].argmin()]) for x in found)
                if edits <= index.edits[o]:
                    done.add(item)
                    base = data[offsets[i]:offsets[i + 1]]
                    points = lambda to: int((base[:to] & 0xC0 != 0x80).sum())
                    left = int(origin[begin + start]) - int(offsets[i])
                    right = int(origin[begin + stop - 1]) + 1 - int(offsets[i])
                    yield first + i, item, points(left), points(right), edits


def _passes(benchmark: DataFrame) -> Iterator[tuple[Index, np.ndarray]]:
    """An index per BLOCK_SEGMENTS segments, and the item ids that its item positions stand for."""

    def cut(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(i, s) for i, t in zip(ids, texts, strict=True) for s in segments_of(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["item_id", "segment"])

    cuts = benchmark.select("item_id", "text").mapInArrow(cut, "item_id long, segment binary").distinct()
    cuts = written(cuts, "benchmark-segments")
    n = max(1, -(-cuts.count() // BLOCK_SEGMENTS))
    part = F.pmod(F.xxhash64("segment"), F.lit(n))
    for number in range(n):
        rows = cuts.filter(part == number).orderBy("item_id", "segment").collect()  # about BLOCK_SEGMENTS short texts
        names = list(dict.fromkeys(r[0] for r in rows))
        at = {name: i for i, name in enumerate(names)}
        yield Index(np.array([at[r[0]] for r in rows], np.int64), [bytes(r[1]) for r in rows]), names


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits: one row per document and benchmark item that it holds.

    docs: doc_id, text; benchmark: item_id, text; other columns are left out. start and end are code points of the
    lower-cased text. Null and empty texts hold nothing. Rows that share a doc_id are searched each, and equal rows of the result are one.
    """
    small_batches(docs)
    out = None
    for index, names in _passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast((index, names))

        def search(batches, shared=shared):
            mine, ids = shared.value
            for batch in batches:
                found = list(leaks_in(batch.column(1), mine))
                rows = [f[0] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([ids[f[1]] for f in found], pa.int64()),
                     *(pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4))],
                    names=["doc_id", "item_id", "start", "end", "edits"])

        part = docs.select("doc_id", "text").mapInArrow(search, "doc_id long, item_id long, start long, end long, edits long")
        out = part if out is None else out.unionByName(part)
    best = F.min(F.struct("edits", "start", "end")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.start", "best.end", "best.edits")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no benchmark item."""
    small_batches(docs)
    place = docs.columns.index("text")
    for index, _ in _passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches, shared=shared):
            for batch in batches:
                kept = np.ones(len(batch), bool)
                kept[[f[0] for f in leaks_in(batch.column(place), shared.value)]] = False
                yield batch.filter(pa.array(kept))

        docs = map_rows(docs, keep)
    return docs
