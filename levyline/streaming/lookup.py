"""Lookups between two streams that give out every left row once, when its answer is certain.

The interval join of Spark gives a row per pair. Here each left row waits in a state until the watermark says that no right row that
could answer it is still to come: then it leaves with one right row or none. Event-time timers answer what is due and drop right rows that
no later row can ask for, so a state holds what lies between the watermark and the newest rows, and one row more per key for an open interval.
A state is that of a bucket of keys, as a call to the state costs far more than a row: there are `buckets` at most, however many keys. A key
that holds a large share of all rows is dealt to `spread` buckets: its left rows by a hash of their id, its right rows to each of them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
STEP = 60  # seconds between the moments at which the rows of a key leave
BUCKETS = 256  # states of a lookup; fixed by the first run of a checkpoint
PACK = 10_000  # rows of a packed batch at most
LATEST = "2262-01-01"  # Python holds times as nanoseconds; a later one is no time


def newest_before(times: list[int], at: int) -> int | None:
    """Index of the last of the sorted times at or before `at`."""
    i = bisect_right(times, at)
    return i - 1 if i else None


def nearest_within(times: list[int], at: int, before: int, after: int) -> int | None:
    """Index of the time closest to `at` within the interval; of two equally close ones the later."""
    i = bisect_right(times, at)
    earlier = i - 1 if i and at - times[i - 1] <= before else None
    later = i if i < len(times) and times[i] - at <= after else None
    if earlier is None or later is None:
        return later if earlier is None else earlier
    return later if times[later] - at <= at - times[earlier] else earlier


Row = tuple[str, int, str]  # key, time, body
ROW = pa.schema([("key", pa.string()), ("at", pa.int64()), ("body", pa.string())])


def packed(rows: list[Row]) -> list[tuple[bytes]]:
    """Rows as state values, each an Arrow stream of `PACK` rows at most."""
    values = []
    for first in range(0, len(rows), PACK):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, ROW) as stream:
            stream.write(pa.record_batch([list(c) for c in zip(*rows[first:first + PACK], strict=True)], schema=ROW))
        values.append((sink.getvalue().to_pybytes(),))
    return values


def unpacked(values: Iterable[tuple[bytes]]) -> list[Row]:
    rows: list[Row] = []
    for value in values:
        table = pa.ipc.open_stream(value[0]).read_all()
        rows.extend(zip(*(c.to_pylist() for c in table.columns), strict=True))
    return rows


class TimedLookup(StatefulProcessor):
    """before None: the newest right row at or before a left row, however old. Else: the nearest within [-before, +after] seconds.

    A bucket has one timer, at the first moment at which a waiting row can leave; calls to the state are what costs, so a batch of a
    bucket takes a handful of them however many keys and rows it has.
    """

    def __init__(self, before: int | None, after: int, step: int = STEP):
        self.before, self.after, self.step = before, after, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.asked = handle.getListState("asked", "rows BINARY")
        self.offered = handle.getListState("offered", "rows BINARY")
        self.carried = handle.getListState("carried", "rows BINARY")
        self.timer = handle.getValueState("timer", "at BIGINT")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        moments = []
        for frame in rows:
            asks = frame["asks"].astype(bool)
            for state, is_ask, part in ((self.asked, True, frame[asks]), (self.offered, False, frame[~asks])):
                if len(part):
                    state.appendList(packed(list(zip(part["key"], part["at"].tolist(), part["body"], strict=True))))
                    moments.append(self._due(int(part["at"].min()), is_ask))
        self._wake(min(moments, default=None), None)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() // 1000
        due: list[Row] = []
        waiting: list[Row] = []
        for row in self._rows(self.asked):
            (due if row[1] + self.after < now else waiting).append(row)
        if due:
            self._put(self.asked, waiting)
        asked_from = min((at for _, at, _ in waiting), default=None)
        offers = self._by_key()
        offered_from = self._prune(offers, now if asked_from is None else min(now, asked_from))
        moments = [self._due(at, is_ask) for at, is_ask in ((asked_from, True), (offered_from, False)) if at is not None]
        self._wake(min(moments, default=None), now)
        for first in range(0, len(due), PACK):
            answers = [(body, self._answer(*offers.get(name, ((), ())), at)) for name, at, body in due[first:first + PACK]]
            yield pd.DataFrame(answers, columns=["body", "found"])

    def _by_key(self) -> dict[str, tuple[list[int], list[str]]]:
        """The right rows of each key by time; of rows of one second the greatest, as in the batch join."""
        rows = self._rows(self.offered)
        if self.before is None:
            rows += self._rows(self.carried)
        rows.sort()
        found: dict[str, tuple[list[int], list[str]]] = {}
        for name, at, body in rows:
            times, bodies = found.setdefault(name, ([], []))
            if times and times[-1] == at:
                bodies[-1] = body
            else:
                times.append(at)
                bodies.append(body)
        return found

    def _answer(self, times: list[int], bodies: list[str], at: int) -> str | None:
        i = newest_before(times, at) if self.before is None else nearest_within(times, at, self.before, self.after)
        return None if i is None else bodies[i]

    def _due(self, at: int, asks: bool) -> int:
        """When a row can leave: no row of its time, or of the end of its interval, is still to come. In whole steps."""
        moment = at + (self.after if asks else self.before or 0) + 1
        return -(-moment // self.step) * self.step

    def _wake(self, first: int | None, now: int | None) -> None:
        """Sets the timer to the moment, unless (now None) an earlier one is set."""
        held = self.timer.get() if now is None and self.timer.exists() else None
        if first is None:
            if now is not None:
                self.timer.clear()
        elif held is None or first < held[0]:
            if held is not None:
                self.handle.deleteTimer(int(held[0]) * 1000)
            first = first if now is None else max(first, (now // self.step + 1) * self.step)
            self.handle.registerTimer(first * 1000)
            self.timer.update((first,))

    def _prune(self, offers: dict[str, tuple[list[int], list[str]]], first: int) -> int | None:
        """Keeps the right rows that a left row from `first` on can ask for; of those before, without a bound in time, the newest of a key.

        Gives the time of the oldest row kept.
        """
        reach = first if self.before is None else first - self.before
        stays: list[Row] = []
        carried: list[Row] = []
        for name, (times, bodies) in offers.items():
            cut = bisect_right(times, reach - 1)
            if cut and self.before is None:
                carried.append((name, times[cut - 1], bodies[cut - 1]))
            stays.extend((name, at, body) for at, body in zip(times[cut:], bodies[cut:], strict=True))
        self._put(self.offered, stays)
        if self.before is None:
            self._put(self.carried, carried)
        return min((at for _, at, _ in stays), default=None)

    @staticmethod
    def _rows(state) -> list[Row]:
        return unpacked(state.get()) if state.exists() else []

    @staticmethod
    def _put(state, rows: list[Row]) -> None:
        if rows:
            state.put(packed(rows))
        else:
            state.clear()


def timed_lookup(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, left_id: str,
    before_seconds: int | None, after_seconds: int = 0, step_seconds: int = STEP, spread: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Each left row of a stream once, with a struct `found` of the right columns (null if nothing answers).

    Both streams need a watermark on their time. Times compare in whole seconds, as in the batch joins of `operators.timejoin`. A left row
    without key or time (or of one after 2261) finds nothing and leaves at once; a right row without them is left out. Rows behind the watermark are dropped by Spark,
    which counts them in the progress of the query.
    """
    known = F.coalesce(F.col(key).isNotNull() & (F.col(left_time) < LATEST), F.lit(False))
    values = [c for c in right.columns if c != key]

    def row(asks: bool, time: str, columns: list[str], salt: Column) -> list[Column]:
        body = F.to_json(F.struct(*columns), JSON)
        name = F.col(key).cast("string")
        bucket = F.pmod(F.xxhash64(name, salt), F.lit(buckets)).cast("int")
        return [bucket.alias("bucket"), name.alias("key"), F.col(time).alias("time"), F.lit(asks).alias("asks"),
                F.unix_seconds(time).alias("at"), body.alias("body")]

    dealt = F.pmod(F.xxhash64(left_id), F.lit(spread)).cast("int")
    asks = left.where(known).select(*row(True, left_time, left.columns, dealt))
    offers = right.where(F.col(key).isNotNull() & (F.col(right_time) < LATEST)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    ).select(*row(False, right_time, values, F.col("_salt")))
    processor = TimedLookup(before_seconds, after_seconds, step_seconds)
    answered = asks.unionByName(offers).groupBy("bucket").transformWithStateInPandas(
        processor, "body STRING, found STRING", "Append", "EventTime"
    )
    types = {"left": left.schema, "found": right.select(*values).schema}
    found = answered.select(F.from_json("body", types["left"], JSON).alias("row"), F.from_json("found", types["found"], JSON).alias("found"))
    nothing = left.where(~known).select(F.struct(*left.columns).alias("row"), F.lit(None).cast(types["found"]).alias("found"))
    return found.unionByName(nothing).select("row.*", "found")
