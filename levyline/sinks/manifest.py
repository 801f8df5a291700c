"""Serving tables that stay small and consistent while a stream writes them.

A table is a folder of data folders (`data/seq=N`, one per commit) and of manifests (`manifest/version=N`, one row each). A manifest names the data
folders that are live. Every change is a new manifest, which appears whole by the rename with which a Spark write ends: an upsert
adds a folder, `compact` puts one folder in the place of all it has read, `purge` leaves out what has expired, `delete` adds
tombstones. A reader takes the newest manifest and sees all of a commit or nothing of it, also while a compaction runs, as live folders are never
written again. Data folders are emptied by `vacuum` once no manifest of the last `keep` versions names them.

A manifest also holds the last batch of every stream that writes the table, so a batch that is replayed after its commit is left out, before
and after a compaction. One writer commits at a time: a stream, and its upkeep between two batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from levyline.operators.skew import latest_per_key

MANIFEST = "live ARRAY<BIGINT>, retired ARRAY<BIGINT>, done MAP<STRING, BIGINT>, layout MAP<BIGINT, INT>"
GONE = "_gone"


@dataclass(frozen=True)
class Snapshot:
    """What a manifest says; version 0 is the empty table."""

    version: int = 0
    live: tuple[int, ...] = ()
    retired: tuple[int, ...] = ()
    done: dict[str, int] = field(default_factory=dict)
    layout: dict[int, int] = field(default_factory=dict)  # what a table notes about each live folder


class ServingTable:
    """Newest row per key. `schema` is a DDL text, `expires` the name of a timestamp column after which a row no longer counts (null: never)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], expires: str | None = None):
        self.spark, self.path, self.schema, self.keys, self.expires = spark, path.rstrip("/"), schema, keys, expires

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest state, or that of a version."""
        try:
            rows = self.spark.read.schema(f"{MANIFEST}, version BIGINT").parquet(f"{self.path}/manifest")
        except AnalysisException:
            return Snapshot()
        row = (rows if version is None else rows.where(F.col("version") == version)).orderBy(F.desc("version")).first()
        return Snapshot() if row is None else Snapshot(row.version, tuple(row.live), tuple(row.retired), dict(row.done), dict(row.layout))

    def rows(self, at: Snapshot | None = None) -> DataFrame:
        """All live rows with the number of their commit, `seq`, and tombstones marked by `_gone`."""
        at = at or self.snapshot()
        schema = f"{self.schema}, {GONE} BOOLEAN, seq BIGINT"
        if not at.live:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/data/seq={s}" for s in at.live]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders)

    def current(self, now: Column | None = None, at: Snapshot | None = None) -> DataFrame:
        """One row per key, the newest; keys that are deleted or (with `now`) expired are left out."""
        newest = latest_per_key(self.rows(at), self.keys, [F.desc("seq")]).where(~F.col(GONE)).drop(GONE, "seq")
        return newest.where(F.coalesce(F.col(self.expires) > now, F.lit(True))) if self.expires and now is not None else newest

    def upsert(self, rows: DataFrame, order: list[Column], batch: tuple[str, int] | None = None) -> bool:
        """Adds the rows, of several with one key the first by `order`. A `batch` (stream, number) that is in already changes nothing."""
        now = self.snapshot()
        if batch and now.done.get(batch[0], -1) >= batch[1]:
            return False
        marked = latest_per_key(rows, self.keys, order).withColumn(GONE, F.lit(False))
        self._commit(now, marked, (*now.live, now.version + 1), (), batch)
        return True

    def delete(self, keys: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """Marks the keys as gone; the next compaction drops them."""
        now = self.snapshot()
        if batch and now.done.get(batch[0], -1) >= batch[1]:
            return
        names = [n for n in self.spark.createDataFrame([], self.schema).schema]
        stones = keys.select(*self.keys).distinct().select(
            *(F.col(f.name) if f.name in self.keys else F.lit(None).cast(f.dataType).alias(f.name) for f in names), F.lit(True).alias(GONE)
        )
        self._commit(now, stones, (*now.live, now.version + 1), (), batch)

    def compact(self, now: Column | None = None) -> None:
        """One folder in place of all; with `now` without the rows that have expired by then."""
        at = self.snapshot()
        if at.live:
            self._commit(at, self.current(now, at).withColumn(GONE, F.lit(False)), (at.version + 1,), at.live, None)

    def purge(self, now: Column) -> None:
        """Drops expired rows from storage. A row that has expired also drops the older ones of its key."""
        if not self.expires:
            raise ValueError("the table has no column of expiry")
        self.compact(now)

    def vacuum(self, keep: int = 2) -> list[int]:
        """Empties the folders that were retired more than `keep` versions ago; returns their numbers."""
        at = self.snapshot()
        old = self.snapshot(max(0, at.version - keep)) if at.version > keep else Snapshot()
        empty = self.spark.createDataFrame([], f"{self.schema}, {GONE} BOOLEAN")
        dead = [s for s in old.retired if s in at.retired]
        for s in dead:
            empty.write.mode("overwrite").parquet(f"{self.path}/data/seq={s}")
        if dead:
            left = tuple(s for s in at.retired if s not in dead)
            self._write(Snapshot(at.version + 1, at.live, left, at.done, at.layout))
        return dead

    def _store(self, rows: DataFrame, seq: int) -> int:
        """Writes a data folder; what an attempt without a manifest has left there is replaced."""
        rows.write.mode("overwrite").parquet(f"{self.path}/data/seq={seq}")
        return 0

    def _commit(self, at: Snapshot, rows: DataFrame, live: tuple, retired: tuple, batch: tuple[str, int] | None) -> None:
        seq = at.version + 1
        note = self._store(rows, seq)
        layout = {s: n for s, n in {**at.layout, seq: note}.items() if s in live}
        done = {**at.done, **({batch[0]: batch[1]} if batch else {})}
        self._write(Snapshot(seq, live, (*at.retired, *retired), done, layout))

    def _write(self, to: Snapshot) -> None:
        row = self.spark.createDataFrame([(list(to.live), list(to.retired), to.done, to.layout)], MANIFEST).coalesce(1)
        row.write.mode("errorifexists").parquet(f"{self.path}/manifest/version={to.version}")


@dataclass(frozen=True)
class Output:
    """A table that a stream writes: what of a micro-batch goes into it, and when rows of it count as expired (now, if not said)."""

    table: ServingTable
    order: list[Column]
    rows: Callable[[DataFrame], DataFrame] = lambda batch: batch
    clock: Callable[[DataFrame], Column] = lambda rows: F.current_timestamp()


def start_serving(
    df: DataFrame, outputs: list[Output], checkpoint: str, name: str, output_mode: str = "append",
    trigger: dict | None = None, compact_every: int = 20,
) -> StreamingQuery:
    """Upserts every micro-batch into its tables and looks after them.

    Every `compact_every` batches the tables are compacted, expired rows dropped and retired folders emptied, between two batches. Batches
    of another stream into the same table are kept apart by its name.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist() if len(outputs) > 1 else batch
        try:
            for out in outputs:
                own = ServingTable(batch.sparkSession, out.table.path, out.table.schema, out.table.keys, out.table.expires)
                own.upsert(out.rows(batch), out.order, (name, number))
                if (number + 1) % compact_every == 0:
                    own.compact(out.clock(own.rows()) if own.expires else None)
                    own.vacuum()
        finally:
            batch.unpersist()

    return (
        df.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"})).foreachBatch(write).start()
    )
