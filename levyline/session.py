"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on (UTC windows and text) or that guard against skew.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "levyline", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stream_session(spark: SparkSession) -> SparkSession:
    """Sibling session for stateful streams.

    The number of state partitions is fixed by the first run of a checkpoint, so it is taken
    from the cores of the cluster and not from the batch setting of the caller.
    """
    sibling = configure(spark.newSession())
    sibling.conf.set("spark.sql.shuffle.partitions", str(max(2, spark.sparkContext.defaultParallelism)))
    sibling.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # a commit uploads the changes of the batch, not the whole store
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    folder = tempfile.mkdtemp(prefix="levyline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder for one run."""
    return f"{shared_folder(spark)}/levyline/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder.

    For frames that many later jobs read: lineage ends at files every executor can reach, so a
    lost executor costs nothing but its running tasks. The rebalance gives files of even size,
    few for little data and many for much, and so the number of tasks of each later job.
    """
    spark = df.sparkSession
    folder = work_folder(spark, label)
    with shuffles_removed(spark):
        df.hint("rebalance").write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files when they end.

    Else executors keep them until the driver collects garbage, and a job of many steps fills their disks with what no step reads again.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
