"""Running streams: to the end of what is available, and with lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from levyline.operators.lineage import RunLog
from levyline.session import work_folder

AVAILABLE_NOW = {"availableNow": True}


def finish(query: StreamingQuery) -> None:
    """Wait for the end; a failed query raises here."""
    query.awaitTermination()


def drain(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run an append stream over all available input into a Parquet folder and read that back.

    What is open at the final watermark comes out only if the input ends with `end_of_topic`, or by `heartbeats` later on.
    """
    folder = work_folder(spark, name)
    query = (
        df.writeStream.queryName(name).outputMode("append").format("parquet")
        .option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**AVAILABLE_NOW).start()
    )
    finish(query)
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


class LineageListener(StreamingQueryListener):
    """Writes START, COMPLETE and FAIL of every named stream to a run log."""

    def __init__(self, runs: RunLog):
        self.runs = runs
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event):
        self.names[str(event.runId)] = event.name or str(event.id)
        self.runs.emit("START", str(event.runId), self.names[str(event.runId)])

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        job = self.names.pop(str(event.runId), str(event.id))
        if event.exception:
            self.runs.emit("FAIL", str(event.runId), job, error=event.exception)
        else:
            self.runs.emit("COMPLETE", str(event.runId), job)


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows the recent batches dropped behind the watermark."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress for op in progress["stateOperators"]
    )
