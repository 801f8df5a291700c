"""Lineage: run events written by jobs and the tables derived from them."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.schemas import RUN_EVENT

log = logging.getLogger(__name__)


def dataset(namespace: str, name: str, df: DataFrame | None = None) -> dict:
    """Descriptor of a dataset, with the field list when its frame is at hand."""
    fields = [] if df is None else [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]
    return {"namespace": namespace, "name": name, "fields": fields}


class RunLog:
    """Appends START, COMPLETE and FAIL events to a lineage table. A failed write never fails the job."""

    def __init__(self, spark: SparkSession, path: str, namespace: str = "spark"):
        self.spark, self.path, self.namespace = spark, path, namespace

    def emit(self, kind: str, run_id: str, job: str, inputs=(), outputs=(), error: str = "") -> None:
        row = {
            "event_type": kind, "event_time": datetime.now(timezone.utc), "run_id": run_id,
            "namespace": self.namespace, "job_name": job, "inputs": list(inputs), "outputs": list(outputs),
            "error": error,
        }
        try:
            self.spark.createDataFrame([row], RUN_EVENT).write.mode("append").parquet(self.path)
        except Exception as exc:
            log.warning("lineage event %s of %s not written: %s", kind, job, exc)

    def run(self, job: str, work, inputs=(), outputs=()):
        """Run `work` between START and COMPLETE, or FAIL when it raises."""
        run_id = str(uuid.uuid4())
        self.emit("START", run_id, job, inputs, outputs)
        try:
            result = work()
        except Exception as exc:
            self.emit("FAIL", run_id, job, inputs, outputs, str(exc))
            raise
        self.emit("COMPLETE", run_id, job, inputs, outputs)
        return result


def _names(datasets: str) -> Column:
    return F.array_join(F.transform(F.col(datasets), lambda d: d["name"]), ", ")


def _newest(*values: Column) -> Column:
    """The values of the newest event; the run id breaks ties."""
    return F.max_by(F.struct(*values), F.struct("event_time", "run_id"))


def lineage_jobs(events: DataFrame) -> DataFrame:
    """One row per job as of its newest event, inputs and outputs as joined names."""
    newest = events.groupBy("namespace", "job_name").agg(
        _newest(F.col("inputs"), F.col("outputs")).alias("last"), F.max("event_time").alias("updated_at")
    )
    return newest.select("namespace", "job_name", F.col("last.inputs").alias("inputs"),
                         F.col("last.outputs").alias("outputs"), "updated_at").select(
        "namespace", "job_name", _names("inputs").alias("inputs"), _names("outputs").alias("outputs"), "updated_at"
    )


def lineage_datasets(events: DataFrame) -> DataFrame:
    """Every dataset any run touched, with the time it was last touched."""
    touched = events.select("event_time", F.explode(F.concat("inputs", "outputs")).alias("d"))
    return touched.groupBy(F.col("d.namespace").alias("namespace"), F.col("d.name").alias("dataset")).agg(
        F.max("event_time").alias("updated_at")
    )


# the state a run is in after its newest event
RUN_STATE = {"START": "RUNNING", "COMPLETE": "COMPLETED", "FAIL": "FAILED"}


def latest_states(events: DataFrame, registered: DataFrame | None = None) -> DataFrame:
    """Newest run state per job; jobs of `registered` that never ran get NO_RUN."""
    pairs = [F.lit(x) for pair in RUN_STATE.items() for x in pair]
    states = events.groupBy("namespace", "job_name").agg(_newest(F.col("event_type")).alias("last")).select(
        "namespace", "job_name", F.create_map(*pairs)[F.col("last.event_type")].alias("state")
    )
    if registered is None:
        return states
    return registered.select("namespace", "job_name").distinct().join(states, ["namespace", "job_name"], "left").select(
        "namespace", "job_name", F.coalesce("state", F.lit("NO_RUN")).alias("state")
    )


def missing_jobs(expected: DataFrame, events: DataFrame) -> DataFrame:
    """Expected (namespace, job_name) pairs without any event."""
    return expected.select("namespace", "job_name").join(
        events.select("namespace", "job_name").distinct(), ["namespace", "job_name"], "left_anti"
    )


def namespace_totals(events: DataFrame) -> DataFrame:
    """Distinct jobs, and distinct datasets, per namespace."""
    jobs = events.select("namespace", "job_name").distinct().groupBy("namespace").agg(F.count(F.lit(1)).alias("jobs"))
    sets = lineage_datasets(events).groupBy("namespace").agg(F.count(F.lit(1)).alias("datasets"))
    return jobs.join(sets, "namespace", "full").select(
        "namespace", F.coalesce("jobs", F.lit(0)).alias("jobs"), F.coalesce("datasets", F.lit(0)).alias("datasets")
    )
