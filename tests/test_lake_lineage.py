import os
from datetime import datetime, timedelta, timezone

import pytest
from conftest import filing, frame
from pyspark.sql import functions as F

from levyline.operators import audit, clean, lineage
from levyline.schemas import AUDIT, FILING, RUN_EVENT
from levyline.sinks import lake as sink
from levyline.sources import lake, streams


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [filing(f"A{i}", f"C{i}", submitted_date=f"2026-10-{i:02d}") for i in range(1, 11)]
    sink.write_lake(clean.cleaned(frame(spark, rows, FILING), F.lit("now")), path)
    files = sorted(f for f in map(str, (tmp_path / "lake").rglob("part-*")) if "/dt=" in f)
    for minute, name in enumerate(files, start=1):
        os.utime(name, (60 * minute, 60 * minute))
    return path


def minute(n):
    return datetime.fromtimestamp(60 * n, timezone.utc)


def days(df):
    return sorted(r["dt"] for r in df.select(F.regexp_extract("path", "dt=2026-10-([0-9]+)", 1).alias("dt")).collect())


def test_newest_files_cap_and_since(spark, stored):
    assert days(lake.newest_files(spark, stored, max_files=3)) == ["08", "09", "10"]
    assert days(lake.newest_files(spark, stored, since=minute(8))) == ["09", "10"]
    rows, newest = lake.recent_arrivals(spark, stored, since=minute(99))
    assert rows.count() == 0 and newest == minute(99)


def test_capped_reads_take_every_file_once(spark, stored):
    seen, since = [], None
    while True:
        rows, until = lake.recent_arrivals(spark, stored, since, max_files=4)
        if until == since:
            break
        seen.append(sorted(r["application_id"] for r in rows.collect()))
        since = until
    assert seen == [["A1", "A2", "A3", "A4"], ["A5", "A6", "A7", "A8"], ["A10", "A9"]]
    again, _ = lake.recent_arrivals(spark, stored, minute(8), overlap=timedelta(minutes=1))
    assert sorted(r["application_id"] for r in again.collect()) == ["A10", "A8", "A9"]


def test_partitions(spark, stored):
    known = lake.partition_inventory(spark, stored)
    assert known.count() == 10 and lake.has_files(spark, stored)
    rows = lake.newest_partitions(lake.read_lake(spark, stored), 7, known)
    assert sorted(r["dt"] for r in rows.collect()) == [f"2026-10-{d:02d}" for d in range(4, 11)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dt" in plan.split("PartitionFilters")[1][:60]


def test_ml_dataset_and_recent_events(spark, stored):
    assert lake.ml_dataset_from_lake(spark, stored, 4).count() == 4
    rows = lake.read_lake(spark, stored).withColumn("province", F.lit(None).cast("string"))
    assert lake.ml_dataset(rows).first()["province"] == "UNKNOWN"
    assert [r["application_id"] for r in lake.recent_events(rows, 2).collect()] == ["A1", "A10"]


def test_compaction_keeps_the_rows(spark, stored, tmp_path):
    from levyline.schemas import CLEANED

    sink.compact_lake(spark, stored, str(tmp_path / "small"), CLEANED)
    assert lake.read_lake(spark, str(tmp_path / "small")).count() == 10


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    log = lineage.RunLog(spark, path)
    df = spark.range(1)
    source = lineage.dataset("kafka", "topic", df)
    assert source["fields"] == [{"name": "id", "type": "bigint"}]
    assert log.run("good", lambda: 7, [source], [lineage.dataset("minio", "lake")]) == 7
    with pytest.raises(ZeroDivisionError):
        log.run("bad", lambda: 1 / 0)
    events = spark.read.schema(RUN_EVENT).parquet(path)
    states = {r["job_name"]: r["state"] for r in lineage.latest_states(events).collect()}
    assert states == {"good": "COMPLETED", "bad": "FAILED"}
    job = lineage.lineage_jobs(events).where("job_name = 'good'").first()
    assert (job["inputs"], job["outputs"]) == ("topic", "lake")
    expected = spark.createDataFrame([("spark", "good"), ("spark", "new")], "namespace STRING, job_name STRING")
    assert [r["job_name"] for r in lineage.missing_jobs(expected, events).collect()] == ["new"]
    assert {r["job_name"]: r["state"] for r in lineage.latest_states(events, expected).collect()} == {"good": "COMPLETED", "new": "NO_RUN"}
    assert {r["namespace"]: (r["jobs"], r["datasets"]) for r in lineage.namespace_totals(events).collect()} == {
        "spark": (2, 0), "kafka": (0, 1), "minio": (0, 1)}


def test_a_failed_lineage_write_does_not_fail_the_job(spark):
    assert lineage.RunLog(spark, "nosuchscheme://x/y").run("job", lambda: "done") == "done"


def test_audit_log(spark):
    rows = [
        {"event_id": " e1 ", "action": "APPLICATION_SUBMITTED", "timestamp": "2026-10-01T13:32:07.5+00:00", "metadata": '{"channel": "WEB"}'},
        {"event_id": "e2", "action": "REFUND_ISSUED", "timestamp": "soon", "metadata": '{"refund_amount": 12.5, "channel": 3}'},
        {"event_id": "e3", "action": "REVIEW_STARTED", "timestamp": None, "metadata": "(broken"}, {"event_id": None},
    ]
    log = audit.audit_log(frame(spark, rows, AUDIT))
    got = {r["event_id"]: r for r in audit.metadata_fields(log).collect()}
    assert set(got) == {"e1", "e2", "e3"}
    assert got["e1"]["channel"] == "WEB" and got["e2"]["refund_amount"] == 12.5 and got["e3"]["channel"] is None
    kinds = {r["action"]: r["actor_type"] for r in audit.actor_counts(log).collect()}
    assert kinds == {"APPLICATION_SUBMITTED": "TAXPAYER", "REFUND_ISSUED": "SYSTEM", "REVIEW_STARTED": "AGENT"}


def test_decode_keeps_rows_with_bad_fields_and_sets_aside_the_rest(spark):
    texts = ['{"application_id": "a", "taxable_income": 5}', '{"application_id": "b", "taxable_income": "abc"}', "oops", "[1]", None, "7"]
    decoded = streams.decode_json(spark.createDataFrame([(t,) for t in texts], "value STRING"), FILING)
    assert [r["_status"] for r in decoded.collect()] == ["ok", "bad_field", "not_json", "not_json", "not_json", "not_json"]
    kept = {r["application_id"]: r["taxable_income"] for r in streams.accepted(decoded).collect()}
    assert kept == {"a": 5.0, "b": None}
    assert sorted(r["_raw"] or "" for r in streams.rejected(decoded).collect()) == ["", "7", "[1]", "oops"]
