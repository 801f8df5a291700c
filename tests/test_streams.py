"""Streams against the batch result of the same plan, and what happens on replay, failure and late rows."""

import json
import os
import time
import uuid

import pytest
from conftest import filing, frame
from pyspark.sql import functions as F

from levyline.operators import clean, kpi, lineage, retrieval
from levyline.plans import jobs
from levyline.schemas import CLEANED, FILING, RUN_EVENT, WINDOW_FILING
from levyline.session import stream_session
from levyline.sinks import lake as lake_sink
from levyline.sinks import serving, vectors
from levyline.sources import lake
from levyline.sources.streams import StreamSpec, end_of_topic, heartbeats, read_stream, without_heartbeats
from levyline.streaming.runner import AVAILABLE_NOW, LineageListener, drain, dropped_late_rows, finish


def stamp(minute, day=7, month=10):
    return f"2026-{month:02d}-{day:02d}T{minute // 60:02d}:{minute % 60:02d}:00.000001+00:00"


class Topic:
    """A folder of JSON text files, one file per put."""

    def __init__(self, folder, name):
        self.folder, self.name, self.n = folder, name, 0
        os.makedirs(folder / name)

    def put(self, *rows):
        target = self.folder / self.name / f"{self.n:03d}-{uuid.uuid4().hex}.txt"
        staged = self.folder / f"{uuid.uuid4().hex}.tmp"
        staged.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
        os.utime(staged, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        os.rename(staged, target)
        self.n += 1

    def stream(self, spark, **options):
        return read_stream(spark, StreamSpec(self.name, str(self.folder), "text", options=options))

    def batch(self, spark):
        return spark.read.text(str(self.folder / self.name))


FAR = stamp(0, 30, 12)


@pytest.fixture
def filings(tmp_path):
    topic = Topic(tmp_path, "filings")
    for part in range(3):
        topic.put(*[
            filing(f"A{part}-{i}", f" C{i % 4} ", taxable_income=100.0 * i + 499_700, is_fraud=i % 5 == 0,
                   province="GAUTENG" if i % 2 else "LIMPOPO", _produced_at=stamp(60 * part + i))
            for i in range(12)
        ], "not json")
    return topic


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_kpi_stream_equals_batch(spark, filings):
    own = stream_session(spark)
    filings.put(filing("far", "far", _produced_at=FAR))
    got = drain(jobs.kpi_windows(filings.stream(own)), spark, "kpi")
    want = jobs.kpi_windows(filings.batch(spark)).where(F.col("window_start") < "2026-12-01")
    assert rows(got) == rows(want) and got.count() == 9


def test_the_end_of_the_topic_closes_the_last_windows(spark, filings):
    filings.put(end_of_topic())
    got = drain(jobs.kpi_windows(filings.stream(stream_session(spark))), spark, "kpi_closed")
    want = jobs.kpi_windows(filings.batch(spark)).where(F.col("window_start") < "2026-12-01")
    assert rows(got) == rows(want) and got.count() == 9


def test_heartbeats_close_windows_of_a_silent_topic(spark, filings):
    own = stream_session(spark)
    messages = filings.stream(own).unionByName(heartbeats(own))
    timed = without_heartbeats(jobs.filings_from(messages, WINDOW_FILING))
    query = (
        kpi.kpi_windows(timed).writeStream.outputMode("append").format("memory").queryName("beating")
        .option("checkpointLocation", str(filings.folder / "beating")).trigger(processingTime="1 second").start()
    )
    try:
        for _ in range(60):
            time.sleep(1)
            if own.table("beating").count() == 9:
                break
    finally:
        query.stop()
    want = jobs.kpi_windows(filings.batch(spark))
    assert rows(own.table("beating")) == rows(want)


def test_fraud_patterns_equal_batch(spark, filings):
    own = stream_session(spark)
    filings.put(filing("far", "far", _produced_at=FAR))
    got = drain(jobs.fraud_patterns(filings.stream(own), minutes=30), spark, "patterns")
    want = jobs.fraud_patterns(filings.batch(spark), minutes=30)
    assert rows(got) == rows(want)
    assert {r["signal_type"] for r in got.collect()} == {"HIGH_FREQUENCY_SUBMISSIONS", "INCOME_SPIKE"}


def test_enrich_stream_equals_batch(spark, filings, tmp_path):
    own = stream_session(spark)
    profiles = Topic(tmp_path, "profiles")
    for i in range(3):
        profiles.put({"customer_id": "C1", "age": 30 + i, "risk_score": 0.5, "_produced_at": stamp(50 * i)})
    filings.put(filing("far", "far", _produced_at=FAR))
    profiles.put({"customer_id": "far2", "age": 1, "_produced_at": FAR})
    fixed = F.lit("2026-01-01").cast("timestamp")
    got = drain(jobs.enriched_filings(filings.stream(own), profiles.stream(own), fixed), spark, "enrich")
    want = jobs.enriched_filings(filings.batch(spark), profiles.batch(spark), fixed)
    assert rows(got) == rows(want.where("application_id <> 'far'"))
    assert got.where("age > 0").count() > 0 and got.where("age = 0").count() > 0


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    own = stream_session(spark)
    topic = Topic(tmp_path, "late")
    topic.put(filing("a", "C1", _produced_at=stamp(60)))
    topic.put(filing("b", "C1", _produced_at=stamp(200)))
    topic.put(filing("c", "C1", _produced_at=stamp(300)))
    topic.put(filing("late", "C1", _produced_at=stamp(61)))   # two batches behind: its window is closed
    topic.put(filing("far", "C1", _produced_at=FAR))
    plan = jobs.kpi_windows(topic.stream(own, maxFilesPerTrigger="1"))
    query = (
        plan.writeStream.outputMode("append").format("memory").queryName("late_kpi")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(**AVAILABLE_NOW).start()
    )
    finish(query)
    assert [r["total_count"] for r in own.table("late_kpi").orderBy("window_start").collect()] == [1, 1, 1]
    assert dropped_late_rows(query) >= 1


def test_clean_sink_writes_the_lake_once(spark, filings, tmp_path):
    own = stream_session(spark)
    out, check = str(tmp_path / "lake"), str(tmp_path / "check")
    for _ in range(2):   # a second start on the same checkpoint finds nothing to do
        finish(lake_sink.start_lake_sink(
            jobs.cleaned_lake(filings.stream(own), F.lit("now")), out, check, "clean", trigger=AVAILABLE_NOW))
    want = jobs.cleaned_lake(filings.batch(spark), F.lit("now"))
    assert rows(lake.read_lake(spark, out)) == rows(want) and want.count() == 36


def test_messages_round_trip(spark, filings, tmp_path):
    own = stream_session(spark)
    found = jobs.fraud_patterns(filings.stream(own), minutes=30).where("signal_type = 'INCOME_SPIKE'")
    finish(serving.start_messages(found, str(tmp_path), "signals", str(tmp_path / "mc"), "signals", "text", trigger=AVAILABLE_NOW))
    table = str(tmp_path / "detections")
    finish(serving.start_upsert(
        jobs.detections(read_stream(own, StreamSpec("signals", str(tmp_path), "text"))), table, str(tmp_path / "dc"),
        "detections", ["detection_id"], [F.desc("detected_at")], trigger=AVAILABLE_NOW))
    stored = spark.read.parquet(table)
    assert stored.count() == jobs.fraud_patterns(filings.batch(spark), minutes=30).where("signal_type = 'INCOME_SPIKE'").count() > 0
    with pytest.raises(ValueError):
        serving.start_messages(found, "x", "y", "z", "w", "odd")


def test_upsert_replaces_by_key_and_survives_replay(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k STRING, v INT, at INT"

    def batch(*values):
        return spark.createDataFrame(list(values), schema)

    serving.upsert_batch(batch(("a", 1, 1), ("a", 2, 2), ("b", 3, 1)), 0, path, ["k"], [F.desc("at")])
    for _ in range(2):
        serving.upsert_batch(batch(("b", 4, 1), ("c", 5, 1)), 1, path, ["k"], [F.desc("at")])
    want = {("a", 2), ("b", 4), ("c", 5)}
    assert {(r["k"], r["v"]) for r in serving.read_current(spark, path, schema, ["k"]).collect()} == want
    assert serving.read_batches(spark, path, schema).count() == 4
    serving.compact(spark, path, str(tmp_path / "u"), schema, ["k"])
    rest = serving.read_batches(spark, str(tmp_path / "u"), schema)
    assert {(r["k"], r["v"]) for r in rest.collect()} == want and rest.first()["batch_id"] == 1


class Counting:
    """Embedder that records, in a folder, the texts it was asked to embed."""

    def __init__(self):
        self.batches = []

    def __call__(self, df, text, output="vector"):
        self.batches.append(df.count())
        return retrieval.letter_embedder(df, text, output)


@pytest.fixture
def sync(spark, tmp_path):
    own = stream_session(spark)
    arrivals, points, check = tmp_path / "arrivals", str(tmp_path / "points"), str(tmp_path / "sync_check")

    def arrive(*ids):
        data = [filing(i, f"c-{i}", submitted_date="2026-10-01") for i in ids]
        lake_sink.write_lake(clean.cleaned(frame(spark, data, FILING), F.lit("2026-01-01 10:00:00")), str(arrivals))

    def run(embed=None):
        stream = own.readStream.schema(CLEANED).parquet(str(arrivals))
        finish(vectors.start_sync(stream, points, check, embed=embed, trigger=AVAILABLE_NOW))

    return arrive, run, points


def test_sync_adds_missing_records_once(spark, sync):
    arrive, run, points = sync
    vectors.load_all(frame(spark, [filing("a")], FILING), points, retrieval.letter_embedder)
    arrive("a", "b", "b", "c")
    embed = Counting()
    run(embed)
    assert embed.batches == [2]                      # b and c; a is there, the second b is a copy
    assert {r["application_id"] for r in vectors.collection(spark, points).collect()} == {"a", "b", "c"}
    run(embed)
    assert embed.batches == [2]                      # nothing new: no batch, no embedding
    arrive("a", "z")
    run(embed)
    assert embed.batches == [2, 1]
    assert vectors.collection(spark, points).count() == 4


def test_a_failing_embedder_leaves_the_input_unread(spark, sync):
    arrive, run, points = sync
    arrive("a", "b")

    def broken(df, text, output="vector"):
        raise RuntimeError("model unavailable")

    with pytest.raises(Exception, match="model unavailable"):
        run(broken)
    run(retrieval.letter_embedder)
    assert vectors.collection(spark, points).count() == 2


def test_listener_writes_lineage(spark, filings, tmp_path):
    own = stream_session(spark)
    listener = LineageListener(lineage.RunLog(spark, str(tmp_path / "runs")))
    own.streams.addListener(listener)
    try:
        drain(jobs.raw_archive(filings.stream(own)), spark, "archive")
        for _ in range(50):
            if not listener.names and os.path.exists(tmp_path / "runs"):
                if spark.read.schema(RUN_EVENT).parquet(str(tmp_path / "runs")).count() == 2:
                    break
            import time

            time.sleep(0.2)
    finally:
        own.streams.removeListener(listener)
    kinds = {r["event_type"] for r in spark.read.schema(RUN_EVENT).parquet(str(tmp_path / "runs")).collect()}
    assert kinds == {"START", "COMPLETE"}


def test_first_arrivals_within_the_watermark(spark, tmp_path):
    from levyline.sources.streams import first_arrivals

    own = stream_session(spark)
    topic = Topic(tmp_path, "twice")
    topic.put(filing("a"), filing("a"), filing("b"))
    topic.put(filing("a"), filing("c"))
    stream = first_arrivals(jobs.filings_from(topic.stream(own, maxFilesPerTrigger="1")))
    assert sorted(r["application_id"] for r in drain(stream, spark, "first").collect()) == ["a", "b", "c"]


def test_chunks_load_by_point_id(spark, tmp_path):
    from levyline.operators import chunks

    files = spark.createDataFrame([("a.md", "## S\none\n## T\ntwo\n## S\nthree")], "file STRING, text STRING")
    vectors.load_chunks(chunks.with_point_ids(chunks.section_chunks(files)), str(tmp_path / "kb"))
    assert {(r["section"], r["text"]) for r in spark.read.parquet(str(tmp_path / "kb")).collect()} == {("T", "T\ntwo"), ("S", "S\nthree")}


def test_bad_specs_are_refused(spark):
    with pytest.raises(ValueError):
        read_stream(spark, StreamSpec("t", "x", "odd"))
    with pytest.raises(ValueError):
        read_stream(spark, StreamSpec("t", "x", starting="middle"))
