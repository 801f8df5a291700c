"""Streams that give out every filing once, versioned serving tables, and the collection that knows what it lacks."""

import os

import numpy as np
import pytest
from conftest import filing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_streams import FAR, Topic, rows, stamp

from levyline.operators import enrich
from levyline.plans import jobs
from levyline.schemas import PROFILE
from levyline.session import stream_session
from levyline.sinks import keyed, manifest
from levyline.sources.streams import accepted, decode_json, end_of_topic, with_event_time
from levyline.streaming import lookup
from levyline.streaming.runner import AVAILABLE_NOW, drain, finish

SCHEMA = "k STRING, v INT, expires_at TIMESTAMP"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), unique=True, max_size=12), st.integers(0, 50), st.integers(0, 9), st.integers(0, 9))
def test_choice_of_the_right_row(times, at, before, after):
    times = sorted(times)
    older = [t for t in times if t <= at]
    i = lookup.newest_before(times, at)
    assert (None if i is None else times[i]) == (older[-1] if older else None)
    near = sorted((t for t in times if at - before <= t <= at + after), key=lambda t: (abs(t - at), -t))
    i = lookup.nearest_within(times, at, before, after)
    assert (None if i is None else times[i]) == (near[0] if near else None)


@pytest.fixture
def topics(tmp_path):
    """Filings and profiles of a few customers over three batches: ties, equal seconds, no customer, no time, rows out of order."""
    rng = np.random.default_rng(7)
    filings, profiles = Topic(tmp_path, "filings"), Topic(tmp_path, "profiles")
    for part in range(3):
        minutes = [int(m) for m in rng.integers(part * 200, part * 200 + 190, 25)]
        filings.put(*[filing(f"A{part}-{i}", f" C{i % 4} ", _produced_at=stamp(m)) for i, m in enumerate(minutes)],
                    filing(f"N{part}", None, _produced_at=stamp(part * 200)), filing(f"T{part}", "C1", _produced_at="soon"), "not json")
        asked = [int(m) for m in rng.integers(part * 200, part * 200 + 190, 12)]
        profiles.put(*[{"customer_id": f"C{m % 4}", "age": 20 + m % 50, "risk_score": 0.5, "_produced_at": stamp(m)} for m in asked],
                     {"customer_id": None, "age": 1, "_produced_at": stamp(part)}, {"customer_id": "C1", "age": 2, "_produced_at": "never"})
    return filings, profiles


@pytest.mark.parametrize("kind", ["asof", "once"])
@pytest.mark.parametrize("spread", [1, 3])
def test_every_filing_once_as_in_the_batch(spark, topics, kind, spread):
    filings, profiles = topics
    own = stream_session(spark)
    fixed = F.lit("2026-01-01").cast("timestamp")
    right = with_event_time(accepted(decode_json(profiles.batch(spark), PROFILE)))
    batch = enrich.enrich_asof if kind == "asof" else enrich.enrich_once
    want = rows(batch(jobs.filings_from(filings.batch(spark)), right, processed_at=fixed))
    for topic in topics:
        topic.put(end_of_topic())
    plan = jobs.asof_enriched_filings if kind == "asof" else jobs.once_enriched_filings
    got = drain(plan(filings.stream(own, maxFilesPerTrigger="1"), profiles.stream(own, maxFilesPerTrigger="1"), fixed, spread), spark, kind)
    assert rows(got) == want and len(want) == 81


def test_state_holds_what_lies_behind_no_watermark(spark, tmp_path):
    """Profiles of 30 days, one a day: two at most stay in the state, with the one that is carried on."""
    own = stream_session(spark)
    filings, profiles = Topic(tmp_path, "filings"), Topic(tmp_path, "profiles")
    for day in range(1, 31):
        filings.put(filing(f"A{day}", "C1", _produced_at=stamp(60, day)))
        profiles.put({"customer_id": "C1", "age": day, "_produced_at": stamp(0, day)})
    for topic in (filings, profiles):
        topic.put(filing("far", "far", _produced_at=FAR) if topic is filings else {"customer_id": "far", "_produced_at": FAR})
    plan = jobs.asof_enriched_filings(filings.stream(own, maxFilesPerTrigger="5"), profiles.stream(own, maxFilesPerTrigger="5"))
    query = (
        plan.select("application_id", "age").writeStream.format("memory").queryName("asof_days")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(**AVAILABLE_NOW).start()
    )
    finish(query)
    got = {r.application_id: r.age for r in own.table("asof_days").collect()}
    assert got == {f"A{day}": day for day in range(1, 31)}
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(sizes) >= 6 and max(sizes[2:]) <= min(sizes[1:]) + 20 and sizes[-1] <= 20


def test_states_are_no_more_than_buckets(spark, tmp_path):
    """600 customers with a filing and two profiles each: their rows lie in the states of buckets, and each finds its own profile."""
    own = stream_session(spark)
    filings, profiles = Topic(tmp_path, "filings"), Topic(tmp_path, "profiles")
    filings.put(*[filing(f"A{c}", f"C{c}", _produced_at=stamp(60)) for c in range(600)])
    profiles.put(*[{"customer_id": f"C{c}", "age": c % 90 + late, "_produced_at": stamp(late)} for c in range(600) for late in (1, 5)])
    for topic in (filings, profiles):
        topic.put(end_of_topic())
    plan = jobs.asof_enriched_filings(filings.stream(own, maxFilesPerTrigger="1"), profiles.stream(own, maxFilesPerTrigger="1"))
    query = (
        plan.select("application_id", "age").writeStream.format("memory").queryName("asof_buckets")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(**AVAILABLE_NOW).start()
    )
    finish(query)
    got = {r.application_id: r.age for r in own.table("asof_buckets").collect()}
    assert got == {f"A{c}": c % 90 + 5 for c in range(600)}
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) <= 4 * lookup.BUCKETS + 10


def table(spark, path):
    return manifest.ServingTable(spark, str(path), SCHEMA, ["k"], expires="expires_at")


def values(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k STRING, v INT, at STRING").select("k", "v", F.col("at").cast("timestamp").alias("expires_at"))


def kept(df):
    return {(r.k, r.v) for r in df.collect()}


def test_versions_of_a_table(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    first = [F.asc("v")]
    assert kept(t.current()) == set() and t.snapshot().version == 0
    assert t.upsert(values(spark, ("a", 1, "2026-01-01"), ("a", 2, "2026-01-01"), ("b", 3, "2026-01-03")), first, ("s", 0))
    assert not t.upsert(values(spark, ("a", 9, "2026-01-01")), first, ("s", 0))  # a replay
    assert t.upsert(values(spark, ("b", 4, "2026-01-05"), ("c", 5, None)), first, ("s", 1))
    assert t.upsert(values(spark, ("d", 6, "2026-01-09")), first, ("other", 0))
    before = t.snapshot()
    assert kept(t.current()) == {("a", 1), ("b", 4), ("c", 5), ("d", 6)}
    t.delete(values(spark, ("d", 0, None)))
    assert kept(t.current()) == {("a", 1), ("b", 4), ("c", 5)}
    moment = F.lit("2026-01-02").cast("timestamp")
    assert kept(t.current(moment)) == {("b", 4), ("c", 5)}
    t.purge(moment)  # a row without a moment of expiry stays
    assert kept(t.current()) == {("b", 4), ("c", 5)} and len(t.snapshot().live) == 1
    # whoever read the older version still reads all of it
    assert kept(t.current(at=before)) == {("a", 1), ("b", 4), ("c", 5), ("d", 6)}
    assert not t.upsert(values(spark, ("z", 1, None)), first, ("s", 1))  # still a replay after the compaction
    assert t.snapshot().done == {"s": 1, "other": 0}
    for n in range(2, 5):
        t.upsert(values(spark, ("b", n, "2026-02-01")), first, ("s", n))
    dead = t.vacuum(keep=2)
    assert set(dead) == set(before.live) | {4} and kept(t.current()) == {("b", 4), ("c", 5)}
    assert all(spark.read.parquet(f"{t.path}/data/seq={s}").isEmpty() for s in dead)
    assert t.vacuum(keep=2) == []


def test_half_a_commit_is_invisible(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(values(spark, ("a", 1, None)), [F.asc("v")])
    t._store(values(spark, ("a", 2, None), ("b", 2, None)).withColumn(manifest.GONE, F.lit(False)), 2)  # then the driver is lost
    assert kept(t.current()) == {("a", 1)}
    t.upsert(values(spark, ("c", 3, None)), [F.asc("v")])
    assert kept(t.current()) == {("a", 1), ("c", 3)}
    with pytest.raises(Exception, match="(?i)exist"):  # a second writer with an old snapshot is refused
        t._commit(manifest.Snapshot(1, (1,)), values(spark, ("x", 1, None)).withColumn(manifest.GONE, F.lit(False)), (1, 2), (), None)


def test_a_stream_looks_after_its_table(spark, tmp_path):
    own = stream_session(spark)
    topic = Topic(tmp_path, "rows")
    for n in range(5):
        topic.put({"k": f"k{n}", "v": n}, {"k": "same", "v": n})
    t = table(spark, tmp_path / "t")
    live = F.from_json("value", "k STRING, v INT")
    parsed = topic.stream(own, maxFilesPerTrigger="1").select(live.alias("r")).select("r.*", F.timestamp_seconds(F.col("r.v") * 60).alias("expires_at"))

    def run():
        finish(manifest.start_serving(
            parsed, [manifest.Output(t, [F.desc("v")], clock=lambda rows: F.timestamp_seconds(F.lit(60)))], str(tmp_path / "c"), "upkeep",
            trigger=AVAILABLE_NOW, compact_every=2))

    run()
    assert kept(t.current()) == {("k2", 2), ("k3", 3), ("k4", 4), ("same", 4)}
    assert len(t.snapshot().live) == 2 and t.snapshot().done == {"upkeep": 4}
    run()
    assert t.snapshot().done == {"upkeep": 4}


def collection(spark, path, parts, each):
    t = keyed.KeyedTable(spark, str(path), "id STRING, v INT", "id")
    for p in range(parts):
        t.upsert(spark.range(p * each, (p + 1) * each).select(F.concat(F.lit("id-"), "id").alias("id"), F.lit(p).alias("v")), [F.asc("v")], ("s", p))
    return t


def test_a_collection_knows_what_it_lacks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_PER_PREFIX", 500)
    monkeypatch.setattr(keyed, "WORDS", 125)
    t = collection(spark, tmp_path / "c", 3, 2000)
    asked = spark.range(5990, 6010).select(F.concat(F.lit("id-"), "id").alias("id"))
    assert sorted(r.id for r in t.lacking(asked).collect()) == [f"id-{n}" for n in range(6000, 6010)]
    t.delete(spark.createDataFrame([("id-5995",)], "id STRING"))
    t.compact()
    assert sorted(r.id for r in t.lacking(asked).collect()) == ["id-5995", *(f"id-{n}" for n in range(6000, 6010))]
    assert t.current().count() == 5999 and t.lacking(asked.limit(0)).isEmpty()
    empty = keyed.KeyedTable(spark, str(tmp_path / "none"), "id STRING, v INT", "id")
    assert empty.lacking(asked).count() == 20


def test_files_opened_do_not_grow_with_the_collection(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_PER_PREFIX", 500)
    monkeypatch.setattr(keyed, "WORDS", 125)
    new = spark.range(10**6, 10**6 + 20).select(F.concat(F.lit("id-"), "id").alias("id"))
    old = spark.range(0, 20).select(F.concat(F.lit("id-"), "id").alias("id"))
    opened = []
    for parts in (1, 4):
        t = collection(spark, tmp_path / f"c{parts}", 1, 4000 * parts)
        files = t.candidates(new, t.snapshot()), t.candidates(old, t.snapshot())
        everything = sum(name.startswith("prefix=") for name in os.listdir(f"{t.path}/data/seq=1"))
        opened.append((len(files[0]), len(files[1]), everything))
    assert opened[1][2] >= 4 * opened[0][2] >= 16
    assert all(new <= 3 and old <= 23 for new, old, _ in opened)
