from datetime import datetime

import pytest
from conftest import filing, frame
from pyspark.sql import functions as F

from levyline.operators import analytics, kpi, signals
from levyline.schemas import FILING, SIGNAL
from levyline.sources.streams import with_event_time


def at(minute, second=0):
    return f"2026-10-07T17:{minute:02d}:{second:02d}.000001+00:00"


def test_high_frequency_needs_three_in_one_window(spark):
    rows = [filing(f"A{i}", "C1", _produced_at=at(m)) for i, m in enumerate([1, 5, 9, 11])] + [filing("B", "C2", _produced_at=at(1))]
    found = signals.high_frequency_signals(with_event_time(frame(spark, rows, FILING))).collect()
    assert len(found) == 1
    assert found[0]["signal_id"] == "flink-hf-2026-10-07T17:00:00-C1"
    assert found[0]["application_id"] == "MULTIPLE" and found[0]["severity"] == "HIGH"
    assert found[0]["description"] == "Customer submitted 3 applications in 10-min window starting 2026-10-07 17:00:00"


def test_income_spike_text(spark):
    df = frame(spark, [filing(" A1 ", taxable_income=612345.678), filing("A2", taxable_income=500000.0)], FILING)
    rows = signals.income_spike_signals(df).collect()
    assert len(rows) == 1 and rows[0]["signal_id"] == "flink-spike-A1"
    assert rows[0]["description"] == "Taxable income R612345.68 exceeds high-value threshold of R500,000"
    assert rows[0]["detected_at"] == "2026-10-01 13:32:07"


def test_detections_normal_form(spark):
    rows = [{"signal_id": " s1 ", "customer_id": "c", "severity": s} for s in ("low", " Medium ", "CRITICAL", "odd", None)]
    rows += [{"signal_id": None, "customer_id": "c"}, {"signal_id": "x", "customer_id": None}]
    found = signals.detections(frame(spark, rows, SIGNAL)).collect()
    assert [r["severity"] for r in found] == ["LOW", "MEDIUM", "CRITICAL", "HIGH", "HIGH"]
    first = found[0]
    assert (first["detection_id"], first["application_id"], first["signal_type"], first["description"]) == (
        "s1", "UNKNOWN", "UNKNOWN", "No description")
    assert first["detected_at"] == datetime(2000, 1, 1)


def test_domain_violations(spark):
    df = spark.createDataFrame([("LOW", "FLINK"), ("odd", "X"), (None, None)], "severity STRING, source STRING")
    got = {r["column_name"]: (r["checked"], r["violations"]) for r in signals.domain_violations(df, ["severity", "source"]).collect()}
    assert got == {"severity": (3, 1), "source": (3, 1)}


def test_kpi_window_values(spark):
    rows = [
        filing("A", "C1", taxable_income=100.0, is_fraud=True, province="A", _produced_at=at(5)),
        filing("B", "C1", taxable_income=None, is_fraud=None, province="Z", _produced_at=at(9, 59)),
        filing("C", None, taxable_income=200.01, province=None, _produced_at=at(7)),
        filing("D", "C2", _produced_at=at(10)), filing("E", "C2", _produced_at="soon"),
    ]
    got = kpi.kpi_windows(with_event_time(frame(spark, rows, FILING))).orderBy("window_start").collect()
    assert len(got) == 2
    w = got[0]
    assert (w["total_count"], w["distinct_customers"], w["fraud_count"], w["top_province"]) == (3, 1, 1, "Z")
    assert w["avg_income"] == pytest.approx(150.005) and w["fraud_rate"] == pytest.approx(1 / 3)


def test_cache_rows_and_expiry(spark):
    rows = spark.createDataFrame(
        [(datetime(2026, 10, 7, 17, 5), datetime(2026, 10, 7, 17, 10), 300, 366555.255, 290, 44, 0.14666, None)],
        "window_start TIMESTAMP, window_end TIMESTAMP, total_count BIGINT, avg_income DOUBLE, distinct_customers BIGINT, "
        "fraud_count BIGINT, fraud_rate DOUBLE, top_province STRING",
    )
    cache = kpi.kpi_cache_rows(rows, F.lit(datetime(2026, 10, 7, 17, 10)))
    row = cache.first()
    assert row["cache_key"] == "tax:kpi:window:2026-10-07T17:05:00"
    assert (row["avg_income"], row["fraud_rate"], row["top_province"], row["total_count"]) == ("366555.26", "0.1467", "UNKNOWN", "300")
    assert kpi.unexpired(cache, F.lit(datetime(2026, 10, 7, 17, 24, 59))).count() == 1
    assert kpi.unexpired(cache, F.lit(datetime(2026, 10, 7, 17, 25))).count() == 0


def test_histogram_of_equal_incomes_and_of_the_maximum(spark):
    same = spark.createDataFrame([(5.0,), (5.0,)], "taxable_income DOUBLE")
    row = analytics.income_histogram(same).first()
    assert (row["bucket_label"], row["count"], row["min_income"]) == ("k-k", 2, None)
    spread = spark.createDataFrame([(float(x),) for x in range(0, 20001, 1000)], "taxable_income DOUBLE")
    rows = analytics.income_histogram(spread).collect()
    assert len(rows) == 21 and rows[-1]["min_income"] == 20000 and rows[-1]["count"] == 1


def test_blocks_of_fifty(spark):
    df = spark.range(1, 101).select("id", (F.col("id") % 25 == 0).alias("is_fraud"))
    got = {r["block"]: (r["n"], r["fraud_count"]) for r in analytics.block_rate(df, F.col("id")).collect()}
    assert got == {0: (50, 2), 1: (50, 2)}


@pytest.mark.parametrize("values,want", [
    (("UNEMPLOYED", 150_000.0, "RETURNING", False), "phantom_income"), (("UNEMPLOYED", 149_999.0, "RETURNING", True), None),
    (("EMPLOYED", 1_625_000.0, "AMENDED", False), "income_inflation"), (("EMPLOYED", 975_000.0, "AMENDED", True), "serial_filer"),
    (("EMPLOYED", 975_000.0, "AMENDED", False), None), (("EMPLOYED", 5_000_000.0, "RETURNING", True), None),
])
def test_archetypes(spark, values, want):
    df = spark.createDataFrame([values], "employment_type STRING, taxable_income DOUBLE, filing_status STRING, r BOOLEAN")
    assert df.select(analytics.archetype(F.col("r"))).first()[0] == want


def test_routing(spark):
    df = spark.createDataFrame([("Is app-12x ok?",), ("What is the RISK here",), ("When is tax due",)], "text STRING")
    got = [(r["intent"], r["application_id"]) for r in analytics.route_questions(df).collect()]
    assert got == [("fraud_check", "APP-12X"), ("fraud_check", None), ("tax_question", None)]


def test_risk_band_and_readiness(spark):
    df = spark.createDataFrame([(0.75,), (0.45,), (0.4499,)], "fraud_probability DOUBLE")
    assert [r[0] for r in df.select(analytics.risk_band()).collect()] == ["HIGH", "MEDIUM", "LOW"]
    got = {r["table_name"]: r["status"] for r in analytics.readiness({"a": df, "b": df.limit(0)}).collect()}
    assert got == {"a": "PASS", "b": "WARN"}
