from datetime import timedelta
from decimal import Decimal

from conftest import filing, frame

from levyline.operators import enrich
from levyline.schemas import FILING, PROFILE, SIGNAL
from levyline.sources.streams import with_event_time


def profile(customer="C1", at="2026-10-01T13:00:00", **values):
    row = {"customer_id": customer, "age": 40, "risk_score": 0.12345, "historical_filings_count": 2,
           "avg_income_3yr": 50.005, "flagged_previously": True, "_produced_at": at}
    row.update(values)
    return row


def both(spark, filings, profiles):
    return with_event_time(frame(spark, filings, FILING)), with_event_time(frame(spark, profiles, PROFILE))


def test_interval_keeps_every_match_and_fills_defaults(spark):
    a, p = both(spark, [filing("A1", " C1 "), filing("A2", "C9"), filing("A3", None)],
                [profile(), profile(at="2026-10-01T14:32:07", age=41), profile(at="2026-10-01T14:32:08", age=42)])
    rows = enrich.enrich_interval(a, p).collect()
    assert sorted((r["application_id"], r["age"]) for r in rows) == [("A1", 40), ("A1", 41), ("A2", 0), ("A3", 0)]
    hit = next(r for r in rows if r["age"] == 40)
    assert hit["risk_score"] == Decimal("0.1235") and hit["avg_income_3yr"] == Decimal("50.01") and hit["flagged_previously"]
    miss = next(r for r in rows if r["application_id"] == "A2")
    assert (miss["risk_score"], miss["historical_filings_count"], miss["flagged_previously"]) == (Decimal("0.0000"), 0, False)


def test_raw_keys_do_not_match_padded_ids(spark):
    a, p = both(spark, [filing("A1", " C1 ")], [profile()])
    assert enrich.enrich_interval(a, p, trim_keys=False).first()["age"] == 0


def test_once_takes_the_closest_and_asof_the_newest_before(spark):
    a, p = both(spark, [filing("A1")], [profile(at="2026-09-01T00:00:00", age=1), profile(at="2026-10-01T13:31:00", age=2),
                                        profile(at="2026-10-01T13:32:30", age=3)])
    assert enrich.enrich_once(a, p).first()["age"] == 3
    assert enrich.enrich_asof(a, p).first()["age"] == 2


def test_income_above_history_needs_a_history(spark):
    a, p = both(spark, [filing("A1", taxable_income=200.0), filing("A2", "C9", taxable_income=200.0)], [profile()])
    assert [r["application_id"] for r in enrich.income_above_history(enrich.enrich_once(a, p)).collect()] == ["A1"]


def test_label_within_a_day(spark):
    a = with_event_time(frame(spark, [filing("A1"), filing("A2", "C2"), filing("A3", "C3")], FILING))
    s = with_event_time(frame(spark, [
        {"signal_id": "s1", "customer_id": "C1", "detected_at": "2026-10-02T13:32:07"},
        {"signal_id": "s2", "customer_id": "C2", "detected_at": "2026-10-02T13:32:08"},
    ], SIGNAL), stamp="detected_at")
    got = {r["application_id"]: r["label"] for r in enrich.label_by_signals(a, s).collect()}
    assert got == {"A1": 1, "A2": 0, "A3": 0}
    assert timedelta(seconds=enrich.HOUR) == timedelta(hours=1)
