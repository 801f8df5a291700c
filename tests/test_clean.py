from decimal import Decimal

from conftest import filing, frame
from pyspark.sql import functions as F

from levyline.operators import clean
from levyline.schemas import CLEANED_COLUMNS, FILING


def test_clean_row(spark):
    df = frame(spark, [filing(" A1 ", " C1 ", submitted_date=" 2026-10-01T10:00 ")], FILING)
    row = clean.cleaned(df, F.lit("now")).first()
    assert row.asDict() == {
        "application_id": "A1", "customer_id": "C1", "customer_name": "Ann", "email": "ann@x.org",
        "country": "SOUTH AFRICA", "province": "GAUTENG", "taxable_income": 100.0, "employment_type": "EMPLOYED",
        "employment_status": "FULL_TIME", "submitted_date": "2026-10-01", "tax_year": "2025", "filing_status": "AMENDED",
        "is_fraud": False, "produced_at": "2026-10-01 13:32:07", "flink_processed_at": "now", "dt": "2026-10-01",
    }
    assert clean.cleaned(df).columns == CLEANED_COLUMNS


def test_gate_and_rejects_split_the_input(spark):
    rows = [
        filing("ok"), filing(None), filing("b", None), filing("c", taxable_income=None), filing("d", taxable_income=-0.01),
        filing("e", submitted_date=" 2026 "), filing("f", submitted_date=None), filing("zero", taxable_income=0.0),
    ]
    df = frame(spark, rows, FILING)
    assert {r["application_id"] for r in clean.gate(df).collect()} == {"ok", "zero"}
    reasons = {r["application_id"]: r["reject_reason"] for r in clean.gate_rejects(df).collect()}
    assert reasons == {
        None: "missing_application_id", "b": "missing_customer_id", "c": "missing_income",
        "d": "negative_income", "e": "short_date", "f": "short_date",
    }


def test_raw_archive_does_not_trim(spark):
    df = frame(spark, [filing(submitted_date=" 2026-10-01 ")], FILING)
    assert clean.raw_archive(df).first()["dt"] == " 2026-10-0"


def test_typed_filing_never_throws(spark):
    df = frame(spark, [filing(taxable_income=1e20, submitted_date="x"), filing(taxable_income=1.005)], FILING)
    rows = df.select(*clean.typed_filing()).collect()
    assert rows[0]["taxable_income"] is None and rows[0]["submitted_date"] is None
    assert rows[1]["taxable_income"] == Decimal("1.01")
