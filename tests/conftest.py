import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from levyline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


def filing(app="A1", customer="C1", **values):
    row = {
        "application_id": app, "customer_id": customer, "customer_name": " Ann ", "email": " Ann@X.org ",
        "country": "South Africa", "province": " gauteng ", "taxable_income": 100.0, "employment_type": "employed",
        "employment_status": "full_time", "submitted_date": "2026-10-01", "tax_year": "2025", "filing_status": "amended",
        "is_fraud": False, "_produced_at": "2026-10-01T13:32:07.539165+00:00",
    }
    row.update(values)
    return row


def frame(spark, rows, schema):
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
