"""Declared schemas. Streams and lakes are always read with one of these, never inferred."""

FILING = (
    "application_id STRING, customer_id STRING, customer_name STRING, email STRING, country STRING, "
    "province STRING, taxable_income DOUBLE, employment_type STRING, employment_status STRING, "
    "submitted_date STRING, tax_year STRING, filing_status STRING, is_fraud BOOLEAN, _produced_at STRING"
)

# what the window jobs read of a filing; the JSON parser skips the rest
WINDOW_FILING = (
    "application_id STRING, customer_id STRING, province STRING, taxable_income DOUBLE, employment_type STRING, "
    "is_fraud BOOLEAN, _produced_at STRING"
)

PROFILE = (
    "customer_id STRING, age INT, risk_score DOUBLE, historical_filings_count INT, "
    "avg_income_3yr DOUBLE, flagged_previously BOOLEAN, _produced_at STRING"
)

SIGNAL = (
    "signal_id STRING, application_id STRING, customer_id STRING, signal_type STRING, "
    "severity STRING, detected_at STRING, description STRING"
)

# metadata arrives as a JSON object whose fields depend on the action, so it stays text here
AUDIT = "event_id STRING, application_id STRING, actor STRING, action STRING, timestamp STRING, metadata STRING"

CLEANED = (
    "application_id STRING, customer_id STRING, customer_name STRING, email STRING, country STRING, "
    "province STRING, taxable_income DOUBLE, employment_type STRING, employment_status STRING, "
    "submitted_date STRING, tax_year STRING, filing_status STRING, is_fraud BOOLEAN, "
    "produced_at STRING, flink_processed_at STRING, dt STRING"
)

RUN_EVENT = (
    "event_type STRING, event_time TIMESTAMP, run_id STRING, namespace STRING, job_name STRING, "
    "inputs ARRAY<STRUCT<namespace: STRING, name: STRING, fields: ARRAY<STRUCT<name: STRING, type: STRING>>>>, "
    "outputs ARRAY<STRUCT<namespace: STRING, name: STRING, fields: ARRAY<STRUCT<name: STRING, type: STRING>>>>, "
    "error STRING"
)

FILING_COLUMNS = [part.strip().split(" ")[0] for part in FILING.split(",")]
CLEANED_COLUMNS = [part.strip().split(" ")[0] for part in CLEANED.split(",")]
