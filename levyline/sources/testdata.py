"""Filing tables derived from the driver's tables.

Each SQL text is valid in Spark and in ANSI engines alike; `{events}` and the like stand for the
input table. The texts add padding, mixed case, NULLs, negatives and short dates on purpose, so
that cleaning and the quality gate have work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.session import work_folder
from levyline.sources.streams import StreamSpec, end_of_topic, read_stream

FILINGS_SQL = """
SELECT concat('APP-', event_id) AS application_id,
       CASE WHEN event_id % 211 = 0 THEN NULL ELSE concat(' C', user_id, ' ') END AS customer_id,
       concat(' User ', user_id, ' ') AS customer_name,
       concat(' User', user_id, '@Example.ORG ') AS email,
       'South Africa ' AS country,
       CASE WHEN event_id % 97 = 0 THEN NULL
            WHEN event_id % 2 = 0 THEN 'Gauteng' WHEN event_id % 3 = 0 THEN ' limpopo '
            ELSE 'Western Cape' END AS province,
       CASE WHEN event_id % 401 = 0 THEN NULL
            WHEN event_id % 307 = 0 THEN -1.0 * value
            ELSE value * 2500 END AS taxable_income,
       CASE WHEN event_id % 20 = 0 THEN 'unemployed' WHEN event_id % 3 = 0 THEN 'EMPLOYED'
            WHEN event_id % 3 = 1 THEN 'Self_Employed' ELSE 'CONTRACTOR' END AS employment_type,
       CASE WHEN event_id % 20 = 0 THEN 'N/A' WHEN event_id % 2 = 0 THEN 'FULL_TIME'
            ELSE 'part_time' END AS employment_status,
       CASE WHEN event_id % 503 = 0 THEN '2024'
            ELSE concat(' ', substring(cast(ts AS string), 1, 10), ' ') END AS submitted_date,
       '2023/24' AS tax_year,
       CASE event_id % 3 WHEN 0 THEN 'FIRST_TIME' WHEN 1 THEN 'returning' ELSE 'AMENDED' END AS filing_status,
       (value > 150 OR event_id % 100 = 0) AS is_fraud,
       concat(replace(substring(cast(ts AS string), 1, 19), ' ', 'T'), '.539165+00:00') AS _produced_at
FROM {events} WHERE event_type <> 'view'
"""

PROFILES_SQL = """
SELECT concat('C', user_id) AS customer_id, cast(18 + user_id % 58 AS int) AS age,
       cast((user_id * 37) % 10000 AS double) / 10000 AS risk_score,
       cast(user_id % 16 AS int) AS historical_filings_count,
       cast(25000 + user_id * 1000 AS double) AS avg_income_3yr, (user_id % 12 = 0) AS flagged_previously,
       concat(replace(substring(cast(ts AS string), 1, 19), ' ', 'T'), '.000001+00:00') AS _produced_at
FROM {events} WHERE event_type = 'view'
"""

SIGNALS_SQL = """
SELECT CASE WHEN event_id % 89 = 0 THEN NULL ELSE concat('SIG-', event_id, ' ') END AS signal_id,
       concat('APP-', event_id) AS application_id, concat('C', user_id) AS customer_id,
       CASE event_id % 3 WHEN 0 THEN 'velocity_breach' WHEN 1 THEN 'PROFILE_MISMATCH' ELSE NULL END AS signal_type,
       CASE event_id % 6 WHEN 0 THEN 'low' WHEN 1 THEN ' Medium ' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'critical'
            WHEN 4 THEN 'weird' ELSE NULL END AS severity,
       CASE WHEN event_id % 71 = 0 THEN NULL
            ELSE replace(substring(cast(ts AS string), 1, 19), ' ', 'T') END AS detected_at,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE ' text ' END AS description
FROM {events} WHERE event_type = 'error'
"""

AUDIT_SQL = """
SELECT concat('AE-', event_id) AS event_id,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE concat(' APP-', event_id) END AS application_id,
       CASE WHEN event_id % 15 IN (0, 2, 11) THEN concat('C', user_id)
            WHEN event_id % 15 IN (3, 4, 8, 9, 10) THEN concat('AGENT-', user_id % 20) ELSE 'SYSTEM' END AS actor,
       CASE event_id % 15 WHEN 0 THEN 'APPLICATION_SUBMITTED' WHEN 1 THEN 'APPLICATION_RECEIVED'
            WHEN 2 THEN 'DOCUMENT_UPLOADED' WHEN 3 THEN 'REVIEW_STARTED' WHEN 4 THEN 'REVIEW_COMPLETED'
            WHEN 5 THEN 'FRAUD_CHECK_TRIGGERED' WHEN 6 THEN 'FRAUD_CHECK_CLEARED' WHEN 7 THEN 'MANUAL_REVIEW_ASSIGNED'
            WHEN 8 THEN 'APPLICATION_APPROVED' WHEN 9 THEN 'APPLICATION_REJECTED' WHEN 10 THEN 'AMENDMENT_REQUESTED'
            WHEN 11 THEN 'AMENDMENT_SUBMITTED' WHEN 12 THEN 'REFUND_ISSUED'
            WHEN 13 THEN 'SYSTEM_VALIDATION_PASSED' ELSE 'SYSTEM_VALIDATION_FAILED' END AS action,
       CASE WHEN event_id % 71 = 0 THEN 'soon'
            ELSE concat(replace(substring(cast(ts AS string), 1, 19), ' ', 'T'), '.000001+00:00') END AS timestamp,
       CASE WHEN event_id % 101 = 0 THEN '(broken'
            WHEN event_id % 15 = 0 THEN concat('{{"customer_id": "C', user_id, '", "channel": "WEB", "props": ', props, '}}')
            WHEN event_id % 15 = 5 THEN concat('{{"customer_id": "C', user_id, '", "trigger_reason": "income_anomaly"}}')
            WHEN event_id % 15 = 12 THEN concat('{{"customer_id": "C', user_id, '", "refund_amount": ', user_id, '.5}}')
            WHEN event_id % 15 >= 13 THEN concat('{{"customer_id": "C', user_id, '", "validation_rule": "tax_year_check"}}')
            ELSE concat('{{"customer_id": "C', user_id, '"}}') END AS metadata
FROM {events}
"""

# one run event per platform event: START, COMPLETE or FAIL of a job, keyed by user and kind
RUN_EVENTS_SQL = """
SELECT CASE event_id % 5 WHEN 0 THEN 'FAIL' WHEN 1 THEN 'START' WHEN 2 THEN 'START' ELSE 'COMPLETE' END AS event_type,
       ts AS event_time, event_id,
       concat('run-', event_id) AS run_id,
       CASE event_type WHEN 'view' THEN 'mlflow' WHEN 'error' THEN 'postgres' ELSE 'flink' END AS namespace,
       concat('job_', event_type, '_', user_id % 10) AS job_name,
       concat('topic-', event_type) AS input_a, concat('lake-', user_id % 4) AS input_b,
       concat('table-', user_id % 10) AS output_a,
       CASE WHEN event_id % 5 = 0 THEN concat('error ', event_id) ELSE '' END AS error
FROM {events}
"""

# documents as markdown files: every line after the first opens a section named by its first word
MARKDOWN_SQL = """
SELECT concat('doc-', doc_id, '.md') AS file,
       concat('# ', lang, chr(10), 'Authority:  ', source, ' ', chr(10),
              replace(replace(text, chr(13), ''), concat('.', chr(10)),
                      concat('.', chr(10), chr(10), '## Part ', lang, ' ', chr(10), chr(10), 'Source: ', source, chr(10),
                             CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat('Status:  checked', chr(10)) END))) AS text
FROM {documents}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FILINGS_SQL, events=table(spark, sf_dir, "events"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PROFILES_SQL, events=table(spark, sf_dir, "events"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SIGNALS_SQL, events=table(spark, sf_dir, "events"))


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(AUDIT_SQL, events=table(spark, sf_dir, "events"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested lineage run events."""
    flat = spark.sql(RUN_EVENTS_SQL, events=table(spark, sf_dir, "events"))
    no_fields = "CAST(array() AS ARRAY<STRUCT<name: STRING, type: STRING>>)"
    return flat.selectExpr(
        "event_type", "CAST(event_time AS TIMESTAMP) AS event_time", "run_id", "namespace", "job_name",
        f"array(named_struct('namespace', 'kafka', 'name', input_a, 'fields', {no_fields}), "
        f"named_struct('namespace', 'minio', 'name', input_b, 'fields', {no_fields})) AS inputs",
        f"array(named_struct('namespace', 'postgres', 'name', output_a, 'fields', {no_fields})) AS outputs",
        "error",
    )


def markdown_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MARKDOWN_SQL, documents=table(spark, sf_dir, "documents"))


PARTS = 4  # micro-batches of the event stream


def stream_of(spark: SparkSession, sf_dir: str, sql: str, closed: bool = False) -> DataFrame:
    """A stream of JSON texts in a `value` column, as a broker would deliver them: one micro-batch per span of time.

    `closed` adds the end-of-topic message, with which windows and outer joins give out what is still open.
    """
    events = table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    width = max(1, (last or 0) - (first or 0) + 1)
    part = F.floor((at - F.lit(first or 0)) * PARTS / width)
    numbered = events.withColumn("_part", F.coalesce(part, F.lit(0)))
    folder, files = work_folder(spark, "topic"), max(2, spark.sparkContext.defaultParallelism // 2)
    for number in range(PARTS):  # one after the other: a file stream reads in order of write time
        rows = spark.sql(sql, events=numbered.where(F.col("_part") == number).drop("_part"))
        rows.selectExpr("to_json(struct(*)) AS value").repartition(files).write.text(f"{folder}/part-{number}")
    if closed:
        spark.createDataFrame([(end_of_topic(),)], "value STRING").write.text(f"{folder}/part-{PARTS}")
    return read_stream(spark, StreamSpec("part-*", folder, "text", options={"maxFilesPerTrigger": str(files)}))
