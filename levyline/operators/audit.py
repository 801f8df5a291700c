"""Audit events as an audit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.functions.text import event_time, trimmed

# fixed values: who performs an action
ACTORS = {
    "TAXPAYER": ["APPLICATION_SUBMITTED", "DOCUMENT_UPLOADED", "AMENDMENT_SUBMITTED"],
    "AGENT": [
        "REVIEW_STARTED", "REVIEW_COMPLETED", "APPLICATION_APPROVED", "APPLICATION_REJECTED", "AMENDMENT_REQUESTED",
    ],
    "SYSTEM": [
        "APPLICATION_RECEIVED", "FRAUD_CHECK_TRIGGERED", "FRAUD_CHECK_CLEARED", "MANUAL_REVIEW_ASSIGNED",
        "REFUND_ISSUED", "SYSTEM_VALIDATION_PASSED", "SYSTEM_VALIDATION_FAILED",
    ],
}

METADATA_FIELDS = {
    "customer_id": "string", "channel": "string", "trigger_reason": "string",
    "refund_amount": "double", "validation_rule": "string",
}


def audit_log(events: DataFrame) -> DataFrame:
    """Typed audit rows; metadata becomes a VARIANT, NULL when it is no JSON."""
    outcome = F.upper(trimmed("outcome")) if "outcome" in events.columns else F.lit(None).cast("string")
    return events.where(F.col("event_id").isNotNull()).select(
        trimmed("event_id").alias("event_id"),
        trimmed("application_id").alias("application_id"),
        F.col("actor"),
        F.col("action"),
        event_time("timestamp").alias("event_timestamp"),
        outcome.alias("outcome"),
        F.try_parse_json("metadata").alias("metadata"),
    )


def actor_type(action: str = "action") -> Column:
    pairs = [F.lit(x) for kind, actions in ACTORS.items() for a in actions for x in (a, kind)]
    return F.create_map(*pairs)[F.col(action)]


def actor_counts(log: DataFrame) -> DataFrame:
    return log.groupBy(actor_type().alias("actor_type"), "action").agg(F.count(F.lit(1)).alias("n"))


def metadata_fields(log: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """The known metadata fields as columns; NULL where an action does not carry the field."""
    wanted = METADATA_FIELDS if fields is None else fields
    return log.select(
        "event_id", "action",
        *[F.try_variant_get("metadata", f"$.{name}", kind).alias(name) for name, kind in wanted.items()],
    )
