"""Cleaning, the quality gate and typed projections of filings. Stateless: batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.functions.text import seconds_text, trimmed, upper_trimmed

UPPER_COLUMNS = ["country", "province", "employment_type", "employment_status", "filing_status"]


def submitted_day(column: str = "submitted_date") -> Column:
    return F.substring(trimmed(column), 1, 10)


def clean_applications(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Trimmed ids and names, lower-case mail, upper-case categories, day slice and partition column."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return df.select(
        trimmed("application_id").alias("application_id"),
        trimmed("customer_id").alias("customer_id"),
        trimmed("customer_name").alias("customer_name"),
        F.lower(trimmed("email")).alias("email"),
        upper_trimmed("country").alias("country"),
        upper_trimmed("province").alias("province"),
        F.col("taxable_income"),
        upper_trimmed("employment_type").alias("employment_type"),
        upper_trimmed("employment_status").alias("employment_status"),
        submitted_day().alias("submitted_date"),
        trimmed("tax_year").alias("tax_year"),
        upper_trimmed("filing_status").alias("filing_status"),
        F.col("is_fraud"),
        seconds_text("_produced_at").alias("produced_at"),
        stamp.cast("string").alias("flink_processed_at"),
        submitted_day().alias("dt"),
    )


def reject_reason() -> Column:
    """First rule of the gate a raw filing breaks, NULL when it passes."""
    day = F.char_length(trimmed("submitted_date"))
    return (
        F.when(F.col("application_id").isNull(), "missing_application_id")
        .when(F.col("customer_id").isNull(), "missing_customer_id")
        .when(F.col("taxable_income").isNull(), "missing_income")
        .when(F.col("taxable_income") < 0, "negative_income")
        .when(day.isNull() | (day < 10), "short_date")
    )


def gate(df: DataFrame) -> DataFrame:
    return df.where(
        F.col("application_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("taxable_income") >= 0)
        & (F.char_length(trimmed("submitted_date")) >= 10)
    )


def gate_rejects(df: DataFrame) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason()).where(F.col("reject_reason").isNotNull())


def cleaned(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Gate, then clean: what the cleaned lake holds."""
    return clean_applications(gate(df), processed_at)


def raw_archive(df: DataFrame) -> DataFrame:
    """Every row unchanged plus its partition: the first ten characters as they came, not trimmed."""
    return df.withColumn("dt", F.substring("submitted_date", 1, 10))


TYPED_TEXT = {
    "application_id": trimmed, "customer_id": trimmed, "customer_name": trimmed,
    "email": lambda c: F.lower(trimmed(c)), "country": upper_trimmed, "province": upper_trimmed,
}


def typed_filing() -> list[Column]:
    """The filing part of an enriched row. Casts that fail give NULL instead of stopping the job."""
    return [
        *[fix(name).alias(name) for name, fix in TYPED_TEXT.items()],
        F.col("taxable_income").try_cast("decimal(15,2)").alias("taxable_income"),
        upper_trimmed("employment_type").alias("employment_type"),
        upper_trimmed("employment_status").alias("employment_status"),
        submitted_day().try_cast("date").alias("submitted_date"),
        trimmed("tax_year").alias("tax_year"),
        upper_trimmed("filing_status").alias("filing_status"),
        F.col("is_fraud"),
    ]


def typed_profile(prefix: str = "") -> list[Column]:
    """The profile part of an enriched row, defaults filled where no profile matched."""
    def filled(name, default, kind):
        return F.coalesce(F.col(prefix + name), F.lit(default)).try_cast(kind).alias(name)

    return [
        filled("age", 0, "int"),
        filled("risk_score", 0.0, "decimal(5,4)"),
        filled("historical_filings_count", 0, "int"),
        filled("avg_income_3yr", 0.0, "decimal(15,2)"),
        filled("flagged_previously", False, "boolean"),
    ]
