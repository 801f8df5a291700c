"""Rule-based fraud signals, their normal form and the domain checks of the serving tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.functions.text import event_time, iso_text, seconds_text, sql_text, trimmed

SPIKE_LIMIT = 500_000.0
MIN_FILINGS = 3
SIGNAL_COLUMNS = ["signal_id", "application_id", "customer_id", "signal_type", "severity", "detected_at", "description"]


def high_frequency_signals(filings: DataFrame, minutes: int = 10, min_filings: int = MIN_FILINGS) -> DataFrame:
    """A signal per customer and tumbling window with at least `min_filings` filings. Needs `event_time`."""
    counts = (
        filings.groupBy(F.window("event_time", f"{minutes} minutes").alias("w"), "customer_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_filings)
    )
    start = F.col("w.start")
    return counts.select(
        F.concat(F.lit("flink-hf-"), iso_text(start), F.lit("-"), F.col("customer_id")).alias("signal_id"),
        F.lit("MULTIPLE").alias("application_id"),
        F.col("customer_id"),
        F.lit("HIGH_FREQUENCY_SUBMISSIONS").alias("signal_type"),
        F.lit("HIGH").alias("severity"),
        iso_text(start).alias("detected_at"),
        F.concat(
            F.lit("Customer submitted "), F.col("n").cast("string"),
            F.lit(f" applications in {minutes}-min window starting "), sql_text(start),
        ).alias("description"),
    )


def income_spike_signals(filings: DataFrame, limit: float = SPIKE_LIMIT) -> DataFrame:
    return filings.where(F.col("taxable_income") > limit).select(
        F.concat(F.lit("flink-spike-"), trimmed("application_id")).alias("signal_id"),
        trimmed("application_id").alias("application_id"),
        trimmed("customer_id").alias("customer_id"),
        F.lit("INCOME_SPIKE").alias("signal_type"),
        F.lit("MEDIUM").alias("severity"),
        seconds_text("_produced_at").alias("detected_at"),
        F.concat(
            F.lit("Taxable income R"), F.col("taxable_income").try_cast("decimal(15,2)").cast("string"),
            F.lit(f" exceeds high-value threshold of R{limit:,.0f}"),
        ).alias("description"),
    )


def derived_signals(filings: DataFrame, minutes: int = 10, min_filings: int = MIN_FILINGS,
                    limit: float = SPIKE_LIMIT) -> DataFrame:
    return high_frequency_signals(filings, minutes, min_filings).unionByName(income_spike_signals(filings, limit))


def all_signals(*parts: DataFrame) -> DataFrame:
    """External and derived signals as one table."""
    return reduce(DataFrame.unionByName, [part.select(*SIGNAL_COLUMNS) for part in parts])


def severity_of(value: str = "severity") -> Column:
    """LOW, MEDIUM and CRITICAL stay; anything else, NULL included, is HIGH."""
    level = F.upper(trimmed(value))
    return F.when(level.isin("LOW", "MEDIUM", "CRITICAL"), level).otherwise(F.lit("HIGH"))


def detections(signals: DataFrame, source: str = "FLINK") -> DataFrame:
    """Signals in the form of the detections table; rows without signal or customer id are left out."""
    unknown = F.lit("UNKNOWN")
    return signals.where(F.col("signal_id").isNotNull() & F.col("customer_id").isNotNull()).select(
        trimmed("signal_id").alias("detection_id"),
        F.coalesce(trimmed("application_id"), unknown).alias("application_id"),
        F.coalesce(trimmed("customer_id"), unknown).alias("customer_id"),
        F.upper(F.coalesce(trimmed("signal_type"), unknown)).alias("signal_type"),
        severity_of().alias("severity"),
        F.lit(source).alias("source"),
        F.coalesce(trimmed("description"), F.lit("No description")).alias("description"),
        event_time(F.coalesce("detected_at", F.lit("2000-01-01T00:00:00"))).alias("detected_at"),
    )


# fixed values: the enumerations of the serving tables
DOMAINS = {
    "severity": ["LOW", "MEDIUM", "HIGH", "CRITICAL"],
    "source": ["PRODUCER", "FLINK", "AGENT", "MANUAL"],
    "outcome": ["SUCCESS", "FAILURE", "PENDING", "UNKNOWN"],
}


def domain_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column whose value is outside its enumeration (NULL is allowed), in one pass."""
    counts = df.agg(
        *[F.count_if(F.coalesce(~F.col(c).isin(*DOMAINS[c]), F.lit(False))).alias(c) for c in columns],
        F.count(F.lit(1)).alias("checked"),
    )
    return counts.unpivot(["checked"], columns, "column_name", "violations").select(
        "column_name", "checked", "violations"
    )
