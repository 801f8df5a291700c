"""Windowed KPIs, the serving cache rows made from them and their expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.functions.money import CENTS, exact_mean, fraud_rows, money_mean
from levyline.functions.text import iso_text

KPI_TTL, ALERT_TTL, SESSION_TTL = 900, 1800, 3600
LOOKBACK = 20


def kpi_windows(filings: DataFrame, width: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Count, mean income, distinct customers, fraud count and rate, highest province per window.

    Three chained aggregates, by window, customer and province, by window and customer, and by window: exact
    distinct customers that also run as a stream, and no task sees more than the partial rows of its
    windows. The first, over all filings, only adds numbers up, so it needs no sort; the highest text is taken
    over what is left. The sum and the count of incomes travel upward, so the mean is that of all rows.
    Needs `event_time`.
    `top_province` is the alphabetically highest one.
    """
    income = F.col("taxable_income").try_cast(CENTS)
    window = F.window("event_time", width, slide) if slide else F.window("event_time", width)
    per_place = filings.groupBy(window.alias("w"), "customer_id", "province").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(income).alias("income_sum"),
        F.count(income).alias("income_n"),
        fraud_rows().alias("fraud_n"),
    )
    per_customer = per_place.groupBy("w", "customer_id").agg(
        *[F.sum(c).alias(c) for c in ("n", "income_sum", "income_n", "fraud_n")],
        F.max("province").alias("province"),
    )
    per_window = per_customer.groupBy("w").agg(
        F.sum("n").alias("total_count"),
        F.sum("income_sum").alias("income_sum"),
        F.sum("income_n").alias("income_n"),
        F.count("customer_id").alias("distinct_customers"),
        F.sum("fraud_n").alias("fraud_count"),
        F.max("province").alias("top_province"),
    )
    return per_window.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "total_count",
        exact_mean("income_sum", "income_n").alias("avg_income"),
        "distinct_customers",
        "fraud_count",
        F.try_divide(F.col("fraud_count").cast("double"), F.col("total_count").cast("double")).alias("fraud_rate"),
        "top_province",
    )


def kpi_windows_early(filings: DataFrame, width: str = "5 minutes", error: float = 0.01) -> DataFrame:
    """KPIs from a single aggregate, with an estimate of the distinct customers.

    Runs in update mode, so that open windows reach an upsert table before the watermark passes
    them, which it never does while a source is silent.
    """
    per_window = filings.groupBy(F.window("event_time", width).alias("w")).agg(
        F.count(F.lit(1)).alias("total_count"),
        money_mean("taxable_income").alias("avg_income"),
        F.approx_count_distinct("customer_id", error).alias("approx_customers"),
        fraud_rows().alias("fraud_count"),
        F.max("province").alias("top_province"),
    )
    return per_window.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total_count", "avg_income",
        "approx_customers", "fraud_count",
        F.try_divide(F.col("fraud_count").cast("double"), F.col("total_count").cast("double")).alias("fraud_rate"),
        "top_province",
    )


def busiest_province(filings: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Most frequent province per window, ties to the alphabetically first. `top_province` is not that."""
    counts = filings.where(F.col("province").isNotNull()).groupBy(
        F.window("event_time", width).alias("w"), "province"
    ).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(F.col("w.start").alias("window_start")).agg(
        F.min_by("province", F.struct(-F.col("n"), F.col("province"))).alias("busiest_province")
    )


def newest_windows(kpis: DataFrame, n: int = LOOKBACK) -> DataFrame:
    return kpis.orderBy(F.desc("window_start")).limit(n)


def latest_kpi(kpis: DataFrame) -> DataFrame:
    return newest_windows(kpis, 1)


def last_windows_ascending(kpis: DataFrame, n: int = 12, key: str = "window_start") -> DataFrame:
    return kpis.orderBy(F.desc(key)).limit(n).orderBy(F.asc(key))


def _fixed(value: str, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", F.coalesce(F.col(value).cast("double"), F.lit(0.0)))


def _whole(value: str) -> Column:
    return F.coalesce(F.col(value), F.lit(0)).cast("string")


def _expiry(now: Column | None, ttl: int) -> Column:
    start = F.current_timestamp() if now is None else now
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl).cast("decimal(18,6)"))


def kpi_cache_rows(windows: DataFrame, now: Column | None = None, ttl: int = KPI_TTL) -> DataFrame:
    """One row of texts per window, as the key-value cache would hold it."""
    return windows.select(
        F.concat(F.lit("tax:kpi:window:"), iso_text("window_start")).alias("cache_key"),
        iso_text("window_start").alias("window_start"),
        iso_text("window_end").alias("window_end"),
        _whole("total_count").alias("total_count"),
        _fixed("avg_income", 2).alias("avg_income"),
        _whole("distinct_customers").alias("distinct_customers"),
        _whole("fraud_count").alias("fraud_count"),
        _fixed("fraud_rate", 4).alias("fraud_rate"),
        F.coalesce("top_province", F.lit("UNKNOWN")).alias("top_province"),
        _expiry(now, ttl).alias("expires_at"),
    )


def kpi_summary_row(windows: DataFrame, now: Column | None = None, ttl: int = KPI_TTL) -> DataFrame:
    """The newest window alone, under its own key."""
    stamp = F.current_timestamp() if now is None else now
    return latest_kpi(windows).select(
        F.lit("tax:kpi:latest").alias("cache_key"),
        iso_text("window_start").alias("window_start"),
        _whole("total_count").alias("total_count"),
        _fixed("avg_income", 2).alias("avg_income"),
        _fixed("fraud_rate", 4).alias("fraud_rate"),
        F.coalesce("top_province", F.lit("UNKNOWN")).alias("top_province"),
        stamp.alias("updated_at"),
        _expiry(now, ttl).alias("expires_at"),
    )


def unexpired(cache: DataFrame, now: Column | None = None) -> DataFrame:
    return cache.where(F.col("expires_at") > (F.current_timestamp() if now is None else now))


def alert_flags(scored: DataFrame, ttl: int = ALERT_TTL, now: Column | None = None) -> DataFrame:
    """Newest HIGH-risk score per customer as an alert row. Needs customer_id, risk, scored_at."""
    return (
        scored.where((F.col("risk") == "HIGH") & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.max("scored_at").alias("scored_at"))
        .select(
            F.concat(F.lit("tax:fraud:alert:"), F.col("customer_id")).alias("cache_key"),
            F.lit("HIGH").alias("value"),
            "scored_at",
            _expiry(F.col("scored_at") if now is None else now, ttl).alias("expires_at"),
        )
    )
