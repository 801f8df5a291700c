"""Filings enriched with taxpayer profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.functions.text import trimmed
from levyline.operators.clean import typed_filing, typed_profile
from levyline.operators.timejoin import asof_left_join, interval_left_join, nearest_left_join
from levyline.streaming.lookup import timed_lookup

HOUR = 3600
PROFILE_VALUES = ["age", "risk_score", "historical_filings_count", "avg_income_3yr", "flagged_previously"]


def _sides(filings: DataFrame, profiles: DataFrame, trim_keys: bool) -> tuple[DataFrame, DataFrame]:
    """Filings with `event_time`, profiles renamed to p_*; ids trimmed unless the caller wants them raw."""
    fix = trimmed if trim_keys else F.col
    right = profiles.select(
        fix("customer_id").alias("p_customer_id"),
        F.col("event_time").alias("p_event_time"),
        *[F.col(name).alias(f"p_{name}") for name in PROFILE_VALUES],
    )
    left = filings.withColumn("_customer", fix("customer_id"))
    return left, right


def _enriched(joined: DataFrame, processed_at: Column | None) -> DataFrame:
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return joined.select(*typed_filing(), *typed_profile("p_"), stamp.alias("processed_at"))


def enrich_interval(
    filings: DataFrame, profiles: DataFrame, before_seconds: int = HOUR, after_seconds: int = HOUR,
    processed_at: Column | None = None, trim_keys: bool = True,
) -> DataFrame:
    """One row per filing and profile of the same customer within the interval; unmatched filings kept.

    Both inputs need `event_time`; on streams both need a watermark on it.
    """
    left, right = _sides(filings, profiles, trim_keys)
    joined = interval_left_join(
        left, right, "_customer", "p_customer_id", "event_time", "p_event_time",
        before_seconds, after_seconds, "application_id",
    )
    return _enriched(joined, processed_at)


def enrich_once(
    filings: DataFrame, profiles: DataFrame, before_seconds: int = HOUR, after_seconds: int = HOUR,
    processed_at: Column | None = None, trim_keys: bool = True,
) -> DataFrame:
    """Each filing once, with the profile closest in time within the interval."""
    left, right = _sides(filings, profiles, trim_keys)
    joined = nearest_left_join(
        left, right.withColumnRenamed("p_customer_id", "_customer"), "_customer", "event_time", "p_event_time",
        before_seconds, after_seconds,
    )
    return _enriched(joined.withColumns({f"p_{n}": F.col(f"found.p_{n}") for n in PROFILE_VALUES}), processed_at)


def enrich_asof(
    filings: DataFrame, profiles: DataFrame, processed_at: Column | None = None, trim_keys: bool = True,
) -> DataFrame:
    """Each filing once, with the newest profile at or before it, however old."""
    left, right = _sides(filings, profiles, trim_keys)
    joined = asof_left_join(
        left, right.withColumnRenamed("p_customer_id", "_customer"), "_customer", "event_time", "p_event_time",
    )
    return _enriched(joined.withColumns({f"p_{n}": F.col(f"found.p_{n}") for n in PROFILE_VALUES}), processed_at)


def enrich_once_stream(
    filings: DataFrame, profiles: DataFrame, before_seconds: int = HOUR, after_seconds: int = HOUR,
    processed_at: Column | None = None, trim_keys: bool = True, spread: int = 1,
) -> DataFrame:
    """`enrich_once` of two streams: a filing leaves when no closer profile can come any more."""
    return _looked_up(filings, profiles, before_seconds, after_seconds, processed_at, trim_keys, spread)


def enrich_asof_stream(
    filings: DataFrame, profiles: DataFrame, processed_at: Column | None = None, trim_keys: bool = True, spread: int = 1,
) -> DataFrame:
    """`enrich_asof` of two streams: a filing leaves when no newer profile before it can come any more."""
    return _looked_up(filings, profiles, None, 0, processed_at, trim_keys, spread)


def _looked_up(filings, profiles, before_seconds, after_seconds, processed_at, trim_keys, spread) -> DataFrame:
    left, right = _sides(filings, profiles, trim_keys)
    joined = timed_lookup(
        left, right.withColumnRenamed("p_customer_id", "_customer"), "_customer", "event_time", "p_event_time", "application_id",
        before_seconds, after_seconds, spread=spread,
    )
    return _enriched(joined.withColumns({f"p_{n}": F.col(f"found.p_{n}") for n in PROFILE_VALUES}), processed_at)


def income_above_history(enriched: DataFrame, factor: float = 3.0) -> DataFrame:
    """Filings whose income exceeds `factor` times the known three-year average."""
    return enriched.where(
        (F.col("avg_income_3yr") > 0) & (F.col("taxable_income") > F.col("avg_income_3yr") * F.lit(factor))
    )


def label_by_signals(filings: DataFrame, signals: DataFrame, within_seconds: int = 24 * HOUR) -> DataFrame:
    """Adds `label`: 1 when the customer has a signal within the interval around the filing.

    The nearest signal decides, so no filing-signal pairs are formed.
    """
    left = filings.withColumn("_customer", trimmed("customer_id"))
    right = signals.select(trimmed("customer_id").alias("_customer"), F.col("event_time").alias("s_event_time"))
    joined = nearest_left_join(left, right, "_customer", "event_time", "s_event_time", within_seconds, within_seconds)
    return joined.withColumn("label", F.col("found").isNotNull().cast("int")).drop("found", "_customer")
