"""The filing jobs as plans: decoded JSON messages in, frame to write out. Batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from levyline.operators import audit, clean, enrich, kpi, signals
from levyline.schemas import AUDIT, FILING, PROFILE, SIGNAL, WINDOW_FILING
from levyline.sources.streams import accepted, decode_json, with_event_time


def filings_from(messages: DataFrame, schema: str = FILING, delay: str | None = "30 seconds") -> DataFrame:
    """Filings of a topic with event time and, on a stream, watermark."""
    return with_event_time(accepted(decode_json(messages, schema)), delay)


def raw_archive(messages: DataFrame) -> DataFrame:
    return clean.raw_archive(accepted(decode_json(messages, FILING)))


def cleaned_lake(messages: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return clean.cleaned(accepted(decode_json(messages, FILING)), processed_at)


def enriched_filings(filing_messages: DataFrame, profile_messages: DataFrame, processed_at: Column | None = None,
                     trim_keys: bool = True) -> DataFrame:
    profiles = with_event_time(accepted(decode_json(profile_messages, PROFILE)))
    return enrich.enrich_interval(filings_from(filing_messages), profiles, processed_at=processed_at, trim_keys=trim_keys)


def once_enriched_filings(filing_messages: DataFrame, profile_messages: DataFrame, processed_at: Column | None = None,
                          spread: int = 1) -> DataFrame:
    """Streams only: one row per filing, with the profile closest in time within the hour around it."""
    profiles = with_event_time(accepted(decode_json(profile_messages, PROFILE)))
    return enrich.enrich_once_stream(filings_from(filing_messages), profiles, processed_at=processed_at, spread=spread)


def asof_enriched_filings(filing_messages: DataFrame, profile_messages: DataFrame, processed_at: Column | None = None,
                          spread: int = 1) -> DataFrame:
    """Streams only: one row per filing, with the newest profile at or before it."""
    profiles = with_event_time(accepted(decode_json(profile_messages, PROFILE)))
    return enrich.enrich_asof_stream(filings_from(filing_messages), profiles, processed_at=processed_at, spread=spread)


def kpi_windows(messages: DataFrame, width: str = "5 minutes") -> DataFrame:
    return kpi.kpi_windows(filings_from(messages, WINDOW_FILING), width)


def fraud_patterns(messages: DataFrame, minutes: int = 10, min_filings: int = signals.MIN_FILINGS,
                   limit: float = signals.SPIKE_LIMIT) -> DataFrame:
    return signals.derived_signals(filings_from(messages, WINDOW_FILING), minutes, min_filings, limit)


def detections(messages: DataFrame, source: str = "FLINK") -> DataFrame:
    return signals.detections(accepted(decode_json(messages, SIGNAL)), source)


def audit_log(messages: DataFrame) -> DataFrame:
    return audit.audit_log(accepted(decode_json(messages, AUDIT)))
