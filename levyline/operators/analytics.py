"""Analytic reports over the cleaned lake and the serving tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.functions.money import CENTS, exact_mean, fraud_rows, money_mean, money_sum, ratio_rounded
from levyline.functions.text import stripped
from levyline.operators.skew import latest_per_key, salted_lookup


def _rate(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def kpi_trend(cleaned: DataFrame, n_windows: int = 24, stamp: str = "processed_at", width: str = "5 minutes") -> DataFrame:
    """Newest n processing-time windows with count, mean income, fraud count and rate."""
    return (
        cleaned.where(F.col(stamp).isNotNull())
        .groupBy(F.window(stamp, width)["start"].alias("window_start"))
        .agg(
            F.count(F.lit(1)).alias("total_count"),
            money_mean("taxable_income").alias("avg_income"),
            fraud_rows().alias("fraud_count"),
        )
        .withColumn("fraud_rate", _rate("fraud_count", "total_count"))
        .orderBy(F.desc("window_start"))
        .limit(n_windows)
    )


def income_severity(limit: float = 500_000.0) -> Column:
    return (
        F.when(F.col("is_fraud") & (F.col("taxable_income") > limit), "HIGH")
        .when(F.col("is_fraud"), "MEDIUM")
        .otherwise("LOW")
    )


def _fraud_groups(cleaned: DataFrame, extra: list[Column], limit: float) -> DataFrame:
    return (
        cleaned.where(F.col("is_fraud"))
        .groupBy(*extra, F.col("employment_type").alias("signal_type"), income_severity(limit).alias("severity"), "province")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def fraud_summary(cleaned: DataFrame, top: int = 200, limit: float = 500_000.0) -> DataFrame:
    return (
        _fraud_groups(cleaned, [], limit)
        .orderBy(F.desc("count"), "signal_type", "severity", F.asc_nulls_last("province"))
        .limit(top)
    )


def fraud_summary_by_time(cleaned: DataFrame, width: str = "1 day", stamp: str = "processed_at",
                          limit: float = 500_000.0) -> DataFrame:
    return _fraud_groups(cleaned, [F.window(stamp, width)["start"].alias("window_start")], limit)


def income_histogram(cleaned: DataFrame, n_buckets: int = 20) -> DataFrame:
    """Equal-width histogram between the lowest and highest income.

    The highest income falls in a bucket of its own past the last one. The label divides only the
    offset, not the lower bound, by 1000. When all incomes are equal there is one bucket without bounds.
    """
    incomes = cleaned.where(F.col("taxable_income").isNotNull() & (F.col("taxable_income") >= 0)).select("taxable_income")
    # the bounds are one row: a scalar subquery, run once, instead of a join
    bounds = incomes.agg(F.struct(F.min("taxable_income").alias("mn"), F.max("taxable_income").alias("mx")).alias("b"))
    span = F.col("b.mx") - F.col("b.mn")
    counted = (
        incomes.withColumn("b", bounds.scalar())
        .select(
            "b",
            F.floor(F.try_divide(F.col("taxable_income") - F.col("b.mn"), F.nullif(span, F.lit(0.0))) * n_buckets)
            .cast("double").alias("idx"),
        )
        .groupBy("idx", "b")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    mn, wide = F.col("b.mn"), F.col("b.mx") - F.col("b.mn")

    def edge(i, scale=None):
        offset = i * wide / n_buckets
        return F.round(mn + (offset / scale if scale else offset)).cast("long")

    def label(i):
        return F.coalesce(edge(i, 1000).cast("string"), F.lit(""))

    return counted.select(
        edge(F.col("idx")).alias("min_income"),
        edge(F.col("idx") + 1).alias("max_income"),
        F.concat(label(F.col("idx")), F.lit("k-"), label(F.col("idx") + 1), F.lit("k")).alias("bucket_label"),
        "count",
        F.col("idx").cast("long").alias("bucket"),
    ).orderBy("bucket").drop("bucket")


def top_flagged_customers(cleaned: DataFrame, top_n: int = 10) -> DataFrame:
    """Customers with most fraud rows, their mean income and the provinces they filed from.

    The provinces are looked up for the top customers only.
    """
    flagged = cleaned.where(F.col("is_fraud"))
    top = (
        flagged.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("fraud_count"),
            money_sum("taxable_income").alias("s"),
            F.count(F.col("taxable_income").try_cast(CENTS)).alias("n"),
        )
        .orderBy(F.desc("fraud_count"), F.asc_nulls_last("customer_id"))
        .limit(top_n)
        .select("customer_id", "fraud_count", ratio_rounded("s", "n", 2).alias("avg_income"))
    )
    names = (
        flagged.join(F.broadcast(top.select("customer_id")), "customer_id", "left_semi")
        .where(F.col("province").isNotNull())
        .select("customer_id", "province").distinct()
        .groupBy("customer_id")
        .agg(F.array_join(F.array_sort(F.collect_list("province")), ", ").alias("provinces"))
    )
    return top.join(names, "customer_id", "left").orderBy(F.desc("fraud_count"), "customer_id")


def province_heatmap(cleaned: DataFrame) -> DataFrame:
    return (
        cleaned.groupBy("province")
        .agg(
            F.count(F.lit(1)).alias("total_applications"),
            fraud_rows().alias("fraud_count"),
            money_sum("taxable_income").alias("s"),
            F.count(F.col("taxable_income").try_cast(CENTS)).alias("n"),
        )
        .select(
            F.coalesce("province", F.lit("UNKNOWN")).alias("province"),
            "total_applications",
            "fraud_count",
            ratio_rounded("fraud_count", "total_applications", 4).alias("fraud_rate"),
            ratio_rounded("s", "n", 2).alias("avg_income"),
        )
        .orderBy(F.desc("fraud_count"), "province")
    )


def top_provinces_ascending(heatmap: DataFrame, n: int = 9) -> DataFrame:
    return (
        heatmap.orderBy(F.desc("fraud_count"), "province").limit(n)
        .orderBy(F.asc("fraud_count"), F.desc("province"))
    )


def fraud_summary_by_province(detections: DataFrame, enriched: DataFrame) -> DataFrame:
    """Detections joined to enriched filings on the application, summed by province.

    `enriched` has one row per application. Derived detections share the application id MULTIPLE,
    so the left key can be hot: the lookup salts it.
    """
    places = enriched.select("application_id", "province")
    joined = salted_lookup(detections, places, "application_id", F.col("detection_id"))
    probability = F.col("fraud_probability") if "fraud_probability" in detections.columns else F.lit(None).cast("double")
    return joined.groupBy("province").agg(
        F.count_distinct("detection_id").alias("total_signals"),
        F.count_distinct("customer_id").alias("flagged_customers"),
        F.count_if(F.col("severity") == "HIGH").alias("high_count"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_count"),
        F.avg(probability).alias("avg_fraud_probability"),
        F.max("detected_at").alias("latest_detection"),
    )


def signals_by_type(detections: DataFrame) -> DataFrame:
    return detections.groupBy("signal_type").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "signal_type")


def recent_detections(detections: DataFrame, n: int = 100) -> DataFrame:
    newest = detections.orderBy(F.desc_nulls_last("detected_at"), "detection_id").limit(n)
    return newest.select(
        "application_id", "customer_id", "signal_type", "severity",
        F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at"), "description",
    )


def severity_cards(detections: DataFrame, n: int = 100) -> DataFrame:
    return recent_detections(detections, n).agg(
        F.count(F.lit(1)).alias("total_signals"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity") == "HIGH").alias("high"),
    )


def customer_signal_counts(detections: DataFrame, n: int = 10) -> DataFrame:
    return (
        detections.groupBy("customer_id")
        .agg(F.count("signal_type").alias("signal_count"), F.max("detected_at").alias("latest_signal"))
        .orderBy(F.desc("signal_count"), "customer_id")
        .limit(n)
    )


def readiness(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table with PASS, or WARN for an empty one."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).select(
        "table_name", "n_rows", F.when(F.col("n_rows") > 0, "PASS").otherwise("WARN").alias("status")
    )


def filings_per_customer(filings: DataFrame) -> DataFrame:
    ids = filings.select(stripped("customer_id").alias("customer_id")).where(F.col("customer_id") != "")
    return ids.groupBy("customer_id").agg(F.count(F.lit(1)).alias("filings"))


def block_rate(filings: DataFrame, sequence: Column, block_size: int = 50) -> DataFrame:
    """Fraud rows per block of `block_size` in arrival order; `sequence` is the 1-based arrival number."""
    return (
        filings.groupBy(F.floor((sequence - 1) / F.lit(block_size)).cast("long").alias("block"))
        .agg(F.count(F.lit(1)).alias("n"), fraud_rows().alias("fraud_count"))
    )


def keep_last_per_application(df: DataFrame, order: list[Column]) -> DataFrame:
    return latest_per_key(df, ["application_id"], order)


# fixed values: highest expected yearly income per employment type
INCOME_CEILING = {"EMPLOYED": 650_000.0, "SELF_EMPLOYED": 900_000.0, "CONTRACTOR": 750_000.0, "UNEMPLOYED": 30_000.0}
DEFAULT_CEILING = 650_000.0


def income_ceiling(employment_type="employment_type") -> Column:
    value = F.col(employment_type) if isinstance(employment_type, str) else employment_type
    pairs = [F.lit(x) for pair in INCOME_CEILING.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[value], F.lit(DEFAULT_CEILING))


def archetype(repeat_filer: Column) -> Column:
    """High-risk profile a cleaned filing fits, NULL for none."""
    income, ceiling = F.col("taxable_income"), income_ceiling()
    amended = F.col("filing_status") == "AMENDED"
    return (
        F.when((F.col("employment_type") == "UNEMPLOYED") & (income >= 150_000), "phantom_income")
        .when(amended & (income >= 2.5 * ceiling), "income_inflation")
        .when(repeat_filer & amended & (income >= 1.5 * ceiling), "serial_filer")
    )


def tag_archetypes(cleaned: DataFrame, min_filings: int = 3) -> DataFrame:
    """Adds `archetype`; a repeat filer has at least `min_filings` filings."""
    counts = filings_per_customer(cleaned)
    repeaters = counts.where(F.col("filings") >= min_filings).select("customer_id", F.lit(True).alias("repeat_filer"))
    known = salted_lookup(
        cleaned.withColumn("customer_id", stripped("customer_id")), repeaters, "customer_id",
        F.col("application_id"), counts, "filings",
    )
    return known.withColumn(
        "archetype", archetype(F.coalesce("repeat_filer", F.lit(False)))
    ).drop("repeat_filer")


def risk_band(probability="fraud_probability") -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.when(p >= 0.75, "HIGH").when(p >= 0.45, "MEDIUM").otherwise("LOW")


# fixed values: words that send a question to the fraud check
FRAUD_WORDS = [
    "fraud", "suspicious", "risk", "investigate", "application_id", "app-", "application id",
    "check application", "is this fraud", "flag", "anomaly", "pattern", "detect",
]


def route_questions(df: DataFrame, text: str = "text", words: list[str] | None = None) -> DataFrame:
    """Adds `intent` (fraud_check or tax_question) and the application id a fraud question names."""
    lowered = F.lower(F.col(text))
    hit = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in (FRAUD_WORDS if words is None else words)])
    found = F.upper(F.regexp_extract(F.col(text), r"(?i)(APP-[A-Z0-9\-]+)", 1))
    return df.withColumn("intent", F.when(hit, "fraud_check").otherwise("tax_question")).withColumn(
        "application_id", F.when((F.col("intent") == "fraud_check") & (found != ""), found)
    )


