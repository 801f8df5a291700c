"""Raw filing columns to model features, with the filing history learned from the training rows."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.functions.text import stripped, to_number
from levyline.operators.analytics import income_ceiling
from levyline.operators.skew import salted_lookup

CATEGORICAL = ["province", "employment_type", "employment_status", "filing_status"]
NUMERIC = ["taxable_income", "log_income", "income_ratio", "above_ceiling", "customer_filings"]
TARGET = "is_fraud"


def _column(df: DataFrame, name: str, default, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(default).cast(kind)


def _customer(df: DataFrame) -> Column:
    """Customer id without surrounding white space, NULL when blank."""
    return F.nullif(stripped(F.coalesce(_column(df, "customer_id", "", "string").cast("string"), F.lit(""))), F.lit(""))


def _application(df: DataFrame) -> Column:
    return F.nullif(F.coalesce(_column(df, "application_id", "", "string").cast("string"), F.lit("")), F.lit(""))


def build_features(df: DataFrame, filings: str = "customer_filings") -> DataFrame:
    """Feature columns beside all others of `df`, which must hold the filing count."""
    with_categories = df.withColumns({
        name: F.upper(F.coalesce(_column(df, name, "UNKNOWN", "string").cast("string"), F.lit("UNKNOWN")))
        for name in CATEGORICAL
    })
    income = F.greatest(to_number(_column(df, "taxable_income", 0.0, "double")), F.lit(0.0))
    with_income = with_categories.withColumn("taxable_income", income)
    ratio = F.col("taxable_income") / income_ceiling()
    return with_income.withColumns({
        "log_income": F.log1p("taxable_income"),
        "income_ratio": ratio,
        "above_ceiling": (ratio > 1.0).cast("double"),
        "customer_filings": F.coalesce(F.col(filings), F.lit(1)).cast("double"),
    })


class FilingHistoryModel(Model):
    """Filing counts per customer and the application ids they were counted from."""

    def __init__(self, counts: DataFrame, known_ids: DataFrame):
        super().__init__()
        self.counts, self.known_ids = counts, known_ids

    def _with_history(self, df: DataFrame) -> DataFrame:
        keyed = df.withColumn("_customer", _customer(df)).withColumn("_application", _application(df))
        history = self.counts.select(F.col("customer_id").alias("_customer"), F.col("filings").alias("_filings"))
        return salted_lookup(
            keyed, history, "_customer", F.coalesce("_application", F.lit("")), history, "_filings"
        )

    def fitted_rows(self, df: DataFrame) -> DataFrame:
        """Features of the very rows the history was learned from: the count includes the row itself."""
        return build_features(
            self._with_history(df).withColumn("customer_filings", F.coalesce("_filings", F.lit(1)))
        ).drop("_customer", "_application", "_filings")

    def _transform(self, df: DataFrame) -> DataFrame:
        """Features of rows to score: known history, plus one for an application not seen at fit time."""
        seen = self.known_ids.select(F.col("application_id").alias("_application"), F.lit(True).alias("_seen"))
        joined = self._with_history(df).join(seen, "_application", "left")
        unseen = F.when(F.col("_seen"), F.lit(0)).otherwise(F.lit(1))
        return build_features(
            joined.withColumn("customer_filings", F.coalesce("_filings", F.lit(0)) + unseen)
        ).drop("_customer", "_application", "_filings", "_seen")

    def save(self, path: str) -> None:
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        self.known_ids.write.mode("overwrite").parquet(f"{path}/known_ids")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FilingHistoryModel":
        return cls(spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/known_ids"))


class FilingHistory(Estimator):
    def _fit(self, df: DataFrame) -> FilingHistoryModel:
        counts = (
            df.select(_customer(df).alias("customer_id")).where(F.col("customer_id").isNotNull())
            .groupBy("customer_id").agg(F.count(F.lit(1)).alias("filings"))
        )
        known = (
            df.select(_application(df).alias("application_id")).where(F.col("application_id").isNotNull()).distinct()
        )
        return FilingHistoryModel(counts, known)
