"""Every registered query: (session, folder of the input tables) -> frame.

All of them read the whole input tables. Times come out without zone and decimals as doubles, so
that results compare in any engine.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyline.functions.text import event_time, seconds_text, uuid5
from levyline.ml import evaluation, training
from levyline.ml.features import CATEGORICAL, NUMERIC, FilingHistory
from levyline.operators import analytics, audit, chunks, clean, enrich, kpi, lineage, retrieval, signals
from levyline.plans import jobs
from levyline.session import configure, stream_session, work_folder
from levyline.sinks import lake as lake_sink
from levyline.sinks import manifest, serving, vectors
from levyline.sources import lake, streams
from levyline.sources import testdata as data
from levyline.streaming.runner import AVAILABLE_NOW, drain, finish

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    kinds = {T.TimestampType: "timestamp_ntz", T.DecimalType: "double", T.DateType: "string"}
    return df.select(*[
        F.col(f.name).cast(kinds[type(f.dataType)]).alias(f.name) if type(f.dataType) in kinds else F.col(f.name)
        for f in df.schema.fields
    ])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(configure(spark), sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# ---- shared inputs


def _filings(spark, sf):
    return streams.with_event_time(data.filings(spark, sf))


def _profiles(spark, sf):
    return streams.with_event_time(data.profiles(spark, sf))


def _clean(spark, sf):
    """Cleaned filings whose processing time is the event time, so that results repeat."""
    rows = clean.cleaned(data.filings(spark, sf), seconds_text("_produced_at"))
    return rows.withColumn("processed_at", event_time("produced_at")).withColumn("event_time", F.col("processed_at"))


def _kpis(spark, sf):
    return kpi.kpi_windows(_clean(spark, sf))


def _signals(spark, sf):
    """External signals and the derived ones, as one topic holds them."""
    return signals.all_signals(
        data.signals(spark, sf), signals.derived_signals(_filings(spark, sf), DAY_MINUTES)
    )


def _detections(spark, sf):
    return signals.detections(_signals(spark, sf))


DAY_MINUTES = 1440  # three filings in ten minutes hardly occur in the input


# ---- windows, cleaning, signals


@query
def kpi_tumbling_5m(spark, sf):
    return _kpis(spark, sf)


@query
def kpi_raw_tumbling_5m(spark, sf):
    """As the stream job runs it: all filings, gated or not, ids as they come."""
    return kpi.kpi_windows(_filings(spark, sf))


@query
def sliding_kpi(spark, sf):
    return kpi.kpi_windows(_clean(spark, sf), "10 minutes", "5 minutes")


@query
def busiest_province(spark, sf):
    return kpi.busiest_province(_clean(spark, sf), "1 day")


@query
def first_arrivals(spark, sf):
    """Ids seen at least once; the customer stands in for the application."""
    arrivals = _clean(spark, sf).select(F.col("customer_id").alias("application_id"))
    return streams.first_arrivals(arrivals)


@query
def clean_applications(spark, sf):
    return clean.cleaned(data.filings(spark, sf)).drop("flink_processed_at")


@query
def dq_rejects(spark, sf):
    return clean.gate_rejects(data.filings(spark, sf)).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def raw_archive_counts(spark, sf):
    return clean.raw_archive(data.filings(spark, sf)).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query
def decode_status(spark, sf):
    """Messages as a broker delivers them, some no JSON and some with a field of the wrong type."""
    number = F.substring("application_id", 5, 20).cast("long")
    sent = serving.as_messages(data.filings(spark, sf).withColumn("n", number)).withColumn(
        "n", F.get_json_object("value", "$.n").cast("long")
    )
    broken = sent.select(
        F.when(F.col("n") % 113 == 0, F.lit("not json"))
        .when(F.col("n") % 127 == 0, F.regexp_replace("value", '"is_fraud":(true|false)', '"is_fraud":"maybe"'))
        .otherwise(F.col("value")).alias("value")
    )
    decoded = streams.decode_json(broken, data_schema())
    return decoded.groupBy(F.col("_status").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.count("application_id").alias("with_id"), F.count("is_fraud").alias("with_flag")
    )


def data_schema() -> str:
    from levyline.schemas import FILING

    return FILING


@query
def unreadable_stamps(spark, sf):
    return streams.unreadable_stamps(data.audit_events(spark, sf), "timestamp").select("event_id", "timestamp")


@query
def enrich_interval_left(spark, sf):
    return enrich.enrich_interval(_filings(spark, sf), _profiles(spark, sf)).drop("processed_at")


@query
def enrich_one_per_application(spark, sf):
    return enrich.enrich_once(_filings(spark, sf), _profiles(spark, sf)).drop("processed_at")


@query
def asof_profile(spark, sf):
    return enrich.enrich_asof(_filings(spark, sf), _profiles(spark, sf)).select(
        "application_id", "customer_id", "age", "risk_score", "historical_filings_count", "avg_income_3yr", "flagged_previously"
    )


@query
def income_vs_avg3yr(spark, sf):
    rows = enrich.enrich_asof(_filings(spark, sf), _profiles(spark, sf))
    return enrich.income_above_history(rows).select("application_id", "taxable_income", "avg_income_3yr")


@query
def label_24h(spark, sf):
    sent = streams.with_event_time(data.signals(spark, sf), stamp="detected_at")
    return enrich.label_by_signals(_filings(spark, sf), sent).select("application_id", "label")


@query
def high_frequency_signals(spark, sf):
    return signals.high_frequency_signals(_filings(spark, sf), DAY_MINUTES)


@query
def income_spike_signals(spark, sf):
    return signals.income_spike_signals(data.filings(spark, sf))


@query
def signals_union(spark, sf):
    return _signals(spark, sf).groupBy("signal_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@query
def normalise_signals(spark, sf):
    return signals.detections(data.signals(spark, sf))


@query
def signal_domain_checks(spark, sf):
    raw = data.signals(spark, sf).select(F.upper(F.trim("severity")).alias("severity"), F.lit("FLINK").alias("source"))
    return signals.domain_violations(raw, ["severity", "source"])


# ---- analytics


@query
def kpi_trend(spark, sf):
    return analytics.kpi_trend(_clean(spark, sf))


@query
def fraud_summary(spark, sf):
    return analytics.fraud_summary(_clean(spark, sf))


@query
def fraud_summary_bucketed(spark, sf):
    return analytics.fraud_summary_by_time(_clean(spark, sf))


@query
def income_histogram(spark, sf):
    return analytics.income_histogram(_clean(spark, sf))


@query
def top_flagged_customers(spark, sf):
    return analytics.top_flagged_customers(_clean(spark, sf))


@query
def province_heatmap(spark, sf):
    return analytics.province_heatmap(_clean(spark, sf))


@query
def top_provinces(spark, sf):
    return analytics.top_provinces_ascending(analytics.province_heatmap(_clean(spark, sf))).select("province", "fraud_count")


@query
def fraud_by_province_view(spark, sf):
    found = _detections(spark, sf).withColumn("fraud_probability", F.pmod(F.length("detection_id"), F.lit(4)) * 0.25)
    filings = data.filings(spark, sf).select("application_id", F.upper(F.trim("province")).alias("province"))
    return analytics.fraud_summary_by_province(found, filings)


@query
def signals_by_type(spark, sf):
    return analytics.signals_by_type(_detections(spark, sf))


@query
def severity_cards(spark, sf):
    return analytics.severity_cards(_detections(spark, sf))


@query
def recent_signals(spark, sf):
    return analytics.recent_detections(_detections(spark, sf))


@query
def customer_signal_top10(spark, sf):
    return analytics.customer_signal_counts(_detections(spark, sf))


@query
def latest_kpi(spark, sf):
    return kpi.latest_kpi(_kpis(spark, sf))


@query
def last_windows(spark, sf):
    return kpi.last_windows_ascending(_kpis(spark, sf))


@query
def kpi_cache_rows(spark, sf):
    return kpi.kpi_cache_rows(kpi.newest_windows(_kpis(spark, sf))).drop("expires_at")


@query
def kpi_latest_summary(spark, sf):
    return kpi.kpi_summary_row(_kpis(spark, sf)).drop("updated_at", "expires_at")


@query
def kpi_cache_unexpired(spark, sf):
    """Cache rows still alive ten minutes after the newest window began, each written at its window end."""
    windows = _kpis(spark, sf)
    newest = windows.agg(F.max("window_start").alias("t"))
    cache = kpi.kpi_cache_rows(windows, F.col("window_end"))
    return kpi.unexpired(cache, newest.scalar() + F.expr("INTERVAL 10 MINUTES")).select("cache_key", "expires_at")


@query
def alert_flags(spark, sf):
    scored = _clean(spark, sf).select(
        "customer_id", F.col("processed_at").alias("scored_at"),
        analytics.risk_band(F.col("taxable_income") / 1_000_000).alias("risk"),
    )
    return kpi.alert_flags(scored)


# ---- scans


@query
def newest_partitions_scan(spark, sf):
    return lake.newest_partitions(_clean(spark, sf)).select("application_id", "dt")


def _written_lake(spark, sf) -> str:
    folder = work_folder(spark, "lake")
    lake_sink.write_lake(clean.cleaned(data.filings(spark, sf), seconds_text("_produced_at")), folder)
    return folder


@query
def lake_newest_partitions(spark, sf):
    """The cleaned lake on disk: partitions from the file listing, then a pruned scan."""
    folder = _written_lake(spark, sf)
    known = lake.partition_inventory(spark, folder)
    return lake.newest_partitions(lake.read_lake(spark, folder), partitions=known).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def lake_inventory(spark, sf):
    """Partitions of the lake on disk that hold at least one file."""
    return lake.partition_inventory(spark, _written_lake(spark, sf)).select("dt", (F.col("n_files") > 0).alias("has_files"))


@query
def lake_recent_arrivals(spark, sf):
    """Read in rounds of a third of the files each, until nothing is new."""
    folder = _written_lake(spark, sf)
    third = -(-lake.file_inventory(spark, folder).count() // 3)
    rows, since = lake.recent_arrivals(spark, folder, max_files=third)
    while True:
        more, until = lake.recent_arrivals(spark, folder, since, max_files=third)
        if until == since:
            break
        rows, since = rows.unionByName(more), until
    return rows.groupBy("province", "is_fraud").agg(F.count(F.lit(1)).alias("n"))


@query
def ml_dataset(spark, sf):
    return lake.ml_dataset(_clean(spark, sf), None)


@query
def recent_events(spark, sf):
    return lake.recent_events(_clean(spark, sf))


@query
def keep_last_per_application(spark, sf):
    """Several arrivals per id: the customer stands in for the application."""
    arrivals = _clean(spark, sf).select(
        F.col("customer_id").alias("application_id"), F.col("application_id").alias("arrival"), "produced_at", "taxable_income"
    )
    return analytics.keep_last_per_application(arrivals, [F.desc("produced_at"), F.desc("arrival")])


@query
def readiness_report(spark, sf):
    return analytics.readiness({
        "enriched_tax_applications": data.filings(spark, sf), "tax_kpi_windows": _kpis(spark, sf),
        "fraud_detections": _detections(spark, sf), "audit_log": audit.audit_log(data.audit_events(spark, sf)),
    })


@query
def block_rate(spark, sf):
    arrival = F.substring("application_id", 5, 20).cast("long") + 1
    return analytics.block_rate(data.filings(spark, sf), arrival)


@query
def topic_volume(spark, sf):
    topics = {"tax-applications": data.filings, "taxpayer-profiles": data.profiles,
              "fraud-signals": data.signals, "audit-events": data.audit_events}
    messages = None
    for topic, rows in topics.items():
        part = rows(spark, sf).select(F.lit(topic).alias("topic"))
        messages = part if messages is None else messages.unionByName(part)
    return streams.volume_by_topic(messages)


@query
def archetype_tags(spark, sf):
    tagged = analytics.tag_archetypes(_clean(spark, sf))
    return tagged.where(F.col("archetype").isNotNull()).select("application_id", "archetype")


@query
def risk_bands(spark, sf):
    probability = F.least(F.col("taxable_income") / 1_000_000, F.lit(1.0))
    return _clean(spark, sf).select("application_id", analytics.risk_band(probability).alias("risk"))


@query
def question_routing(spark, sf):
    asked = data.table(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("question_id"), "text"
    )
    about = data.audit_events(spark, sf).select(
        F.col("event_id").alias("question_id"),
        F.concat(F.lit("What happened after "), "action", F.lit(" to "), F.lower(F.coalesce("application_id", F.lit("it"))), F.lit("?")).alias("text"),
    )
    return analytics.route_questions(asked.unionByName(about)).drop("text")


# ---- audit


@query
def audit_ingest(spark, sf):
    return audit.audit_log(data.audit_events(spark, sf)).withColumn(
        "has_metadata", F.col("metadata").isNotNull()
    ).drop("metadata", "outcome")


@query
def audit_actor_counts(spark, sf):
    return audit.actor_counts(audit.audit_log(data.audit_events(spark, sf)))


@query
def audit_metadata(spark, sf):
    return audit.metadata_fields(audit.audit_log(data.audit_events(spark, sf)))


# ---- model


def _ml_rows(spark, sf):
    return lake.ml_dataset(_clean(spark, sf), None)


def _feature_output(df):
    return df.select(
        "application_id", *CATEGORICAL, *[c for c in NUMERIC if c != "log_income"], F.round("log_income", 6).alias("log_income")
    )


@query
def features_fit(spark, sf):
    rows = _ml_rows(spark, sf)
    return _feature_output(FilingHistory().fit(rows).fitted_rows(rows))


@query
def features_score(spark, sf):
    """History learned up to 20 January, all filings scored."""
    rows = _clean(spark, sf)
    history = FilingHistory().fit(lake.ml_dataset(rows.where(F.col("dt") <= "2024-01-20"), None))
    return _feature_output(history.transform(lake.ml_dataset(rows, None)))


@query
def class_weights(spark, sf):
    return training.class_weights(training.labelled(_ml_rows(spark, sf)))


@query
def stratified_split_sizes(spark, sf):
    split = training.with_split(training.labelled(_ml_rows(spark, sf)))
    return split.groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


@query
def stratified_fold_sizes(spark, sf):
    folded = training.with_fold(training.labelled(_ml_rows(spark, sf)), 5)
    return folded.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


def _scored(spark, sf):
    """A fixed score: a share of the income plus a step for amended filings."""
    return _clean(spark, sf).select(
        "application_id",
        (F.col("taxable_income") / 2_000_000 + F.when(F.col("filing_status") == "AMENDED", 0.125).otherwise(0.0)).alias("score"),
        F.col("is_fraud").cast("int").alias("label"),
    )


@query
def pr_curve(spark, sf):
    return evaluation.pr_curve(_scored(spark, sf)).select("threshold", "flagged", "tp", "precision", "recall", "f1")


@query
def pick_threshold(spark, sf):
    curve = evaluation.pr_curve(_scored(spark, sf))
    floors = {"f1": (0.5, 0.5), "recall": (0.6, 0.5), "precision": (0.5, 0.3), "infeasible": (1.01, 0.5)}
    picks = None
    for name, (precision, recall) in floors.items():
        objective = "recall" if name == "infeasible" else name
        row = evaluation.pick_threshold(curve, objective, precision, recall).withColumn("objective", F.lit(name))
        picks = row if picks is None else picks.unionByName(row)
    return picks


@query
def metrics_at(spark, sf):
    return evaluation.metrics_at(_scored(spark, sf), 0.25)


@query
def average_precision(spark, sf):
    return evaluation.average_precision(evaluation.pr_curve(_scored(spark, sf))).select(
        F.round("average_precision", 6).alias("average_precision")
    )


@query
def confusion(spark, sf):
    return evaluation.confusion_matrix(_scored(spark, sf), 0.25)


@query
def live_scoring_counts(spark, sf):
    return evaluation.confusion(_scored(spark, sf), 0.25)


@query
def class_report(spark, sf):
    return evaluation.class_report(_scored(spark, sf), 0.25)


SMALL_MODELS = {
    "random_forest": {"n_estimators": 20, "max_depth": 8},
    "gradient_boosting": {"max_iter": 10},
    "logistic_regression": {},
}


def _train_and_score(spark, sf, family):
    rows = _ml_rows(spark, sf)
    model = training.train(rows, family, SMALL_MODELS[family], folds=2)
    return model.score(rows).select("application_id", "fraud_probability", "predicted_fraud", "is_fraud")


@query
def train_score_rf(spark, sf):
    return _train_and_score(spark, sf, "random_forest")


@query
def train_score_gbt(spark, sf):
    return _train_and_score(spark, sf, "gradient_boosting")


@query
def train_score_lr(spark, sf):
    return _train_and_score(spark, sf, "logistic_regression")


@query
def tune_trials(spark, sf):
    trials, _, _ = training.tune(_ml_rows(spark, sf), ["logistic_regression"], n_trials=2, folds=2)
    return training.rank_trials(trials).select("rank", "family", "label", "is_default", "score", "cv_f1", "threshold", "feasible")


def _trials(spark, sf):
    """Trials from the filings: an employment type is a family, a filing status and province a trial.

    There are as many as the categories combine to, however many filings there are.
    """
    return _clean(spark, sf).groupBy(
        F.col("employment_type").alias("family"),
        F.concat_ws("/", "filing_status", F.coalesce("province", F.lit("none"))).alias("label"),
    ).agg(
        (F.count_if("is_fraud").cast("double") / F.count(F.lit(1))).alias("score"),
        (F.count_if(F.col("taxable_income") > 100_000).cast("double") / F.count(F.lit(1))).alias("cv_f1"),
    ).withColumn("score", F.when(F.col("score") > 0, F.col("score")))


@query
def trial_ranking(spark, sf):
    return training.rank_trials(_trials(spark, sf)).select("rank", "family", "label")


@query
def best_per_family(spark, sf):
    return training.best_per_family(_trials(spark, sf))


@query
def top_trials(spark, sf):
    return training.top_trials(_trials(spark, sf))


@query
def run_pivot(spark, sf):
    """A day is a run; its shares are metrics in key/value form, then one wide row per run."""
    days = _clean(spark, sf).groupBy(F.col("dt").alias("run_id")).agg(
        (F.count_if("is_fraud").cast("double") / F.count(F.lit(1))).alias("fraud_share"),
        (F.count_if(F.col("filing_status") == "AMENDED").cast("double") / F.count(F.lit(1))).alias("amended_share"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )
    entries = days.unpivot(["run_id"], ["fraud_share", "amended_share", "n"], "key", "value")
    return training.runs_wide(entries, ["fraud_share", "amended_share", "n"], digits=4)


# ---- vectors and chunks


@query
def point_ids(spark, sf):
    return data.filings(spark, sf).select("application_id", uuid5(F.col("application_id")).alias("point_id"))


@query
def new_records_anti(spark, sf):
    """Collection filled up to 20 January, records of all days offered."""
    rows = _clean(spark, sf)
    points = rows.where(F.col("dt") <= "2024-01-20").select(uuid5(F.col("application_id")).alias("point_id"))
    return retrieval.new_records(rows, points).select("application_id", "dt")


@query
def record_text(spark, sf):
    return _ml_rows(spark, sf).select("application_id", retrieval.record_text().alias("text"))


@query
def payload(spark, sf):
    rows = _clean(spark, sf)
    return rows.select(*retrieval.payload_columns(rows))


def _cases(spark, sf):
    return data.table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").alias("vector"), (F.col("label") >= 5).alias("is_fraud"), "label"
    )


def _centroids(cases):
    """One query per label: the mean of its vectors."""
    dim = 64
    return cases.groupBy("label").agg(F.array(*[F.avg(F.col("vector")[i]) for i in range(dim)]).alias("vector"))


def _similar(spark, sf):
    cases = _cases(spark, sf)
    return retrieval.search_index(
        cases.drop("label"), _centroids(cases), "vec_id", "label", 5, payload=["is_fraud"]
    )


@query
def knn_cosine(spark, sf):
    return _similar(spark, sf).select("label", "vec_id", "rank", F.round("similarity", 4).alias("similarity"))


@query
def similar_case_evidence(spark, sf):
    return retrieval.similar_case_evidence(_similar(spark, sf), "label", similar=0.5, case_id="vec_id")


@query
def md_chunks(spark, sf):
    return chunks.section_chunks(data.markdown_files(spark, sf))


@query
def chunk_points(spark, sf):
    return chunks.with_point_ids(chunks.section_chunks(data.markdown_files(spark, sf))).select(
        "file", "position", "chunk_id", "point_id"
    )


def _questions(spark, sf):
    asked = data.table(spark, sf, "conversations").where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"), "text"
    )
    return retrieval.letter_embedder(asked, "text")


def _knowledge(spark, sf):
    """The benchmark texts as a curated collection."""
    texts = data.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("chunk"), F.concat(F.lit("file-"), F.pmod("item_id", F.lit(5)), F.lit(".md")).alias("file"),
        F.concat(F.lit("item "), "item_id").alias("section"), F.lit("benchmark").alias("source"),
        F.lit("checked").alias("status"), "text",
    )
    return retrieval.letter_embedder(texts, "text")


@query
def kb_context(spark, sf):
    questions, known = _questions(spark, sf), _knowledge(spark, sf)
    hits = retrieval.match_queries(questions, known, "question_id", "chunk", 4)
    return retrieval.kb_context(questions, hits.join(known.drop("vector"), "chunk"), "question_id")


@query
def kb_fallback(spark, sf):
    """Long texts are the first collection, short ones the second; only close first matches count."""
    known = _knowledge(spark, sf)
    return retrieval.search_with_fallback(
        _questions(spark, sf), known.where(F.length("text") >= 200), known.where(F.length("text") < 200),
        "question_id", "chunk", 4, 3, min_similarity=0.95,
    ).select("question_id", "chunk", "rank", "collection", F.round("similarity", 4).alias("similarity"))


# ---- lineage


@query
def lineage_jobs(spark, sf):
    return lineage.lineage_jobs(data.run_events(spark, sf))


@query
def lineage_datasets(spark, sf):
    return lineage.lineage_datasets(data.run_events(spark, sf))


def _expected_jobs(spark, sf):
    """Jobs that should exist: two more per kind of event than ever run."""
    return data.table(spark, sf, "events").select(
        F.when(F.col("event_type") == "view", "mlflow").when(F.col("event_type") == "error", "postgres")
        .otherwise("flink").alias("namespace"),
        F.concat(F.lit("job_"), "event_type", F.lit("_"), F.pmod("user_id", F.lit(12))).alias("job_name"),
    ).distinct()


@query
def lineage_latest_state(spark, sf):
    return lineage.latest_states(data.run_events(spark, sf), _expected_jobs(spark, sf))


@query
def lineage_missing(spark, sf):
    return lineage.missing_jobs(_expected_jobs(spark, sf), data.run_events(spark, sf))


@query
def lineage_totals(spark, sf):
    return lineage.namespace_totals(data.run_events(spark, sf))


# ---- streams over all events, run until the input is used up


@query
def stream_kpi(spark, sf):
    own = stream_session(spark)
    return drain(jobs.kpi_windows(data.stream_of(own, sf, data.FILINGS_SQL, closed=True)), spark, "stream_kpi")


@query
def stream_fraud_patterns(spark, sf):
    own = stream_session(spark)
    found = jobs.fraud_patterns(data.stream_of(own, sf, data.FILINGS_SQL, closed=True), DAY_MINUTES)
    return drain(found, spark, "stream_fraud_patterns")


@query
def stream_enrich(spark, sf):
    own = stream_session(spark)
    joined = jobs.enriched_filings(
        data.stream_of(own, sf, data.FILINGS_SQL, closed=True), data.stream_of(own, sf, data.PROFILES_SQL, closed=True)
    )
    return drain(joined, spark, "stream_enrich").select("application_id", "customer_id", "age", "risk_score", "avg_income_3yr")


def _two_topics(spark, sf):
    own = stream_session(spark)
    return (data.stream_of(own, sf, sql, closed=True) for sql in (data.FILINGS_SQL, data.PROFILES_SQL))


@query
def stream_enrich_once(spark, sf):
    """Every filing once, in several micro-batches, with the profile closest in time."""
    return drain(jobs.once_enriched_filings(*_two_topics(spark, sf), spread=2), spark, "stream_once").drop("processed_at")


@query
def stream_asof(spark, sf):
    """Every filing once, in several micro-batches, with the newest profile at or before it."""
    return drain(jobs.asof_enriched_filings(*_two_topics(spark, sf), spread=2), spark, "stream_asof").select(
        "application_id", "customer_id", "age", "risk_score", "historical_filings_count", "avg_income_3yr", "flagged_previously"
    )


@query
def stream_clean(spark, sf):
    own = stream_session(spark)
    folder = work_folder(spark, "stream_clean")
    rows = jobs.cleaned_lake(data.stream_of(own, sf, data.FILINGS_SQL))
    finish(lake_sink.start_lake_sink(rows, f"{folder}/lake", f"{folder}/checkpoint", "stream_clean", trigger=AVAILABLE_NOW))
    return lake.read_lake(spark, f"{folder}/lake").drop("flink_processed_at")


@query
def stream_raw_archive(spark, sf):
    own = stream_session(spark)
    folder = work_folder(spark, "stream_raw")
    rows = jobs.raw_archive(data.stream_of(own, sf, data.FILINGS_SQL))
    finish(lake_sink.start_lake_sink(rows, f"{folder}/lake", f"{folder}/checkpoint", "stream_raw", trigger=AVAILABLE_NOW))
    stored = lake.read_lake(spark, f"{folder}/lake", schema=f"{data_schema()}, dt STRING")
    return stored.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.count("customer_id").alias("with_customer"))


KPI_ROW = (
    "window_start TIMESTAMP, window_end TIMESTAMP, total_count BIGINT, avg_income DOUBLE, distinct_customers BIGINT, "
    "fraud_count BIGINT, fraud_rate DOUBLE, top_province STRING"
)


@query
def stream_kpi_early(spark, sf):
    """Open windows included: update mode into an upsert table."""
    own = stream_session(spark)
    folder = work_folder(spark, "stream_early")
    filings = jobs.filings_from(data.stream_of(own, sf, data.FILINGS_SQL))
    finish(serving.start_upsert(
        kpi.kpi_windows_early(filings), f"{folder}/kpi", f"{folder}/checkpoint", "stream_kpi_early", ["window_start"],
        [F.desc("total_count")], output_mode="update", trigger=AVAILABLE_NOW,
    ))
    schema = KPI_ROW.replace("distinct_customers", "approx_customers")
    return serving.read_current(spark, f"{folder}/kpi", schema, ["window_start"]).drop("approx_customers")


DETECTION = (
    "detection_id STRING, application_id STRING, customer_id STRING, signal_type STRING, severity STRING, "
    "source STRING, description STRING, detected_at TIMESTAMP"
)


@query
def stream_detections(spark, sf):
    own = stream_session(spark)
    folder = work_folder(spark, "stream_detections")
    rows = jobs.detections(data.stream_of(own, sf, data.SIGNALS_SQL))
    finish(serving.start_upsert(
        rows, f"{folder}/table", f"{folder}/checkpoint", "stream_detections", ["detection_id"],
        [F.desc_nulls_last("detected_at")], trigger=AVAILABLE_NOW,
    ))
    return serving.read_current(spark, f"{folder}/table", DETECTION, ["detection_id"])


@query
def stream_audit(spark, sf):
    own = stream_session(spark)
    rows = audit.metadata_fields(jobs.audit_log(data.stream_of(own, sf, data.AUDIT_SQL)))
    return drain(rows, spark, "stream_audit").groupBy("action", "channel", "trigger_reason", "validation_rule").agg(
        F.count(F.lit(1)).alias("n"), F.sum("refund_amount").alias("refunds")
    )


@query
def stream_vector_sync(spark, sf):
    own = stream_session(spark)
    folder = work_folder(spark, "stream_sync")
    records = jobs.cleaned_lake(data.stream_of(own, sf, data.FILINGS_SQL), F.lit("2024-02-01 00:00:00"))
    finish(vectors.start_sync(records, f"{folder}/points", f"{folder}/checkpoint", trigger=AVAILABLE_NOW))
    return vectors.collection(spark, f"{folder}/points").drop("vector")


CACHE_ROW = ", ".join(f"{c} STRING" for c in (
    "cache_key", "window_start", "window_end", "total_count", "avg_income", "distinct_customers", "fraud_count", "fraud_rate", "top_province"
)) + ", expires_at TIMESTAMP"


@query
def stream_kpi_cache(spark, sf):
    """KPI windows and their cache rows upserted as they close; both tables are compacted, and expired rows purged, while the stream runs.

    A cache row lives two days from the end of its window, by the clock of the newest one.
    """
    own = stream_session(spark)
    folder = work_folder(spark, "stream_cache")

    def newest(rows):
        last = rows.agg(F.max("expires_at")).first()[0]
        return F.lit(last).cast("timestamp") - F.expr("INTERVAL 2 DAYS")

    kpis = manifest.ServingTable(spark, f"{folder}/kpi", KPI_ROW, ["window_start"])
    cache = manifest.ServingTable(spark, f"{folder}/cache", CACHE_ROW, ["cache_key"], expires="expires_at")
    finish(manifest.start_serving(
        jobs.kpi_windows(data.stream_of(own, sf, data.FILINGS_SQL, closed=True)),
        [
            manifest.Output(kpis, [F.desc("total_count")]),
            manifest.Output(cache, [F.desc("window_start")], lambda batch: kpi.kpi_cache_rows(batch, F.col("window_end"), 2 * 86400), newest),
        ],
        f"{folder}/checkpoint", "stream_kpi_cache", trigger=AVAILABLE_NOW, compact_every=2,
    ))
    return cache.current(newest(cache.rows()))
