"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the input, BENCH_CPUS (default 8) the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from levyline.plans.registry import QUERIES  # noqa: E402
from levyline.session import build_session  # noqa: E402

HEADLINE = [
    "kpi_tumbling_5m", "kpi_raw_tumbling_5m", "sliding_kpi", "clean_applications", "decode_status",
    "enrich_interval_left", "enrich_one_per_application", "asof_profile", "label_24h",
    "high_frequency_signals", "signals_union", "kpi_trend", "fraud_summary", "income_histogram",
    "top_flagged_customers", "province_heatmap", "fraud_by_province_view", "keep_last_per_application",
    "lake_newest_partitions", "archetype_tags", "audit_metadata", "features_score", "stratified_split_sizes",
    "pr_curve", "pick_threshold", "point_ids", "knn_cosine", "kb_context", "md_chunks", "lineage_jobs",
    "stream_kpi", "stream_fraud_patterns", "stream_enrich", "stream_clean", "stream_vector_sync",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["topic_volume"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # JVM warm-up
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in names:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    streams = [s for s in names if s.startswith("stream_")]
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "events": n_events,
        "stream_events_per_second": {s: round(n_events / seconds[s]) for s in streams},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
