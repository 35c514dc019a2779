"""Time the headline queries on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up, then up to ``$BENCH_RUNS`` times within ``$BENCH_SECONDS``;
the median counts. Results go to a no-op sink, so all rows are produced and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataflow import session  # noqa: E402
from strataflow.catalog.queries import QUERIES  # noqa: E402

HEADLINE = (
    "silver_trips", "silver_weather", "silver_rejects", "gold_daily_summary",
    "view_daily_trip_summary", "view_kpi_last_7_days", "view_yearly_fare_distribution",
    "daily_operations_summary", "bronze_profile", "drift_report", "drift_report_shifted", "drift_by_type",
    "silver_upsert", "weather_upsert", "gold_replace_partition", "layer_counts", "gold_documents", "doc_batches", "bm25_topk", "vector_topk", "hybrid_topk",
    "rag_messages", "eval_summary", "drift_alerts", "alert_parse",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs, limit = int(os.environ.get("BENCH_RUNS", "3")), float(os.environ.get("BENCH_SECONDS", "15"))
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session.build("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        timed(name)
        times = [timed(name)]
        while len(times) < runs and sum(times) + times[-1] < limit:
            times.append(timed(name))
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
