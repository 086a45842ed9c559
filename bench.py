"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's full plan is executed into Spark's ``noop`` sink (every row
computed, nothing collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import signal
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "risk_tier_summary", "panel_scan", "feature_table", "feature_table_chunked", "impute_ffill_bfill",
    "entity_profile",
    "sliding_windows", "window_summary", "exp_smoothing_forecast", "linear_extrapolation_alerts",
    "kmeans_assign_fixed", "segment_ranking_lookup", "value_distribution", "scaler_stats",
    "correlation_matrix", "ordered_split", "balanced_sample", "auroc_whole_panel",
    "classifier_leaderboard", "forecast_leaderboard", "frequent_itemsets", "rules_with_fallback",
    "knn_lookalikes", "knn_join_all", "neighbour_vote", "quality_gates", "stream_rolling_features", "regressor_fits",
]

# Seconds after which one query is cancelled, and after which no other is begun.
QUERY_SECONDS, TOTAL_SECONDS = 240, 1200


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from panelkit.config import local_session
    from panelkit.plans.catalog import all_queries

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    reg = all_queries()
    # warm-up: JVM, parquet footers, codegen caches
    reg["panel_scan"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    started = time.monotonic()

    def report(*_) -> None:
        m = re.search(r"sf([0-9.]+)", sf_dir)
        print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                          "queries": times, "failed": failed, "sf": float(m.group(1)) if m else sf_dir,
                          "cpus": cpus}), flush=True)

    def stopped(*_) -> None:
        report()
        os._exit(0)

    signal.signal(signal.SIGTERM, stopped)
    for name in names:
        # a query that takes too long is cancelled and named; the others are still measured
        left = min(QUERY_SECONDS, TOTAL_SECONDS - (time.monotonic() - started))
        if left <= 0:
            failed[name] = "no time left"
            continue
        spark.sparkContext.setJobGroup(name, name, interruptOnCancel=True)
        timer = threading.Timer(left, spark.sparkContext.cancelAllJobs)
        timer.start()
        t0 = time.perf_counter()
        try:
            reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - one query must not cost the figures of the rest
            failed[name] = f"{time.perf_counter() - t0:.0f} s: {type(e).__name__}"
        finally:
            timer.cancel()
            spark.catalog.clearCache()
        print(f"{name}: {times.get(name, failed.get(name))}", file=sys.stderr, flush=True)
    report()


if __name__ == "__main__":
    main()
