"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Every query runs over whole tables into a sink that discards its rows. It first runs once on the
smallest tables, so that class loading and code generation are not timed; then it is timed once,
planning and its own writes included. Lookups are also timed on tables that are there already.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from liftlab import session
from liftlab.operators import serving
from liftlab.queries import all_queries, inputs
from liftlab.session import local_session
from liftlab.sources import versions

HEADLINES = [
    "dedup_events", "typed_events", "expectation_report", "behavior_totals", "user_features",
    "experiment_results", "lift_table", "adopter_check", "event_distribution", "global_rank",
    "first_come_rank", "targeting_decile", "flag_top_k", "top_users", "recommendations", "mix",
    "concentration", "cohort_propensity", "roc_auc", "avg_precision", "cumulative_gains",
    "nudge_assemble", "pii_audit", "sessions_by_gap", "exposed_events", "trailing_features",
    "funnel", "clustered_export", "stream_ingest", "stream_refresh", "stream_sessions",
    "user_recommendations", "gbt_metrics", "serving_lookup", "top_users_product",
    "incremental_refresh", "stream_latest", "mergeable_totals", "asof_exposure", "funnel_window",
    "uplift_curve", "exact_split", "schema_drift",
]


def ready_lookups(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds of a lookup by key and of a top 5 by product, median of nine, on tables made before."""
    recs = session.written(inputs.nudged(spark, sf_dir).select(*serving.columns(inputs.PRODUCTS)), "bench-recs")
    serving.export_clustered(recs, "bench_serving", session.fresh_path(spark, "bench-serving"))
    ready = serving.export_ranked(recs, versions.Versions(spark, session.fresh_path(spark, "bench-ranked")), "recs")
    lookups = {"lookup_ready": lambda: serving.lookup(spark, "bench_serving", "user_id", 7).collect(),
               "top5_product_ready": lambda: serving.top_of_group(ready, "recs", "crypto", 5).collect()}
    seconds = {}
    for name, look in lookups.items():
        times = []
        for _ in range(9):
            start = time.perf_counter()
            look()
            times.append(time.perf_counter() - start)
        seconds[name] = round(sorted(times)[4], 4)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, shuffle_partitions=int(cores))
    queries = all_queries()
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {}
    for name in HEADLINES:
        if os.path.isdir(warm_dir):
            run(name, warm_dir)
        seconds[name] = run(name, sf_dir)
    seconds |= ready_lookups(spark, sf_dir)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
