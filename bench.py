"""Times the headline queries and prints one JSON line.

Every query is run into the ``noop`` sink, as a user's job would write all its
rows, and run again when the first run was short, so that JVM warm-up does not
count; the better run is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidewatch.session import build_session
from tidewatch.suite import REGISTRY

HEADLINE = (
    "source_dashboard", "analyst_workload", "entity_correlation", "threat_density_timeseries", "geo_clusters",
    "audit_trail", "analyst_throughput", "entity_network", "source_reliability", "threat_density_anomaly",
    "hourly_threat_stats", "fingerprint_dedup", "upsert_parent", "snapshot_audit", "signal_normalize_job",
    "enrich_events_job", "chunk_dedup", "bm25_topk", "vector_topk", "hybrid_search_chunks", "hybrid_search_events",
    "window_features", "forecast", "refresh_hourly_stats", "stream_hourly_stats",
)

REPEAT_BELOW = 12.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or [k for k in HEADLINE if k in REGISTRY]
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if wanted == ["all"]:
        wanted = list(REGISTRY)
    times: dict[str, float] = {}
    for key in wanted:
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[key].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = round(time.perf_counter() - start, 3)
            times[key] = min(elapsed, times.get(key, elapsed))
            if elapsed > REPEAT_BELOW:
                break
        if os.environ.get("BENCH_VERBOSE"):
            print(key, times[key], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
