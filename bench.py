"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_RUNS (default 3). Each
query is run once to warm up, then BENCH_RUNS times; the median counts. Results go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oreflow_checks.queries import QUERIES  # noqa: E402
from oreflow.session import build_session  # noqa: E402

HEADLINE = [
    "scd1_apply_changes", "scd1_incremental", "scd1_overlay", "scd1_stored", "scd1_bucketed", "scd1_stream",
    "change_feed_diff", "merge_change_feed", "scd1_soft_delete",
    "ingest_incremental", "bronze_flow", "silver_flow", "ingest_date_window", "allowlist_semi_join",
    "dedup_row_number", "append_schema_merge", "partitioned_roundtrip", "dq_metrics", "dq_quarantine", "val_checks",
    "latest_status", "mon_failures", "mon_anomalies", "mon_sla", "mon_success_rate", "mon_freshness", "mon_alerts",
    "mon_history_row", "weekly_review", "spec_flatten", "lineage_edges",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
