"""Time the headline queries; prints one JSON line. Folder and cores: BENCH_SF_DIR, BENCH_CPUS."""

from __future__ import annotations

import json
import os
import time

from urlaudit.plans.queries import QUERIES
from urlaudit.session import build_session

HEADLINE = [
    "due_all",
    "unchecked_count",
    "resolved_status_summary",
    "resolved_poll",
    "robots_gate",
    "planned_schedule",
    "round_robin",
    "politeness_audit",
    "status_upsert",
    "history_rows",
    "throughput_per_100",
    "queue_contents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):  # the first run warms the JVM
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
