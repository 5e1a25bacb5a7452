"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default /root/testdata/sf0.1), ``BENCH_CPUS`` the
number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402
from checks.queries import queries  # noqa: E402

HEADLINE = (
    "log_scan",
    "dedup_events",
    "first_seen_flags",
    "features_1h",
    "features_24h",
    "features_all",
    "rolling_activity",
    "curated_events",
    "wide_events",
    "user_behavior_hourly",
    "host_popularity_daily",
    "high_risk_users",
    "risky_hosts",
    "events_per_minute",
    "unique_users_per_hour",
    "lateral_movement_windows",
    "new_device_alerts",
    "data_freshness",
    "high_risk_with_behavior",
    "kpi_sla_violations",
    "kpi_low_volume_alarm",
    "dq_curated",
    "stream_first_seen",
    "stream_features",
    "stream_curated",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    known = queries()
    wanted = sys.argv[1:] or HEADLINE
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    known["volume_per_day"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in wanted:
        began = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - began, 3)
        print(name, timings[name], file=sys.stderr, flush=True)

    rate = {n: round(events / t) for n, t in timings.items() if n.startswith(("stream_", "curated_"))}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": events,
                "events_per_sec": rate,
            }
        )
    )


if __name__ == "__main__":
    main()
