"""Benchmark: headline queries and one full build at $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is executed in full with the no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from playmetrics.plans.build import build  # noqa: E402
from playmetrics.plans.queries import all_queries  # noqa: E402
from playmetrics.session import build_session, scratch_path  # noqa: E402
from playmetrics.sources.fixture_events import read_fixture_raw  # noqa: E402
from playmetrics.sources.raw_table import frame_shards  # noqa: E402

HEADLINE = [
    "staging_events", "sessionized_events", "user_days", "dim_users", "daily_active_users",
    "retention_cohorts", "retention_by_grant", "level_funnel_daily", "economy_daily",
    "fct_events", "load_ledger", "stream_load",
]
# Untimed, over code paths that no timed query has to itself: parquet footers,
# JIT and codegen caches of scan, window, join and aggregate.
WARM_UP = ["extract_param_modes", "session_gaps", "first_last_value"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app_name="playmetrics-bench",
                          shuffle_partitions=int(cpus) * 2)
    qs = all_queries()
    for name in WARM_UP:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    raw = read_fixture_raw(spark, sf_dir)
    days = frame_shards(raw).days()
    # the fixture's random funnel breaks a declared rule, so the build must not block
    result = build(spark, raw, scratch_path(spark, "bench-marts"), days[0], days[-1],
                   block_on_errors=False)
    result.report.count()
    timings["full_build"] = round(time.perf_counter() - t0, 3)

    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
