"""Print the scale-relevant shape of each model's physical plan.

Run with AQE and automatic broadcast off so the plan is the one a large input
gets (no size-based broadcast of small test data): exchanges, joins, windows,
aggregates, and what reaches each Parquet scan.

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playmetrics.plans.models import Models  # noqa: E402
from playmetrics.session import build_session, scratch_path  # noqa: E402
from playmetrics.sources.fixture_events import read_fixture_raw  # noqa: E402
from playmetrics.sources.raw_table import RawTable, frame_shards  # noqa: E402

KEEP = ("Exchange", "Join", "Window", "HashAggregate", "SortAggregate", "Scan", "Expand",
        "TakeOrdered", "ReusedExchange", "Subquery")


def shape(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if "FileScan" in line:
            keep = [m.group(0)[:160] for key in ("PartitionFilters", "PushedFilters", "ReadSchema")
                    for m in [re.search(key + r": (\[[^\]]*\]|struct<[^ ]*)", line)] if m]
            line = line[:line.index("FileScan") + 20] + " " + " ".join(keep)
        out.append(line[:220])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=200)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shards = frame_shards(read_fixture_raw(spark, sf_dir))
    table = RawTable(spark, scratch_path(spark, "raw"))
    days = shards.days()
    table.replace(shards, days)
    m = Models(table.read(days[0], days[-1]))
    print("# Physical plan shapes (AQE and auto-broadcast off: the large-input plan)\n")
    for name in ("staging", "sessionized", "int_user_days", "dim_users", "daily_active_users",
                 "retention_cohorts", "retention_by_extra_steps_grant", "level_funnel_daily",
                 "extra_steps_economy_daily"):
        print(f"## {name}\n\n```")
        print("\n".join(shape(getattr(m, name))))
        print("```\n")


if __name__ == "__main__":
    main()
