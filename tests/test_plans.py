"""Scale properties of the plans, asserted on the physical plan text."""

import datetime as dt
import re

from raw_events import BASE, raw_event

from playmetrics.operators.economy import extra_steps_economy_daily
from playmetrics.operators.funnels import level_funnel_daily
from playmetrics.plans.models import Models
from playmetrics.sources.raw_table import RawTable, frame_shards

D = dt.timedelta(days=1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _raw_table(spark, make_raw, tmp_dir):
    rows = [raw_event(user=f"u{i % 3}", at=BASE + (i % 3) * D + dt.timedelta(minutes=i),
                      name="level_start_quickplay", params={"board": ("string_value", "S")})
            for i in range(9)]
    days = [BASE.date() + i * D for i in range(3)]
    RawTable(spark, f"{tmp_dir}/raw").replace(frame_shards(make_raw(rows)), days)
    return days


def test_bounded_read_prunes_partitions_and_columns(spark, make_raw, tmp_dir):
    days = _raw_table(spark, make_raw, tmp_dir)
    raw = RawTable(spark, f"{tmp_dir}/raw").read(days[1], days[1])
    plan = _plan(raw.select("user_pseudo_id", "device.category"))
    assert "PartitionFilters: [isnotnull(shard_date" in plan
    assert "ReadSchema: struct<user_pseudo_id:string,device:struct<category:string>>" in plan


def test_mart_filters_reach_the_raw_scan_and_no_expand(spark, make_raw, tmp_dir):
    days = _raw_table(spark, make_raw, tmp_dir)
    m = Models(RawTable(spark, f"{tmp_dir}/raw").read(days[0], days[-1]))
    funnel = _plan(level_funnel_daily(m.staging))
    assert "StringStartsWith(event_name,level)" in funnel and "Expand" not in funnel
    economy = _plan(extra_steps_economy_daily(m.staging))
    assert "In(event_name" in economy and "Expand" not in economy


def test_retention_skips_dedup_and_sessions(spark, make_raw, tmp_dir):
    days = _raw_table(spark, make_raw, tmp_dir)
    m = Models(RawTable(spark, f"{tmp_dir}/raw").read(days[0], days[-1]))
    plan = _plan(m.retention_cohorts)
    assert "md5" not in plan and "Window" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_sessionization_broadcasts_only_the_bounded_hot_list(spark, make_raw, tmp_dir):
    days = _raw_table(spark, make_raw, tmp_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = Models(RawTable(spark, f"{tmp_dir}/raw").read(days[0], days[-1]))
        plan = _plan(m.sessionized)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    broadcasts = [line for line in plan.splitlines() if "BroadcastExchange" in line]
    # every broadcast is the hot-user list (keyed by the user struct): keys above a
    # ten-thousandth of all rows, so fewer than ten thousand without any limit
    assert broadcasts and all("struct<u:string>" in line for line in broadcasts)
    assert "* 10000)" in plan and "Limit" not in plan
    assert re.search(r"SortMergeJoin \[_uk#\d+, _bucket#\d+L?\]", plan)
