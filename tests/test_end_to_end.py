"""Fault -> detection -> repair over a real build (sf0.001 fixture events)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from playmetrics.operators import quality as Q
from playmetrics.operators.diff import key_diff
from playmetrics.operators.masking import masked
from playmetrics.plans.build import build, read_mart, scheduled_run
from playmetrics.schema import MART_CONTRACTS
from playmetrics.session import checkpoint_dir
from playmetrics.sources.fixture_events import read_fixture_raw
from playmetrics.sources.ledger import Ledger
from playmetrics.sources.raw_table import RawTable, frame_shards

SMALL = "/root/testdata/sf0.001"
BAND = (1, 10_000)


def _report(result):
    return {r.check: r for r in result.report.collect()}


def _shards(spark):
    """Fixture shards without the funnel events, whose random counts break a declared rule."""
    return frame_shards(read_fixture_raw(spark, SMALL).where(
        ~F.col("event_name").like("level%quickplay")))


def assert_same_marts(spark, one, other):
    for name in MART_CONTRACTS:
        a, b = read_mart(spark, one, name), read_mart(spark, other, name)
        assert a.columns == b.columns, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_null_spike_detected_then_repaired(spark, tmp_dir):
    shards, table = _shards(spark), RawTable(spark, f"{tmp_dir}/raw")
    days = shards.days()
    table.replace(shards, days)
    first, last = days[0], days[-1]
    clean = build(spark, table.read(first, last), f"{tmp_dir}/clean", first, last, volume_band=BAND)
    assert _report(clean)["monitor:null_rate:platform"].status == "pass"

    bad_day = days[11]
    bad = masked(shards.read([bad_day]).drop("shard_date"), "platform", 0.35)
    table.replace(frame_shards(bad), [bad_day])
    marts = f"{tmp_dir}/marts"
    faulted = build(spark, table.read(first, last), marts, first, last, volume_band=BAND)
    found = _report(faulted)["monitor:null_rate:platform"]
    assert (found.status, found.failures) == ("warn", 1)

    table.replace(shards, [bad_day])
    repaired = build(spark, table.read(first, last), marts, first, last,
                     rebuild_start_date=bad_day, volume_band=BAND)
    assert _report(repaired)["monitor:null_rate:platform"].status == "pass"
    for name in ("fct_events", "dim_users", "daily_active_users", "retention_cohorts"):
        a, b = repaired.read(spark, name), clean.read(spark, name)
        assert a.exceptAll(b.select(*a.columns)).count() == 0, name
        assert b.select(*a.columns).exceptAll(a).count() == 0, name
    (diff,) = key_diff(repaired.read(spark, "fct_events"), clean.read(spark, "fct_events"),
                       "event_pk").collect()
    assert diff.only_in_a == 0 and diff.only_in_b == 0 and diff.a_rows == diff.b_rows


def test_a_failing_error_check_keeps_the_old_marts(spark, tmp_dir):
    shards, marts = _shards(spark), f"{tmp_dir}/marts"
    days = shards.days()
    raw = shards.read(days).drop("shard_date")
    build(spark, raw, marts, days[0], days[-1], volume_band=BAND)
    kept = {name: read_mart(spark, marts, name).collect() for name in MART_CONTRACTS}
    # the window ends too early, so the fact table breaks the declared range
    with pytest.raises(Q.QualityError, match="event_date within the loaded days"):
        build(spark, raw.where(F.col("event_name") != "app_remove"), marts, days[0], days[-3],
              volume_band=BAND)
    for name, rows in kept.items():
        assert sorted(map(str, read_mart(spark, marts, name).collect())) == sorted(
            map(str, rows)), name
    report = {r.check: r.status for r in spark.read.parquet(f"{marts}/_checks").collect()}
    assert report["expression:fct_events:event_date within the loaded days"] == "fail"
    # without blocking the same build is published; a warning never blocks
    out = build(spark, raw, marts, days[0], days[-3], volume_band=(1, 2), block_on_errors=False)
    assert _report(out)["monitor:daily_volume"].status == "warn"


def test_a_stale_load_blocks_and_a_late_one_warns(spark, tmp_dir):
    shards = _shards(spark)
    days = shards.days()
    raw = shards.read(days).drop("shard_date")
    at = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    loaded = spark.createDataFrame([(at,)], "loaded_at timestamp")
    late = build(spark, raw, f"{tmp_dir}/m", days[0], days[-1], volume_band=BAND, loaded=loaded,
                 as_of=at + dt.timedelta(hours=30))
    assert _report(late)["freshness:raw:late"].status == "warn"
    with pytest.raises(Q.QualityError, match="freshness:raw:stale"):
        build(spark, raw, f"{tmp_dir}/m", days[0], days[-1], volume_band=BAND, loaded=loaded,
              as_of=at + dt.timedelta(hours=60))


def test_a_build_leaves_no_scratch_tables(spark, tmp_dir):
    shards = _shards(spark)
    days = shards.days()
    root = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    build(spark, shards.read(days).drop("shard_date"), f"{tmp_dir}/m", days[0], days[-1],
          volume_band=BAND)
    assert set(os.listdir(root)) == before


def test_monitors_fire_on_their_faults(spark, make_raw):
    from raw_events import BASE, raw_event
    rows = [raw_event(user=f"u{i}", at=BASE + dt.timedelta(minutes=i), name=f"e{i}")
            for i in range(10)]
    raw = make_raw(rows + rows[:4])                       # four re-delivered events
    from playmetrics.operators.staging import stage_events
    stg = stage_events(raw)
    assert Q.daily_volume(stg, 5, 20).count() == 0
    assert Q.daily_volume(raw.withColumn("event_date", F.to_date("event_date", "yyyyMMdd")),
                          5, 12).count() == 1
    (d,) = Q.duplicate_ratio(raw, stg).collect()
    assert (d.raw_rows, d.staged_rows) == (14, 10)
    newest = stg.agg(F.max("event_at").alias("loaded_at"))
    statuses = [Q.freshness(newest, BASE + dt.timedelta(hours=h)).collect()[0].status
                for h in (1, 30, 60)]
    assert statuses == ["pass", "warn", "error"]


def test_scheduled_runs_grow_the_marts_day_by_day(spark, tmp_dir):
    shards, table = _shards(spark), RawTable(spark, f"{tmp_dir}/raw")
    ledger, marts = Ledger(spark, f"{tmp_dir}/ledger"), f"{tmp_dir}/marts"
    ledger.begin(shards.days()[0])
    first = scheduled_run(spark, shards, table, ledger, marts, 28, volume_band=BAND)
    days_1 = first.read(spark, "daily_active_users").count()
    second = scheduled_run(spark, shards, table, ledger, marts, None, volume_band=BAND)
    assert (days_1, second.read(spark, "daily_active_users").count()) == (28, 30)
    assert _report(second)["freshness:raw:stale"].status == "pass"
    fct = second.read(spark, "fct_events")
    assert fct.select("event_date").distinct().count() == 30
    assert scheduled_run(spark, shards, table, ledger, marts, None) is None


def test_daily_builds_equal_a_full_one_and_read_only_recent_days(spark, tmp_dir, monkeypatch):
    from playmetrics.plans import build as module
    shards, table = _shards(spark), RawTable(spark, f"{tmp_dir}/raw")
    ledger, marts = Ledger(spark, f"{tmp_dir}/ledger"), f"{tmp_dir}/marts"
    days = shards.days()
    ledger.begin(days[0])
    scheduled_run(spark, shards, table, ledger, marts, 26, volume_band=BAND)
    seen = []
    recent_rows = module.recent_rows

    def watched(raw, since):
        seen.append(since)
        return recent_rows(raw, since)

    monkeypatch.setattr(module, "recent_rows", watched)
    for _ in range(2):
        scheduled_run(spark, shards, table, ledger, marts, 2, volume_band=BAND)
    assert set(seen) == {days[24], days[26]}
    plan = recent_rows(table.read(days[0], days[-1]), days[26])._jdf.queryExecution()
    assert "GreaterThanOrEqual(event_timestamp" in plan.executedPlan().toString()
    full = build(spark, table.read(days[0], days[-1]), f"{tmp_dir}/full", days[0], days[-1],
                 volume_band=BAND)
    assert_same_marts(spark, marts, full.out)


def test_odd_new_events_make_the_build_a_full_one(spark, tmp_dir, make_raw):
    from raw_events import BASE, raw_event
    from playmetrics.plans.build import first_day_touched
    day = dt.timedelta(days=1)
    raw = make_raw([raw_event(user="u", at=BASE + k * day, name=f"e{k}") for k in range(4)])
    table, out = RawTable(spark, f"{tmp_dir}/raw"), f"{tmp_dir}/m"
    first = BASE.date()
    table.replace(frame_shards(raw), [first, first + day, first + 2 * day])
    build(spark, table.read(first, first + 2 * day), out, first, first + 2 * day, volume_band=BAND)
    new = [first + 3 * day]

    def touched(*rows):
        table.replace(frame_shards(make_raw(list(rows)), F.lit(new[0])), new)
        return first_day_touched(spark, table.read(first, new[0]), out, new)

    assert touched(raw_event(user="u", at=BASE + 3 * day)) == first + day
    assert touched(raw_event(user="u", at=BASE, name="late")) == first
    assert touched(raw_event(user="u", at=None)) is None
    assert touched(raw_event(user="u", at=BASE + 3 * day, event_date=f"{BASE:%Y%m%d}")) is None
    assert first_day_touched(spark, table.read(first, new[0]), f"{tmp_dir}/none", new) is None
