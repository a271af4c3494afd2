import datetime as dt
import os

import pytest
from raw_events import BASE, raw_event
from pyspark.sql import functions as F

from playmetrics.operators import quality as Q
from playmetrics.operators.masking import masked_copy
from playmetrics.operators.staging import stage_events
from playmetrics.plans.models import Models
from playmetrics.plans.sinks import ContractError, write_contracted, write_incremental
from playmetrics.schema import DIM_USERS, FCT_EVENTS
from playmetrics.sources import files
from playmetrics.sources.ledger import DayLoad, Ledger, LedgerState
from playmetrics.sources.raw_table import (
    RawTable,
    folder_shards,
    frame_shards,
    load_pending,
    reload_day,
)

D = dt.timedelta(days=1)
DAY0 = BASE.date()


def _shards(make_raw, days=4, per_day=5):
    rows = [raw_event(user=f"u{i % 3}", at=BASE + d * D + dt.timedelta(minutes=40 * i),
                      name=f"e{i}", platform="IOS" if i % 2 else "ANDROID")
            for d in range(days) for i in range(per_day)]
    return frame_shards(make_raw(rows))


def _counts(table):
    df = table.read(DAY0 - 9 * D, DAY0 + 9 * D)
    return {(r.shard_date - DAY0).days: r["count"] for r in df.groupBy("shard_date").count().collect()}


def test_pending_days_are_those_offered_and_not_loaded():
    state = LedgerState(DAY0 + D, {DAY0 + 2 * D: DayLoad(DAY0 + 2 * D, 1, 1)})
    assert state.pending([DAY0 + k * D for k in (3, 0, 1, 2, 3)]) == [DAY0 + D, DAY0 + 3 * D]
    assert state.last_day == DAY0 + 2 * D
    with pytest.raises(RuntimeError):
        LedgerState(DAY0).last_day  # noqa: B018


def test_loads_are_repeatable_counted_and_complete(spark, make_raw, tmp_dir):
    shards, table = _shards(make_raw), RawTable(spark, f"{tmp_dir}/raw")
    ledger = Ledger(spark, f"{tmp_dir}/ledger")
    with pytest.raises(RuntimeError):
        load_pending(table, shards, ledger)
    ledger.begin(DAY0)
    assert [x.day for x in load_pending(table, shards, ledger, 2)] == [DAY0, DAY0 + D]
    assert ledger.state().loads[DAY0].num_rows == 5 and ledger.state().loads[DAY0].num_bytes > 0
    assert reload_day(table, shards, ledger, DAY0).num_rows == 5
    assert _counts(table) == {0: 5, 1: 5}
    assert [x.num_rows for x in table.append(shards, [DAY0])] == [10]
    assert stage_events(table.read(DAY0, DAY0 + D)).count() == 10
    assert [x.day for x in load_pending(table, shards, ledger, 9)] == [DAY0 + 2 * D, DAY0 + 3 * D]
    before = os.listdir(ledger.path)
    assert load_pending(table, shards, ledger) == [] and os.listdir(ledger.path) == before
    ledger.begin(DAY0 + 2 * D)  # start over: only days from there on are wanted
    assert [x.day for x in load_pending(table, shards, ledger, None)] == [DAY0 + 2 * D, DAY0 + 3 * D]


def test_the_newest_entry_wins_by_version_not_by_clock(spark, tmp_dir, monkeypatch):
    from playmetrics.sources import ledger as module
    ledger = Ledger(spark, f"{tmp_dir}/ledger")
    ledger.begin(DAY0)
    ledger.record([DayLoad(DAY0, 1, 1)])

    long_ago = dt.datetime(2001, 1, 1, tzinfo=dt.timezone.utc)

    class Slow(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            return long_ago

    monkeypatch.setattr(module.dt, "datetime", Slow)
    ledger.record([DayLoad(DAY0, 7, 7)])
    assert ledger.state().loads[DAY0].num_rows == 7


def test_rows_dated_otherwise_stay_in_their_shard(spark, make_raw, tmp_dir):
    rows = [raw_event(user=f"u{i}", at=BASE, name=f"a{i}") for i in range(5)]
    next_day = [raw_event(user="s", at=BASE + D, name="stray", event_date=f"{BASE:%Y%m%d}"),
                raw_event(user="t", at=BASE + D, name="true")]
    raw = make_raw(rows + next_day)
    undated = make_raw([raw_event(user="n", at=BASE + D, name="none")]).withColumn(
        "event_date", F.lit(None).cast("string"))
    shards = frame_shards(raw.union(undated), F.to_date(F.timestamp_micros("event_timestamp")))
    table = RawTable(spark, f"{tmp_dir}/raw")
    table.replace(shards, [DAY0])
    table.replace(shards, [DAY0 + D])
    assert _counts(table) == {0: 5, 1: 3}
    undated_rows = table.read(DAY0, DAY0 + D).where("event_date is null")
    assert undated_rows.count() == 1
    assert Q.not_null(stage_events(table.read(DAY0, DAY0 + D)), "event_date").count() == 1
    with pytest.raises(ValueError, match="no shard day"):
        frame_shards(undated, F.to_date("event_date", "yyyyMMdd")).days()


def test_a_shard_that_became_empty_empties_its_day(spark, make_raw, tmp_dir):
    raw = make_raw([raw_event(at=BASE), raw_event(at=BASE + D)])
    table = RawTable(spark, f"{tmp_dir}/raw")
    table.replace(frame_shards(raw), [DAY0, DAY0 + D])
    loads = table.replace(frame_shards(raw.where(F.col("event_date") > f"{BASE:%Y%m%d}")), [DAY0])
    assert loads == [DayLoad(DAY0, 0, 0)] and _counts(table) == {1: 1}


def test_folder_shards_and_narrow_old_days(spark, make_raw, tmp_dir):
    for i in range(3):
        day = BASE + i * D
        # a stray date inside the shard, and a first day without the late-added columns
        rows = [raw_event(user=f"u{j}", at=day, event_date=f"{BASE:%Y%m%d}") for j in range(i + 1)]
        df = make_raw(rows)
        df = df.drop("event_dimensions", "platform", "stream_id") if i == 0 else df
        df.write.parquet(f"{tmp_dir}/shards/events_{day:%Y%m%d}")
    os.mkdir(f"{tmp_dir}/shards/notes")
    shards = folder_shards(spark, f"{tmp_dir}/shards")
    days = [DAY0 + i * D for i in range(3)]
    assert shards.days() == days
    table = RawTable(spark, f"{tmp_dir}/raw")
    assert [x.num_rows for x in table.replace(shards, days)] == [1, 2, 3]
    assert table.days() == days
    wide = table.read(DAY0, DAY0 + 2 * D)
    assert {(r.shard_date, r.platform is None) for r in wide.collect()} == {
        (days[0], True), (days[1], False), (days[2], False)}
    (newest,) = table.last_modified(days[0], days[-1]).collect()
    aged = Q.freshness(table.last_modified(days[0], days[-1]),
                       newest.loaded_at + dt.timedelta(hours=27))
    assert aged.first().status == "warn"


def test_refused_reads_and_reloads(spark, make_raw, tmp_dir):
    table = RawTable(spark, f"{tmp_dir}/raw")
    with pytest.raises(ValueError):
        table.read(None, DAY0)
    with pytest.raises(ValueError):
        reload_day(table, _shards(make_raw), Ledger(spark, f"{tmp_dir}/ledger"), DAY0 + 9 * D)
    assert not os.path.exists(f"{tmp_dir}/raw")


def test_storage_errors_are_not_read_as_absence(spark):
    with pytest.raises(Exception):
        files.exists(spark, "nosuchscheme://host/path")


def test_contract_rejects_extra_missing_or_retyped_columns(spark, make_raw, tmp_dir):
    users = Models(make_raw([raw_event()])).dim_users
    for bad in (users.withColumn("extra", F.lit(1)), users.drop("platform"),
                users.withColumn("num_events", F.col("num_events").cast("int"))):
        with pytest.raises(ContractError):
            write_contracted(bad, DIM_USERS, f"{tmp_dir}/dim", "dim_users")
    assert not os.path.exists(f"{tmp_dir}/dim")
    write_contracted(users, DIM_USERS, f"{tmp_dir}/dim", "dim_users")
    assert spark.read.parquet(f"{tmp_dir}/dim").count() == 1


def test_masked_copy_is_seen_by_the_monitor_and_spares_the_table(spark, make_raw, tmp_dir):
    shards, table = _shards(make_raw, days=3, per_day=40), RawTable(spark, f"{tmp_dir}/raw")
    days = shards.days()
    table.replace(shards, days)
    last = F.col("shard_date") == F.lit(days[-1])
    masked_copy(table.read(days[0], days[-1]), f"{tmp_dir}/copy", "platform", 0.35, where=last)
    flagged = Q.null_rate(stage_events(RawTable(spark, f"{tmp_dir}/copy").read(days[0], days[-1])),
                          "platform", 0.01).collect()
    assert [r.event_date for r in flagged] == [days[-1]] and 0 < flagged[0].null_rate < 1
    assert Q.null_rate(stage_events(table.read(days[0], days[-1])), "platform", 0.01).count() == 0


def test_incremental_fact_after_repair_equals_full_build(spark, make_raw, tmp_dir):
    good = _shards(make_raw, days=4, per_day=6)
    days, table, fct_path = good.days(), RawTable(spark, f"{tmp_dir}/raw"), f"{tmp_dir}/fct"
    table.replace(good, days)
    bad = frame_shards(table.read(days[1], days[1]).drop("shard_date").withColumn(
        "platform", F.lit(None).cast("string")).checkpoint())
    table.replace(bad, [days[1]])
    write_incremental(spark, Models(table.read(days[0], days[-1])).fct_events, FCT_EVENTS, fct_path)
    untouched = spark.read.parquet(fct_path).where(F.col("event_date") == DAY0).collect()
    table.replace(good, [days[1]])
    m = Models(table.read(days[0], days[-1]))
    write_incremental(spark, m.fct_events, FCT_EVENTS, fct_path, rebuild_start_date=days[1])
    got = spark.read.parquet(fct_path).select(*FCT_EVENTS.fieldNames())
    full = m.fct_events.select(*FCT_EVENTS.fieldNames())
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert sorted(spark.read.parquet(fct_path).where(F.col("event_date") == DAY0).collect()) \
        == sorted(untouched)
