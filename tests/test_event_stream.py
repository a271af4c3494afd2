"""Streams of deduplicated events and sessions against the batch models."""

import datetime as dt

from pyspark.sql import functions as F
from raw_events import BASE, raw_event

from playmetrics.operators.staging import stage_events
from playmetrics.plans.models import Models
from playmetrics.sources.batch_table import BatchTable
from playmetrics.streaming.event_stream import load_sessions, load_staged_events, numbered

S, D = dt.timedelta(seconds=1), dt.timedelta(days=1)


def land(make_raw, landing, rows, day=0):
    make_raw(rows).coalesce(1).write.mode("append").parquet(
        f"{landing}/events_{BASE + day * D:%Y%m%d}")


def places(tmp_dir):
    return f"{tmp_dir}/landing", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"


def boundary_rows():
    """Gaps of 1799, 1800, 1800.9, 1800.999999 and 1801 s, one user each; a pause follows."""
    rows = []
    for i, gap in enumerate([1799, 1800, 1800.9, 1800.999999, 1801]):
        for at in (BASE, BASE + dt.timedelta(microseconds=round(gap * 1_000_000))):
            rows.append(raw_event(user=f"u{i}", at=at, name="screen_view"))
    return rows + [raw_event(user="end", at=BASE + 5 * D)]


def test_sessions_equal_the_batch_model_at_the_boundary(spark, make_raw, tmp_dir):
    landing, out, ckpt = places(tmp_dir)
    rows = boundary_rows()
    land(make_raw, landing, rows)
    got = numbered(load_sessions(spark, landing, out, ckpt, delay="1 day"))
    batch = Models(make_raw(rows)).sessionized.where("user_pseudo_id <> 'end'").groupBy(
        "user_pseudo_id", "session_number", "session_id").agg(
        F.min("event_at").alias("started_at"), F.max("event_at").alias("ended_at"),
        F.count(F.lit(1)).alias("num_events"))
    assert sorted(got.select(batch.columns).collect()) == sorted(batch.collect())
    assert sorted(r.num_events for r in got.collect()) == [1, 1, 2, 2, 2, 2]


def test_a_session_over_several_batches_and_runs(spark, make_raw, tmp_dir):
    landing, out, ckpt = places(tmp_dir)
    for part in range(3):
        land(make_raw, landing, [raw_event(at=BASE + (part * 1000 + i) * S) for i in range(0, 900, 300)])
        assert load_sessions(spark, landing, out, ckpt, delay="1 hour").count() == 0  # still open
    land(make_raw, landing, [raw_event(user="end", at=BASE + 2 * D)])
    (one,) = load_sessions(spark, landing, out, ckpt, delay="1 hour").collect()
    assert (one.num_events, one.ended_at - one.started_at) == (9, 2600 * S)


def test_late_rows_are_counted(spark, make_raw, tmp_dir):
    landing, out, ckpt = places(tmp_dir)
    land(make_raw, landing, [raw_event(at=BASE + 3 * D)], 3)
    load_staged_events(spark, landing, out, ckpt, delay="1 day")
    assert BatchTable(spark, out).late_rows() == 0
    land(make_raw, landing, [raw_event(at=BASE), raw_event(user="b", at=BASE)])  # too late
    land(make_raw, landing, [raw_event(user="c", at=BASE + 2.5 * D)], 2)         # in time
    staged = load_staged_events(spark, landing, out, ckpt, delay="1 day")
    assert sorted(r.user_pseudo_id for r in staged.collect()) == ["c", "u1"]
    assert BatchTable(spark, out).late_rows() == 2


def test_redeliveries_in_other_batches_collapse(spark, make_raw, tmp_dir):
    landing, out, ckpt = places(tmp_dir)
    first = [raw_event(at=BASE + i * S, name=n) for i, n in enumerate("abcabc")]
    first += [raw_event(at=None, name="untimed")]
    land(make_raw, landing, first)
    land(make_raw, landing, first[:2] + [raw_event(at=BASE, name="a", offset=9)])
    load_staged_events(spark, landing, out, ckpt, files_per_batch=1)
    land(make_raw, landing, first + [raw_event(at=BASE + S, name="new")])
    staged = load_staged_events(spark, landing, out, ckpt)
    every = make_raw(first + [raw_event(at=BASE + S, name="new")])
    batch = stage_events(every)
    assert sorted(r.event_pk for r in staged.collect()) == sorted(
        r.event_pk for r in batch.collect())
    assert BatchTable(spark, out).late_rows() == 0


def test_a_repeated_batch_adds_nothing(spark, make_raw, tmp_dir):
    table = BatchTable(spark, f"{tmp_dir}/table")
    rows = spark.range(5).toDF("n")
    assert table.read(rows.schema).count() == 0
    table.write(rows, 0)
    table.write(rows, 1)
    table.write(rows, 1)                                         # after its entry: no effect
    rows.write.parquet(f"{table.path}/batch=2")                  # a crash before the entry
    assert table.read(rows.schema).count() == 10
    table.write(rows, 2)                                         # the repeat replaces it
    assert table.read(rows.schema).count() == 15
    assert {(r.batch, r.num_rows) for r in table.ledger.batches().collect()} == {
        (0, 5), (1, 5), (2, 5)}
