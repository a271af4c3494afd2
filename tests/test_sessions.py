import datetime as dt
import random

import pytest
from raw_events import BASE, raw_event
from pyspark.sql import functions as F

from plain_forms import sessionize_single_window

from playmetrics.operators.sessions import hot_keys, sessionize
from playmetrics.operators.staging import stage_events
from playmetrics.operators.user_days import user_days
from playmetrics.plans.models import Models

S = dt.timedelta(seconds=1)


def _sessions(spark, make_raw, rows, **kw):
    m = Models(make_raw(rows), **kw)
    return m.sessionized.orderBy("event_at", "event_pk").collect()


def test_gap_boundaries(spark, make_raw):
    # gaps of 1799, 1800, 1800.9 s continue the session; 1801 s starts a new one
    t = [BASE, BASE + 1799 * S, BASE + 3599 * S, BASE + 3599 * S + 1800.9 * S,
         BASE + 3599 * S + 1800.9 * S + 1801 * S]
    rows = [raw_event(at=x, name=f"e{i}") for i, x in enumerate(t)]
    out = _sessions(spark, make_raw, rows)
    assert [r.seconds_since_previous_event for r in out] == [None, 1799, 1800, 1800, 1801]
    assert [r.session_number for r in out] == [1, 1, 1, 1, 2]
    assert [r.is_session_first_event for r in out] == [True, False, False, False, True]


def test_same_instant_is_one_session(spark, make_raw):
    rows = [raw_event(at=BASE, name="a"), raw_event(at=BASE, name="b")]
    out = _sessions(spark, make_raw, rows)
    assert [r.session_number for r in out] == [1, 1]
    assert [r.seconds_since_previous_event for r in out] == [None, 0]


def test_midnight_session_counts_on_both_days(spark, make_raw):
    start = dt.datetime(2024, 3, 10, 23, 50, tzinfo=dt.timezone.utc)
    rows = [raw_event(at=start + i * 5 * 60 * S, name=f"e{i}") for i in range(5)]
    m = Models(make_raw(rows))
    assert m.sessionized.select("session_id").distinct().count() == 1
    days = m.int_user_days.orderBy("event_date").collect()
    assert [d.num_sessions for d in days] == [1, 1]


def test_two_level_equals_single_window_with_hot_users(spark, make_raw):
    rng = random.Random(7)
    rows = []
    for u in range(6):
        t = BASE
        n = 400 if u == 0 else 30          # user 0 is "hot"
        for i in range(n):
            t = t + rng.choice([1, 60, 1800, 1801, 4000, 40000, 90000]) * S
            rows.append(raw_event(user=f"u{u}", at=t, name=f"n{i % 3}"))
    rows.append(raw_event(user="u1", at=None, name="untimed"))
    rows.append(raw_event(user="u1", at=None, name="untimed"))        # same content: one event
    rows.append(raw_event(user="u1", at=None, name="untimed2"))
    # events without a user form one group of their own, as in a window partition
    rows += [raw_event(user=None, at=BASE + i * 1000 * S, name=f"anon{i}") for i in range(6)]
    raw = make_raw(rows)
    stg = stage_events(raw)
    cols = ["event_pk", "session_number", "is_session_first_event",
            "seconds_since_previous_event", "session_id"]
    ref = sessionize_single_window(stg).select(cols)
    for kw in ({}, {"bucket_seconds": 3600}):
        got = sessionize(stg, **kw).select(cols)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    assert sessionize(stg).where("user_pseudo_id IS NULL").count() == 6
    hot = hot_keys(raw, share=3)
    assert [r.user_pseudo_id for r in hot.collect()] == ["u0"]
    got = Models(raw, hot_share=3).sessionized.select(cols)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_user_day_minutes_null_without_engagement(spark, make_raw):
    rows = [raw_event(at=BASE, name="screen_view"),
            raw_event(at=BASE + 60 * S, name="user_engagement",
                      params={"engagement_time_msec": ("int_value", 90000)}),
            raw_event(user="u2", at=BASE, name="screen_view")]
    ud = {r.user_pseudo_id: r for r in user_days(Models(make_raw(rows)).sessionized).collect()}
    assert ud["u1"].engagement_minutes == 1.5
    assert ud["u2"].engagement_minutes is None
    assert ud["u1"].num_events == 2 and ud["u1"].num_sessions == 1


def test_session_counts_from_summary_match_numbering(spark, make_raw):
    rng = random.Random(11)
    rows = []
    for u in range(5):
        t = BASE
        for i in range(60 if u else 300):
            t = t + rng.choice([0, 30, 1800, 1801, 7200, 90000]) * S
            rows.append(raw_event(user=f"u{u}", at=t, name=f"n{i % 4}"))
    rows.append(raw_event(user="u2", at=None, name="untimed"))
    raw = make_raw(rows)
    lazy = Models(raw, hot_share=3)
    via_counts = lazy.dim_users                     # session counts from the summary
    via_numbers = Models(None, sessionized=lazy.sessionized).dim_users
    assert via_counts.exceptAll(via_numbers).count() == 0
    assert via_numbers.exceptAll(via_counts).count() == 0
    assert via_counts.count() == 5


def test_many_untimed_events_of_one_user_spread_over_buckets(spark, make_raw):
    from playmetrics.operators.sessions import time_buckets
    raw = make_raw([raw_event(user="u1", at=None, name=f"e{i}") for i in range(300)]
                   + [raw_event(user="u1", at=BASE + i * S, name=f"t{i}") for i in range(5)])
    stg = stage_events(raw)
    assert time_buckets(stg, 86_400, None, 60).select("_bucket").distinct().count() > 100
    cols = ["event_pk", "session_number", "is_session_first_event", "seconds_since_previous_event"]
    got, ref = Models(raw).sessionized.select(cols), sessionize_single_window(stg).select(cols)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_a_missing_summary_bucket_is_an_error(spark, make_raw):
    raw = make_raw([raw_event(at=BASE), raw_event(at=BASE + dt.timedelta(days=2), name="b")])
    stg = stage_events(raw)
    with pytest.raises(Exception, match="missing from the session summary"):
        sessionize(stg, timeline=stg.where(F.col("event_name") != "b")).collect()
