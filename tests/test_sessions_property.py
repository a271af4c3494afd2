"""Property: the two-level sessionization equals the single-window definition
for any gaps, bucket widths and hot-user choice."""

import datetime as dt

from raw_events import BASE, raw_event
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plain_forms import sessionize_single_window

from playmetrics.operators.sessions import sessionize
from playmetrics.operators.staging import stage_events

GAPS = st.sampled_from([0, 1, 59, 60, 1799, 1800, 1801, 3600, 86_399, 86_400, 90_000])
USERS = st.lists(st.lists(GAPS, min_size=1, max_size=25), min_size=1, max_size=4)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(users=USERS, bucket=st.sampled_from([60, 3600, 86_400]),
       micro=st.integers(0, 999_999), hot_first=st.booleans())
def test_two_level_matches_single_window(spark, make_raw, users, bucket, micro, hot_first):
    rows = []
    for u, gaps in enumerate(users):
        t = BASE + dt.timedelta(microseconds=micro)
        for i, g in enumerate(gaps):
            t = t + dt.timedelta(seconds=g)
            rows.append(raw_event(user=f"u{u}", at=t, name=f"n{i}"))
    raw = make_raw(rows)
    stg = stage_events(raw)
    cols = ["event_pk", "session_number", "is_session_first_event",
            "seconds_since_previous_event", "session_id"]
    ref = sessionize_single_window(stg).select(cols)
    hot = raw.select("user_pseudo_id").where("user_pseudo_id = 'u0'") if hot_first else None
    got = sessionize(stg, bucket_seconds=bucket, hot_users=hot, hot_bucket_seconds=60,
                     timeline=raw.selectExpr("user_pseudo_id",
                                             "timestamp_micros(event_timestamp) AS event_at",
                                             "cast(null as string) AS event_pk"))
    got = got.select(cols)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
