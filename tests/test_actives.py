"""Distinct users from mergeable daily bitmaps."""

import datetime as dt

from pyspark.sql import functions as F
from raw_events import BASE, raw_event

from playmetrics.operators.actives import daily_bitmaps, distinct_users, numbered_users
from playmetrics.operators.staging import stage_events

D = dt.timedelta(days=1)


def test_numbers_are_dense_and_stay(spark):
    users = spark.range(1, 700).select(F.format_string("u%d", "id").alias("user_pseudo_id"))
    first = numbered_users(users.where("user_pseudo_id < 'u4'").union(users.limit(5)))
    known = {r[0]: r[1] for r in first.collect()}
    assert sorted(known.values()) == list(range(len(known)))
    more = {r[0]: r[1] for r in numbered_users(users, first).collect()}
    assert sorted(more.values()) == list(range(699))
    assert all(more[u] == n for u, n in known.items())


def test_periods_merge_days_without_counting_twice(spark, make_raw):
    rows = [raw_event(user=f"u{i % 50}", at=BASE + (i % 20) * D + dt.timedelta(seconds=i),
                      name=("spend_virtual_currency", "screen_view", "level_start_quickplay")[i % 3])
            for i in range(400)] + [raw_event(user=None)]
    events = stage_events(make_raw(rows))
    bitmaps = daily_bitmaps(events, numbered_users(events))
    for period in (F.date_trunc("week", "event_date"), F.lit(1), F.col("event_date")):
        name = F.col("event_name")
        want = events.groupBy(period.alias("period")).agg(
            F.count_distinct("user_pseudo_id"),
            F.count_distinct(F.when(name == "spend_virtual_currency", F.col("user_pseudo_id"))),
            F.count_distinct(F.when(name == "level_start_quickplay", F.col("user_pseudo_id"))))
        assert sorted(map(tuple, distinct_users(bitmaps, period).collect())) == sorted(
            map(tuple, want.collect()))
