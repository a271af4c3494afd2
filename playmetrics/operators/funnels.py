"""Level funnel per day and quickplay board."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.functions.params import surrogate_key

# Funnel steps and the event each one counts.
FUNNEL_STEPS = [
    ("starts", "level_start_quickplay"),
    ("ends", "level_end_quickplay"),
    ("completes", "level_complete_quickplay"),
    ("fails", "level_fail_quickplay"),
    ("retries", "level_retry_quickplay"),
    ("resets", "level_reset_quickplay"),
]
# LIKE pattern: '_' is a one-character wildcard, kept as such.
QUICKPLAY_LEVEL_PATTERN = "level%_quickplay"


def quickplay_level_events(events: DataFrame) -> DataFrame:
    """Rows the funnel reads. The redundant prefix test is pushed to Parquet
    as StringStartsWith; the LIKE itself is evaluated after the scan."""
    name = F.col("event_name")
    return (events.where(name.startswith("level") & name.like(QUICKPLAY_LEVEL_PATTERN)
                         & F.col("board").isNotNull())
                  .select("event_date", "event_name", "board", "user_pseudo_id"))


def level_funnel_daily(events: DataFrame) -> DataFrame:
    """Six step counts, distinct starters and completion rate per (day, board).

    The distinct-starter count is a two-level aggregation: first per
    (day, board, user), then per (day, board); both levels combine map-side.
    """
    ev = quickplay_level_events(events)
    name = F.col("event_name")
    per_user = ev.groupBy("event_date", "board", "user_pseudo_id").agg(
        *[F.count_if(name == event).alias(step) for step, event in FUNNEL_STEPS])
    daily = per_user.groupBy("event_date", "board").agg(
        *[F.sum(step).cast("bigint").alias(step) for step, _ in FUNNEL_STEPS],
        F.count_if((F.col("starts") > 0) & F.col("user_pseudo_id").isNotNull())
        .alias("users_starting"),
    )
    rate = F.when(F.col("starts") > 0, F.round(F.col("completes") / F.col("starts"), 4))
    return daily.select(
        surrogate_key("event_date", "board").alias("funnel_day_pk"),
        "event_date", "board", *[step for step, _ in FUNNEL_STEPS], "users_starting",
        rate.alias("completion_rate"),
    )
