"""User-day spine: one row per user per active event_date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.functions.params import surrogate_key

# The progressive-mode level events.
PROGRESSIVE_EVENTS = ["level_start", "level_end", "level_complete", "level_fail",
                      "level_retry", "level_reset", "level_up"]

USER_DAY_COLUMNS = ["user_day_pk", "user_pseudo_id", "event_date", "num_events", "num_sessions",
                    "has_first_open", "has_played_quickplay", "has_played_progressive",
                    "has_spent_steps", "engagement_minutes"]


def user_days(sessionized: DataFrame) -> DataFrame:
    """Roll sessionized events up to (user, event_date).

    Events and sessions are grouped by the same keys, so one aggregate
    replaces the two-aggregates-and-join form. ``num_sessions`` counts the
    distinct session numbers touching the day: a session that crosses
    midnight counts on both days. Minutes are NULL when the day has no
    engagement rows. The single distinct aggregate is planned as two hash
    aggregates keyed (user, day, session) then (user, day), both with
    map-side combine, so a very active user does not land in one task.
    Rows without a user or a day are left out, as the equi-join of the two
    per-day aggregates in the source definition leaves them out.
    """
    keyed = sessionized.where(F.col("user_pseudo_id").isNotNull()
                              & F.col("event_date").isNotNull())
    daily = keyed.groupBy("user_pseudo_id", "event_date").agg(*day_measures())
    return daily.select(surrogate_key("user_pseudo_id", "event_date").alias("user_day_pk"),
                        *USER_DAY_COLUMNS[1:])


def day_measures() -> list[Column]:
    """The spine's measures, as aggregates over a user's sessionized events of one day."""
    name = F.col("event_name")
    return [
        F.count(F.lit(1)).alias("num_events"),
        F.count_distinct("session_number").alias("num_sessions"),
        (F.count_if(name == "first_open") > 0).alias("has_first_open"),
        (F.count_if(name.like("%_quickplay")) > 0).alias("has_played_quickplay"),
        (F.count_if(name.isin(PROGRESSIVE_EVENTS)) > 0).alias("has_played_progressive"),
        (F.count_if(name == "spend_virtual_currency") > 0).alias("has_spent_steps"),
        F.round(F.sum("engagement_time_msec") / 60000, 2).alias("engagement_minutes"),
    ]
