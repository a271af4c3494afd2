"""Core marts: the event fact and the user dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.schema import DIM_USERS, FCT_EVENTS


def fct_events(sessionized: DataFrame) -> DataFrame:
    """One row per event with its session. Staging rows and session rows are
    1:1 on event_pk, so the session columns come from the same frame and no
    join is needed."""
    return sessionized.select(*FCT_EVENTS.fieldNames())


def _first_non_null(value: str, latest: bool = False) -> Column:
    """Earliest (or latest) non-NULL ``value`` by (event_at, event_pk).

    A min/max over a struct whose first fields are the ordering keys; rows
    with a NULL value contribute a NULL struct, which min/max skip. Both are
    ordinary partial aggregates, so the work is combined map-side.
    """
    keyed = F.when(F.col(value).isNotNull(),
                   F.struct(F.col("event_at"), F.col("event_pk"), F.col(value).alias("v")))
    return (F.max(keyed) if latest else F.min(keyed))["v"]


def dim_users(sessionized: DataFrame, session_counts: DataFrame | None = None) -> DataFrame:
    """One row per user from a single aggregation over sessionized events.

    ``num_days_active`` is the number of user-day rows (distinct non-NULL
    event_date); ``num_sessions`` is the highest session number. As in the
    source definition (inner joins with the user-day spine and the sessions),
    a user without a key or without any dated event has no row.

    ``session_counts`` (user_pseudo_id, num_sessions) may replace the highest
    session number, e.g. counts derived from the session bucket summary; then
    ``sessionized`` needs no session columns.
    """
    name = F.col("event_name")
    per_user = sessionized.where(F.col("user_pseudo_id").isNotNull()).groupBy(
        "user_pseudo_id").agg(
        F.min(F.when(name == "first_open", F.col("event_at"))).alias("first_open_at"),
        F.min("first_touch_at").alias("first_touch_at"),
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.count_distinct("event_date").alias("num_days_active"),
        *([] if session_counts is not None
          else [F.max("session_number").alias("num_sessions")]),
        F.count(F.lit(1)).alias("num_events"),
        F.min("platform").alias("platform"),
        _first_non_null("country").alias("first_country"),
        _first_non_null("acquisition_medium").alias("acquisition_medium"),
        _first_non_null("acquisition_source").alias("acquisition_source"),
        _first_non_null("initial_extra_steps", latest=True).alias("initial_extra_steps"),
        F.count_if(name == "spend_virtual_currency").alias("num_spend_events"),
        (F.count_if(name == "app_remove") > 0).alias("has_uninstalled"),
    )
    if session_counts is not None:
        per_user = per_user.join(session_counts, "user_pseudo_id", "inner")
    return per_user.where(F.col("num_days_active") > 0).select(
        "user_pseudo_id", "first_open_at",
        F.col("first_open_at").isNotNull().alias("has_observed_first_open"),
        *DIM_USERS.fieldNames()[3:],
    )


def user_cohort_attributes(events: DataFrame) -> DataFrame:
    """The dim_users columns retention reads (first_open_at,
    has_observed_first_open, latest non-NULL grant), straight from events:
    the same expressions as :func:`dim_users` without the session columns,
    so retention needs no sessionization."""
    per_user = events.groupBy("user_pseudo_id").agg(
        F.min(F.when(F.col("event_name") == "first_open", F.col("event_at")))
        .alias("first_open_at"),
        _first_non_null("initial_extra_steps", latest=True).alias("initial_extra_steps"),
    )
    return per_user.select("user_pseudo_id", "first_open_at",
                           F.col("first_open_at").isNotNull().alias("has_observed_first_open"),
                           "initial_extra_steps")
