"""The model DAG as lazily built DataFrames.

``Models(raw)`` exposes every model of the pipeline as a property. Nothing
runs until an action; each property is built once per instance so that the
marts share one logical subtree (and Spark can reuse its exchanges).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.operators.core import dim_users, fct_events, user_cohort_attributes
from playmetrics.operators.difficulty import (
    attempts,
    board_difficulty_weekly,
    board_migration_weekly,
)
from playmetrics.operators.economy import extra_steps_economy_daily
from playmetrics.operators.engagement import (
    daily_active_users,
    retention_by_grant,
    retention_cohorts,
)
from playmetrics.operators.funnels import level_funnel_daily
from playmetrics.operators.sessions import (
    HOT_SHARE,
    hot_keys,
    sessionize,
    sessionized_events,
    user_session_counts,
)
from playmetrics.operators.staging import stage_events
from playmetrics.operators.user_days import user_days
from playmetrics.operators.user_state import added_up, day_totals, user_day_state

SESSION_COLUMNS = ["session_number", "is_session_first_event", "seconds_since_previous_event",
                   "session_id"]


class Models:
    def __init__(self, raw: DataFrame | None, hot_share: int = HOT_SHARE,
                 staging: DataFrame | None = None,
                 sessionized: DataFrame | None = None, user_days: DataFrame | None = None,
                 users: DataFrame | None = None, prior: DataFrame | None = None):
        """``staging``/``sessionized``/``user_days``/``users`` may be given
        pre-materialized (e.g. read back from written tables); models below
        them are then built from those frames instead of from ``raw``. ``prior``
        tells where sessions stand before ``raw`` (see ``sessionize``)."""
        self.raw = raw
        self._hot_share = hot_share
        self._staging = staging
        self._sessionized = sessionized
        self._user_days = user_days
        self._users = users
        self._prior = prior

    @cached_property
    def staging(self) -> DataFrame:
        if self._staging is not None:
            return self._staging
        if self._sessionized is not None:
            return self._sessionized.drop(*SESSION_COLUMNS)
        return stage_events(self.raw)

    @cached_property
    def hot_users(self) -> DataFrame:
        return hot_keys(self.raw, "user_pseudo_id", self._hot_share)

    @cached_property
    def sessionized(self) -> DataFrame:
        """Staging plus the four session columns (one row per event)."""
        if self._sessionized is not None:
            return self._sessionized
        return sessionize(self.staging, hot_users=self.hot_users, timeline=self.timeline,
                          prior=self._prior)

    @cached_property
    def timeline(self) -> DataFrame | None:
        """(user, time, key) rows for the session bucket summary, read from two
        raw columns instead of re-deriving staging: raw duplicates only repeat
        timestamps. Rows without a timestamp each open a session, so those go
        through staging's dedup (a rare, pushed-down IS NULL slice)."""
        if self.raw is None or self._staging is not None:
            return None
        ts = F.timestamp_micros("event_timestamp")
        timed = self.raw.where(F.col("event_timestamp").isNotNull()).select(
            "user_pseudo_id", ts.alias("event_at"), F.lit(None).cast("string").alias("event_pk"))
        untimed = stage_events(self.raw.where(F.col("event_timestamp").isNull())).select(
            "user_pseudo_id", "event_at", "event_pk")
        return timed.unionByName(untimed)

    @cached_property
    def int_events_sessionized(self) -> DataFrame:
        return sessionized_events(self.sessionized)

    @cached_property
    def int_user_days(self) -> DataFrame:
        if self._user_days is not None:
            return self._user_days
        return user_days(self.sessionized)

    @cached_property
    def fct_events(self) -> DataFrame:
        return fct_events(self.sessionized)

    @cached_property
    def dim_users(self) -> DataFrame:
        if self._users is not None:
            return self._users
        if self._sessionized is None and self.timeline is not None:
            # only each user's session count is needed: take it from the small
            # bucket summary instead of numbering every event
            counts = user_session_counts(self.timeline, hot_users=self.hot_users)
            return dim_users(self.staging, session_counts=counts)
        return dim_users(self.sessionized)

    @cached_property
    def daily_active_users(self) -> DataFrame:
        return daily_active_users(self.int_user_days)

    @cached_property
    def max_loaded_date(self):
        """Newest event_date of the user-day spine. Every raw row with a user
        has its day in the spine, so with raw at hand the scalar reads two raw
        columns instead of re-deriving the spine."""
        if self.raw is None or self._user_days is not None:
            return None
        with_user = self.raw.where(F.col("user_pseudo_id").isNotNull())
        return with_user.agg(F.max(F.to_date("event_date", "yyyyMMdd"))).scalar()

    @cached_property
    def retention_users(self) -> DataFrame:
        """Users as retention reads them: the materialized dimension when given,
        else a light per-user aggregate of staging (no sessions needed)."""
        if self._users is not None:
            return self._users
        return user_cohort_attributes(self.staging)

    @cached_property
    def user_totals(self) -> DataFrame:
        """All days of each user added up, with the bitmap of active days."""
        return added_up(day_totals(user_day_state(self.sessionized)))

    @cached_property
    def activity_days(self) -> DataFrame:
        """(user, event_date) pairs: the spine when given, else distinct pairs of
        staging (the spine has exactly one row per such pair)."""
        if self._user_days is not None:
            return self._user_days
        pairs = self.staging.select("user_pseudo_id", "event_date")
        return pairs.where(F.col("user_pseudo_id").isNotNull()
                           & F.col("event_date").isNotNull()).distinct()

    @cached_property
    def retention_cohorts(self) -> DataFrame:
        return retention_cohorts(self.retention_users, self.activity_days, self.max_loaded_date)

    @cached_property
    def retention_by_extra_steps_grant(self) -> DataFrame:
        return retention_by_grant(self.retention_users, self.activity_days, self.max_loaded_date)

    @cached_property
    def level_funnel_daily(self) -> DataFrame:
        # fct_events holds every staging row exactly once, and the funnel reads
        # no session column, so staging is an equivalent, cheaper input.
        return level_funnel_daily(self.staging)

    @cached_property
    def attempts(self) -> DataFrame:
        hot = None if self.raw is None else self.hot_users
        return attempts(self.staging, hot_users=hot)

    @cached_property
    def board_difficulty_weekly(self) -> DataFrame:
        return board_difficulty_weekly(self.attempts)

    @cached_property
    def board_migration_weekly(self) -> DataFrame:
        return board_migration_weekly(self.attempts)

    @cached_property
    def extra_steps_economy_daily(self) -> DataFrame:
        return extra_steps_economy_daily(self.staging)

    MARTS = ("fct_events", "dim_users", "daily_active_users", "retention_cohorts",
             "retention_by_extra_steps_grant", "level_funnel_daily",
             "extra_steps_economy_daily")
