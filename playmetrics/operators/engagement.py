"""Engagement marts: daily actives and day-N retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.operators.user_state import active_between, active_on

RETENTION_DAYS = (1, 7, 30)


def daily_active_users(user_days: DataFrame, first_seen: DataFrame | None = None) -> DataFrame:
    """One row per activity day.

    user days are unique on (user, day), so distinct-user counts are plain
    counts. A user is new on the first day they were seen; that day comes
    from a per-user window over the (small) user-day spine rather than a
    join with the user dimension, or, where the spine only holds some days, from
    ``first_seen`` (user_pseudo_id, first_seen_date). Minutes are summed as decimals so
    the order of addition cannot move a rounding tie.
    """
    if first_seen is None:
        seen = F.min("event_date").over(Window.partitionBy("user_pseudo_id"))
        ud = user_days.withColumn("_first_seen", seen)
    else:
        index = first_seen.select("user_pseudo_id", F.col("first_seen_date").alias("_first_seen"))
        ud = user_days.join(index, "user_pseudo_id", "left")
    daily = ud.groupBy(F.col("event_date").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("dau"),
        F.count_if(F.col("_first_seen") == F.col("event_date")).alias("new_users"),
        F.sum("num_sessions").alias("num_sessions"),
        F.sum("num_events").alias("num_events"),
        F.round(F.sum(F.col("engagement_minutes").cast("decimal(38,2)")), 1)
        .cast("double").alias("engagement_minutes"),
        F.count_if("has_played_quickplay").alias("quickplay_users"),
        F.count_if("has_played_progressive").alias("progressive_users"),
    )
    return daily.select(
        "activity_date", "dau", "new_users",
        (F.col("dau") - F.col("new_users")).alias("returning_users"),
        "num_sessions", "num_events", "engagement_minutes", "quickplay_users",
        "progressive_users",
    )


def _rate(numerator: Column, denominator: Column) -> Column:
    return F.round(numerator / denominator, 4)


def _cohort_users(users: DataFrame, *extra: str) -> DataFrame:
    return (users.where(F.col("has_observed_first_open"))
                 .select("user_pseudo_id", F.to_date("first_open_at").alias("cohort_date"),
                         *extra))


def last_loaded_day(user_days: DataFrame) -> Column:
    """The newest activity day, as a scalar subquery (one small job, inlined)."""
    return user_days.agg(F.max("event_date")).scalar()


def retention_flags(totals: DataFrame, days: tuple[int, ...] = RETENTION_DAYS,
                    rolling: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """Users with an observed first open: cohort_date, grant_bucket, and per day N whether
    they were active N days later (``_rN``); per rolling (a, b) whether on any of the days
    a to b (``_ra_b``). Read from activity bitmaps, one row per user, without the spine."""
    cohort = F.to_date("first_open_at")
    grant = F.coalesce(F.col("initial_extra_steps")["v"].cast("string"), F.lit("unassigned"))
    known = totals.where(F.col("user_pseudo_id").isNotNull() & (F.col("num_days_active") > 0)
                         & F.col("first_open_at").isNotNull())
    return known.select(
        cohort.alias("cohort_date"), grant.alias("grant_bucket"),
        *[active_on(F.col("days"), F.date_add(cohort, n)).alias(f"_r{n}") for n in days],
        *[active_between(F.col("days"), F.date_add(cohort, a), F.date_add(cohort, b))
          .alias(f"_r{a}_{b}") for a, b in rolling])


def retention_cohorts_of(flags: DataFrame, max_loaded: Column,
                         days: tuple[int, ...] = RETENTION_DAYS) -> DataFrame:
    """:func:`retention_cohorts` from :func:`retention_flags`, for any days."""
    counts = flags.groupBy("cohort_date").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[F.count_if(f"_r{n}").alias(f"retained_d{n}") for n in days])
    return counts.select("cohort_date", "cohort_size", *[f"retained_d{n}" for n in days], *[
        F.when(F.date_add("cohort_date", n) <= max_loaded,
               _rate(F.col(f"retained_d{n}"), F.col("cohort_size"))).alias(f"retention_d{n}")
        for n in days])


def retention_by_grant_of(flags: DataFrame, max_loaded: Column,
                          days: tuple[int, ...] = RETENTION_DAYS) -> DataFrame:
    """:func:`retention_by_grant` from :func:`retention_flags`, for any days."""
    counts = flags.groupBy("grant_bucket").agg(
        F.count(F.lit(1)).alias("cohort_users"),
        *[F.count_if(F.date_add("cohort_date", n) <= max_loaded).alias(f"d{n}_denominator")
          for n in days],
        *[F.count_if(f"_r{n}").alias(f"retained_d{n}") for n in days])
    return counts.select("*", *[
        F.when(F.col(f"d{n}_denominator") > 0,
               _rate(F.col(f"retained_d{n}"), F.col(f"d{n}_denominator"))).alias(f"retention_d{n}")
        for n in days])


def rolling_returns(flags: DataFrame, max_loaded: Column,
                    ranges: tuple[tuple[int, int], ...]) -> DataFrame:
    """Per cohort and range of days (a to b after the first open): users who came back on any of
    them. The rate is NULL until the whole range is loaded."""
    parts = [F.struct(F.lit(a).alias("first_day"), F.lit(b).alias("last_day"),
                      F.col(f"_r{a}_{b}").alias("hit")) for a, b in ranges]
    counts = (flags.select("cohort_date", F.inline(F.array(*parts)))
              .groupBy("cohort_date", "first_day", "last_day")
              .agg(F.count(F.lit(1)).alias("cohort_size"), F.count_if("hit").alias("returned")))
    seen = F.date_add("cohort_date", F.col("last_day")) <= max_loaded
    return counts.withColumn("return_rate", F.when(seen, _rate(F.col("returned"),
                                                               F.col("cohort_size"))))


def retention_cohorts(users: DataFrame, user_days: DataFrame,
                      max_loaded: Column | None = None) -> DataFrame:
    """Day-N retention per first_open cohort date, N in 1, 7, 30.

    A user is retained on day N iff active exactly N days after the cohort
    date; (user, day) is unique in user days, so counting matching rows per
    cohort counts users. The last loaded day is a scalar subquery (``max_loaded``
    may supply an equal, cheaper one); a rate is NULL (counts stay 0) while
    cohort_date + N is past it.
    """
    max_loaded = last_loaded_day(user_days) if max_loaded is None else max_loaded
    cohort = _cohort_users(users)
    joined = cohort.join(user_days.select("user_pseudo_id", "event_date"), "user_pseudo_id")
    offset = F.datediff(F.col("event_date"), F.col("cohort_date"))
    counts = joined.groupBy("cohort_date").agg(
        F.count_distinct("user_pseudo_id").alias("cohort_size"),
        *[F.count_if(offset == n).alias(f"retained_d{n}") for n in RETENTION_DAYS],
    )
    rates = [
        F.when(F.date_add("cohort_date", n) <= max_loaded,
               _rate(F.col(f"retained_d{n}"), F.col("cohort_size"))).alias(f"retention_d{n}")
        for n in RETENTION_DAYS
    ]
    return counts.select("cohort_date", "cohort_size",
                         *[f"retained_d{n}" for n in RETENTION_DAYS], *rates)


def retention_by_grant(users: DataFrame, user_days: DataFrame,
                       max_loaded: Column | None = None) -> DataFrame:
    """Day-N retention per extra-steps grant bucket ('unassigned' when none).

    Each day-N rate has its own denominator: the bucket's users whose day N
    is observable. A rate is NULL iff that denominator is 0.
    """
    max_loaded = last_loaded_day(user_days) if max_loaded is None else max_loaded
    bucket = F.coalesce(F.col("initial_extra_steps").cast("string"), F.lit("unassigned"))
    cohort = _cohort_users(users, bucket.alias("grant_bucket"))
    joined = cohort.join(user_days.select("user_pseudo_id", "event_date"), "user_pseudo_id")
    offset = F.datediff(F.col("event_date"), F.col("cohort_date"))
    per_user = joined.groupBy("grant_bucket", "user_pseudo_id", "cohort_date").agg(
        *[F.max(F.when(offset == n, 1).otherwise(0)).alias(f"_r{n}") for n in RETENTION_DAYS])
    agg = per_user.groupBy("grant_bucket").agg(
        F.count(F.lit(1)).alias("cohort_users"),
        *[F.count_if(F.date_add("cohort_date", n) <= max_loaded).alias(f"d{n}_denominator")
          for n in RETENTION_DAYS],
        *[F.sum(f"_r{n}").cast("bigint").alias(f"retained_d{n}") for n in RETENTION_DAYS],
    )
    rates = [
        F.when(F.col(f"d{n}_denominator") > 0,
               _rate(F.col(f"retained_d{n}"), F.col(f"d{n}_denominator")))
        .alias(f"retention_d{n}")
        for n in RETENTION_DAYS
    ]
    return agg.select("grant_bucket", "cohort_users",
                      *[f"d{n}_denominator" for n in RETENTION_DAYS],
                      *[f"retained_d{n}" for n in RETENTION_DAYS], *rates)
