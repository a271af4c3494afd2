"""How hard the quickplay boards are, week by week, and where players go from their first board.

The unit is the attempt: a start, and the first outcome (complete, fail, retry or
reset) of the same user on the same board that follows it before the user's
next start there. An outcome ends one attempt at most; a start without one is kept as
unfinished. At equal times outcomes come before starts, so an outcome never
ends an attempt that begins with it.

A user with a third of all events must not become one task, so attempts are paired
within (user, board, time bucket), as sessions are (see ``operators.sessions``);
what follows the last event of a bucket comes from a summary with one row per
bucket.

Starts without a time or a user have no place in an order: they are unfinished.
Outcomes without one end nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.operators.sessions import DAY_SECONDS, USER, time_buckets

START = "level_start_quickplay"
# Outcome of an attempt and the event that tells it, in tie order.
OUTCOMES = {"completed": "level_complete_quickplay", "failed": "level_fail_quickplay",
            "reset": "level_reset_quickplay", "retried": "level_retry_quickplay"}
UNFINISHED = "unfinished"


def _outcome(name: Column) -> Column:
    """The outcome that an event name tells; NULL for a start."""
    names = [x for pair in OUTCOMES.items() for x in (F.lit(pair[1]), F.lit(pair[0]))]
    return F.create_map(*names)[name]


def attempt_events(events: DataFrame) -> DataFrame:
    """Starts and outcomes on a board, as (user, board, event_at, event_date, event_pk, outcome)."""
    name = F.col("event_name")
    # the prefix test reaches the Parquet scan; the list is evaluated after it
    wanted = name.startswith("level") & name.isin(START, *OUTCOMES.values())
    return events.where(wanted & F.col("board").isNotNull()).select(
        USER, "board", "event_at", "event_date", "event_pk", _outcome(name).alias("outcome"))


def attempts(events: DataFrame, bucket_seconds: int = DAY_SECONDS,
             hot_users: DataFrame | None = None, hot_bucket_seconds: int = 60) -> DataFrame:
    """One row per start: user, board, event_at, event_date, outcome, seconds until it."""
    found = attempt_events(events)
    placed = F.col("event_at").isNotNull() & F.col(USER).isNotNull()
    ev = time_buckets(found.where(placed), bucket_seconds, hot_users, hot_bucket_seconds)
    # NULLs sort last, which puts starts after the outcomes of the same moment
    step = F.struct("event_at", F.col("outcome").isNull().alias("is_start"), "outcome")
    order = [F.asc("event_at"), F.asc_nulls_last("outcome")]
    here = ["_uk", "board", "_bucket"]
    follows = F.lead(step).over(Window.partitionBy(*here).orderBy(*order))
    heads = ev.groupBy(*here).agg(F.min(step).alias("_head"))
    later = heads.select(*here, F.lead("_head").over(
        Window.partitionBy("_uk", "board").orderBy("_bucket")).alias("_beyond"))
    # the events are already dealt by these keys, so only the summary moves
    paired = (ev.withColumn("_next", follows).join(later, here, "left")
              .where(F.col("outcome").isNull())
              .withColumn("_next", F.coalesce("_next", "_beyond")))
    ended = ~F.coalesce(F.col("_next.is_start"), F.lit(True))
    timed = paired.select(
        USER, "board", "event_at", "event_date",
        F.when(ended, F.col("_next.outcome")).otherwise(UNFINISHED).alias("outcome"),
        F.when(ended, F.timestamp_diff("SECOND", F.col("event_at"), F.col("_next.event_at")))
        .alias("seconds"))
    loose = found.where(~placed & F.col("outcome").isNull()).select(
        USER, "board", "event_at", "event_date", F.lit(UNFINISHED).alias("outcome"),
        F.lit(None).cast("bigint").alias("seconds"))
    return timed.unionByName(loose)


def _week(day: str) -> Column:
    return F.date_trunc("week", F.col(day)).cast("date")


def _user_weeks(tries: DataFrame) -> DataFrame:
    """Per (user, week, board): attempts by outcome, time to completion, first start."""
    return tries.groupBy(USER, _week("event_date").alias("week"), "board").agg(
        F.count(F.lit(1)).alias("attempts"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in (*OUTCOMES, UNFINISHED)],
        F.sum(F.when(F.col("outcome") == "completed", F.col("seconds"))).alias("seconds"),
        F.min("event_at").alias("first_at"))


def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole, 4))


def board_difficulty_weekly(tries: DataFrame) -> DataFrame:
    """Per (week, board): players, attempts by outcome, their rates, and the change since
    the board's last week with attempts."""
    counts = ["attempts", *OUTCOMES, UNFINISHED]
    weekly = _user_weeks(tries).groupBy("week", "board").agg(
        F.count(USER).alias("players"),  # one row per user; those without one are not counted
        *[F.sum(c).cast("bigint").alias(c) for c in counts],
        F.sum("seconds").cast("bigint").alias("_seconds"))
    rated = weekly.select(
        "week", "board", "players", *counts,
        _rate(F.col("completed"), F.col("attempts")).alias("completion_rate"),
        _rate(F.col("retried") + F.col("reset"), F.col("attempts")).alias("retry_reset_rate"),
        F.when(F.col("completed") > 0, F.round(F.col("_seconds") / F.col("completed"), 1))
        .alias("seconds_to_complete"))
    before = F.lag("completion_rate").over(Window.partitionBy("board").orderBy("week"))
    return rated.withColumn("completion_rate_change", F.round(F.col("completion_rate") - before, 4))


def board_migration_weekly(tries: DataFrame) -> DataFrame:
    """Per (first board, week, board): the players who began on the first board and play
    this one in the week, and their share of all who began there and play at all.

    A user's first board is that of the earliest start with a time (equal times: the
    lesser name). A user's rows here are weeks times boards, so a window per
    user is small whoever the user is.
    """
    own = _user_weeks(tries.where(F.col(USER).isNotNull() & F.col("event_at").isNotNull()))
    per_user = Window.partitionBy(USER)
    first = F.min(F.struct("first_at", "board")).over(per_user)["board"]
    # of a user's boards in a week, one stands for the user
    lead = F.row_number().over(Window.partitionBy(USER, "week").orderBy("board")) == 1
    begun = own.select("*", first.alias("first_board"), lead.alias("lead"))
    matrix = begun.groupBy("first_board", "week", "board").agg(
        F.count(F.lit(1)).alias("players"), F.count_if("lead").alias("_leads"),
        F.sum("attempts").cast("bigint").alias("attempts"),
        F.sum("completed").cast("bigint").alias("completed"))
    active = F.sum("_leads").over(Window.partitionBy("first_board", "week"))
    return matrix.withColumn("active_players", active.cast("bigint")).select(
        "first_board", "week", "board", "players", "active_players",
        _rate(F.col("players"), F.col("active_players")).alias("player_share"),
        "attempts", _rate(F.col("completed"), F.col("attempts")).alias("completion_rate"))
