"""What each user did on each day, in a form that adds up.

One row per (user, day) holds everything the user-day spine and the user
dimension need, and where the user's sessions stood at the end of the day.
Totals hold the same for all days of a user, with a bitmap of the days on which
the user was active. They add up: totals through a day and the rows of later
days give the totals through those, so a build that sees new days needs the
totals of the users who were active on them, and no old events or old days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.functions.params import surrogate_key
from playmetrics.operators.user_days import USER_DAY_COLUMNS, day_measures
from playmetrics.schema import DIM_USERS

KEY = ["user_pseudo_id", "event_date"]
# dimension column -> (event column, whether the latest value counts)
BY_TIME = {"first_country": ("country", False),
           "acquisition_medium": ("acquisition_medium", False),
           "acquisition_source": ("acquisition_source", False),
           "initial_extra_steps": ("initial_extra_steps", True)}


def _timed(value: str) -> Column:
    return F.when(F.col(value).isNotNull(),
                  F.struct(F.col("event_at"), F.col("event_pk"), F.col(value).alias("v")))


def user_day_state(sessionized: DataFrame) -> DataFrame:
    """One row per (user, day) of sessionized events; null users and days are kept."""
    name = F.col("event_name")
    return sessionized.groupBy(*KEY).agg(
        *day_measures(),
        F.min(F.when(name == "first_open", F.col("event_at"))).alias("first_open_at"),
        F.min("first_touch_at").alias("first_touch_at"),
        F.min("platform").alias("platform"),
        *[(F.max if latest else F.min)(_timed(column)).alias(out)
          for out, (column, latest) in BY_TIME.items()],
        F.count_if(name == "spend_virtual_currency").alias("num_spend_events"),
        F.count_if(name == "app_remove").alias("num_uninstalls"),
        F.max("event_at").alias("last_at"),
        F.max("session_number").alias("sessions_through"),
    )


def spine(state: DataFrame) -> DataFrame:
    """The user-day spine: days of known users that have a date."""
    known = state.where(F.col("user_pseudo_id").isNotNull() & F.col("event_date").isNotNull())
    return known.select(surrogate_key(*KEY).alias("user_day_pk"), *USER_DAY_COLUMNS[1:])


# ---------------------------------------------------------------- totals per user

BLOCK = 64  # days in one word of an activity bitmap
LEAST = ["first_open_at", "first_touch_at", "first_seen_date", "platform", "first_country",
         "acquisition_medium", "acquisition_source"]
MOST = ["last_seen_date", "num_sessions", "last_at", "initial_extra_steps"]
SUMS = ["num_days_active", "num_events", "num_spend_events", "num_uninstalls"]


def user_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_pseudo_id"), F.lit(buckets)).cast("int").alias("user_bucket")


def day_bit(day: Column) -> tuple[Column, Column]:
    """The block of a day, counted from 1970-01-01, and the day's bit in it."""
    number = F.unix_date(day)
    return (F.floor(number / BLOCK).cast("int"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(BLOCK))))


def day_totals(state: DataFrame) -> DataFrame:
    """Each (user, day) of the state as the totals of a user who was there on that day alone."""
    block, bit = day_bit(F.col("event_date"))
    dated = F.col("event_date").isNotNull()
    bitmap = F.when(dated, F.array(F.struct(block.alias("block"), bit.alias("bits")))).otherwise(
        F.array().cast("array<struct<block:int,bits:bigint>>"))
    return state.select(
        "user_pseudo_id", "first_open_at", "first_touch_at",
        F.col("event_date").alias("first_seen_date"), F.col("event_date").alias("last_seen_date"),
        dated.cast("bigint").alias("num_days_active"),
        F.col("sessions_through").alias("num_sessions"), "num_events", "platform", *BY_TIME,
        "num_spend_events", "num_uninstalls", "last_at", bitmap.alias("days"))


def added_up(totals: DataFrame) -> DataFrame:
    """One row per user of rows that each hold totals of separate days.

    Everything adds up, whatever the order: least and greatest values, sums, and the
    bitmaps of active days by OR. Both groupings are by user, and combined before
    the shuffle.
    """
    measures = totals.groupBy("user_pseudo_id").agg(
        *[F.min(c).alias(c) for c in LEAST], *[F.max(c).alias(c) for c in MOST],
        *[F.sum(c).alias(c) for c in SUMS])
    words = (totals.select("user_pseudo_id", F.inline("days"))
             .groupBy("user_pseudo_id", "block").agg(F.bit_or("bits").alias("bits")))
    bitmaps = words.groupBy("user_pseudo_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "bits"))).alias("days"))
    user = measures["user_pseudo_id"].eqNullSafe(bitmaps["user_pseudo_id"])
    return measures.join(bitmaps, user, "left").select(
        measures["user_pseudo_id"], *LEAST, *MOST, *SUMS,
        F.coalesce("days", F.array().cast("array<struct<block:int,bits:bigint>>")).alias("days"))


def users(totals: DataFrame) -> DataFrame:
    """The user dimension; a user without a key or without a dated day has no row."""
    known = totals.where(F.col("user_pseudo_id").isNotNull() & (F.col("num_days_active") > 0))
    return known.select(
        "user_pseudo_id", "first_open_at",
        F.col("first_open_at").isNotNull().alias("has_observed_first_open"), "first_touch_at",
        "first_seen_date", "last_seen_date", "num_days_active", "num_sessions", "num_events",
        "platform", *[F.col(c)["v"].alias(c) for c in BY_TIME], "num_spend_events",
        (F.col("num_uninstalls") > 0).alias("has_uninstalled")).select(*DIM_USERS.fieldNames())


def sessions_before(totals: DataFrame) -> DataFrame:
    """(user, last_at, sessions): where each user's sessions stand after the days of the totals."""
    return totals.select("user_pseudo_id", "last_at", F.col("num_sessions").alias("sessions"))


# ---------------------------------------------------------------- activity bitmaps

def active_on(days: Column, day: Column) -> Column:
    """Whether a bitmap has the day."""
    block, bit = day_bit(day)
    return F.exists(days, lambda x: (x["block"] == block) & (x["bits"].bitwiseAND(bit) != 0))


def active_between(days: Column, first: Column, last: Column) -> Column:
    """Whether a bitmap has a day from ``first`` to ``last``, both included."""
    low, high = F.unix_date(first), F.unix_date(last)

    def hit(x: Column) -> Column:
        start = x["block"] * BLOCK
        below = F.greatest(low - start, F.lit(0))          # bits under the range
        above = F.greatest(start + BLOCK - 1 - high, F.lit(0))  # bits over it
        every = F.lit(-1).cast("bigint")
        mask = F.call_function("shiftleft", every, below).bitwiseAND(
            F.call_function("shiftrightunsigned", every, above))
        return (below < BLOCK) & (above < BLOCK) & (x["bits"].bitwiseAND(mask) != 0)

    return (low <= high) & F.exists(days, hit)
