"""Extra-steps economy per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The four economy events.
SPEND = "spend_virtual_currency"
USE = "use_extra_steps"
EXHAUSTED = "no_more_extra_steps"
AD_REWARD = "ad_reward"
AMOUNT = "decimal(18,6)"
ECONOMY_EVENTS = [SPEND, USE, EXHAUSTED, AD_REWARD]


def economy_events(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_name").isin(ECONOMY_EVENTS))
                  .select("event_date", "event_name", "user_pseudo_id", "event_value"))


def extra_steps_economy_daily(events: DataFrame) -> DataFrame:
    """Spend / use / exhaustion / ad-reward counts, step sums (1 place) and
    distinct spenders and exhausted users per day. A day with none of the
    four events has no row. The two distinct counts are computed as a
    per-(day, user) aggregate followed by a per-day aggregate, which avoids
    the row expansion Spark uses for several distinct aggregates."""
    ev = economy_events(events)
    name, value = F.col("event_name"), F.col("event_value")

    # decimals add up to the same total in any order
    exact = value.cast(AMOUNT)

    def steps(event: str):
        return F.sum(F.when(name == event, exact).otherwise(F.lit(0).cast(AMOUNT)))

    def rounded(column: str):
        return F.round(F.sum(column), 1).cast("double")

    per_user = ev.groupBy("event_date", "user_pseudo_id").agg(
        F.count_if(name == SPEND).alias("_spend"),
        steps(SPEND).alias("_spent"),
        F.count_if(name == USE).alias("_use"),
        steps(USE).alias("_used"),
        F.count_if(name == EXHAUSTED).alias("_exhausted"),
        F.count_if(name == AD_REWARD).alias("_ads"),
        steps(AD_REWARD).alias("_granted"),
    )
    known_user = F.col("user_pseudo_id").isNotNull()
    return per_user.groupBy("event_date").agg(
        F.sum("_spend").cast("bigint").alias("spend_events"),
        rounded("_spent").alias("steps_spent"),
        F.count_if((F.col("_spend") > 0) & known_user).alias("spenders"),
        F.sum("_use").cast("bigint").alias("use_events"),
        rounded("_used").alias("steps_used"),
        F.sum("_exhausted").cast("bigint").alias("exhaustion_events"),
        F.count_if((F.col("_exhausted") > 0) & known_user).alias("exhausted_users"),
        F.sum("_ads").cast("bigint").alias("ad_rewards"),
        rounded("_granted").alias("steps_granted_by_ads"),
    )
