"""Exact distinct users that add up: one bitmap of user numbers per day and measure.

Users get dense numbers once. A day's bitmap has a bit per number, in pieces of
32,768; pieces of several days merge by OR, so the distinct users of a week, a
month or any set of days come from stored daily bitmaps, without the events and
without counting anybody twice. A piece takes 4 KB, so a day takes at most one bit
per user ever numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.operators.difficulty import START
from playmetrics.operators.sessions import USER

BUCKETS = 256  # users are numbered in this many groups at once


def measures() -> dict[str, Column]:
    """Measure and the events that make a user count for it."""
    name = F.col("event_name")
    return {"active": F.lit(True), "spender": name == "spend_virtual_currency",
            "starter": name == START}


def numbered_users(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_pseudo_id, number): known users keep their number, new ones get the next ones.

    No task sees all users: they are numbered within hash buckets, and a bucket's first
    number follows from the sizes of the buckets before it (one row each).
    """
    users = events.select(USER).where(F.col(USER).isNotNull()).distinct()
    taken = F.lit(0).cast("bigint")
    if known is not None:
        users = users.join(known.select(USER), USER, "left_anti")
        taken = F.coalesce(known.agg(F.max("number") + 1).scalar(), taken)
    bucketed = users.withColumn("_bucket", F.pmod(F.xxhash64(USER), F.lit(BUCKETS)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # BUCKETS rows at most
    offsets = sizes.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n"))
                           .alias("_offset"))
    inner = F.row_number().over(Window.partitionBy("_bucket").orderBy(USER)) - 1
    fresh = bucketed.withColumn("_inner", inner).join(F.broadcast(offsets), "_bucket").select(
        USER, (taken + F.col("_offset") + F.col("_inner")).cast("bigint").alias("number"))
    return fresh if known is None else known.select(USER, "number").unionByName(fresh)


def daily_bitmaps(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """(event_date, measure, piece, bitmap): who counts for a measure on a day."""
    flags = measures()
    per_user = (events.where(F.col(USER).isNotNull() & F.col("event_date").isNotNull())
                .groupBy("event_date", USER)
                .agg(*[F.max(flag).alias(name) for name, flag in flags.items()]))
    entries = F.array(*[F.when(F.col(name), F.lit(name)) for name in flags])
    marked = per_user.join(numbers, USER).select(
        "event_date", "number", F.explode(F.array_compact(entries)).alias("measure"))
    # bit positions and pieces as Spark's bitmap functions number them, from 1 on
    bit = F.col("number") + 1
    return (marked.groupBy("event_date", "measure", F.bitmap_bucket_number(bit).alias("piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap")))


def distinct_users(bitmaps: DataFrame, period: Column) -> DataFrame:
    """(period, one column per measure): distinct users over all days of a period."""
    merged = bitmaps.groupBy(period.alias("period"), "measure", "piece").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"))
    counted = merged.select("period", "measure", F.bitmap_count("bitmap").alias("n"))
    return counted.groupBy("period").agg(*[
        F.coalesce(F.sum(F.when(F.col("measure") == name, F.col("n"))), F.lit(0))
        .cast("bigint").alias(f"{name}_users") for name in measures()])
