"""Gap-based sessionization that stays balanced when one user is huge.

A new session starts on a user's first event or when the whole-second gap to
the previous event exceeds ``gap_seconds`` (exactly 1800 s continues the
session). Session numbers are 1-based per user over all loaded history.

A plain ``Window.partitionBy(user)`` sorts every event of a user in a single
task, so a user holding a third of the rows would become one task. Instead:

1. Events are windowed per (user, time bucket): local lag, local new-session
   flags and their running count. Buckets are one day by default; users with
   more than ``1 / HOT_SHARE`` of all rows (fewer than ``HOT_SHARE`` of them)
   get fine buckets of ``hot_bucket_seconds``, so their events spread as well.
2. A per-bucket summary (first/last timestamp, number of local flags) is
   windowed per user. It holds one row per non-empty bucket, which is far
   smaller than the events; from it come the gap across the bucket boundary
   and the number of sessions that started in earlier buckets.
3. The summary is joined back on (user, bucket). The events side is already
   hash-partitioned and sorted on those keys by step 1, so only the small
   summary moves.

The result equals the single-window definition exactly (events ordered by
``event_at`` then ``event_pk``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.functions.params import surrogate_key

USER = "user_pseudo_id"
DAY_SECONDS = 86_400
_NULL_TIME_BUCKET = -(2**63)  # events without a timestamp sort first, like NULLs do
UNTIMED_DIGITS = 3            # up to 16 ** 3 buckets for a user's events without a time
HOT_SHARE = 10_000


def _gap_seconds(prev: Column, cur: Column) -> Column:
    """Whole seconds from prev to cur, truncated (1800.9 s -> 1800)."""
    return F.timestamp_diff("SECOND", prev, cur)


def hot_keys(df: DataFrame, key: str = USER, share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``1 / share`` of all rows: fewer than ``share`` keys, always.

    The bound follows from the share, so nothing is cut off: a key that is not
    listed is small beside the whole. Counting is a partial aggregate over one
    column.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") * share > total).select(key)


def time_buckets(df: DataFrame, bucket_seconds: int, hot_users: DataFrame | None,
                 hot_bucket_seconds: int) -> DataFrame:
    """Add ``_uk`` (the user wrapped in a struct, so a NULL user is an ordinary,
    joinable key, as it is a partition of its own in a window) and ``_bucket``
    (monotone in the event order within a user). Events without a time come
    first, by their key; its leading digits spread them over buckets."""
    columns = [c for c in df.columns if c != "_untimed_key"]
    uk = F.struct(F.col(USER).alias("u"))
    width_us = F.lit(bucket_seconds * 1_000_000)
    df = df.withColumn("_uk", uk)
    if hot_users is not None:
        marks = hot_users.select(uk.alias("_uk")).distinct().withColumn("_hot", F.lit(True))
        df = df.join(F.broadcast(marks), on="_uk", how="left")  # fewer than HOT_SHARE rows
        width_us = F.when(F.col("_hot"), F.lit(hot_bucket_seconds * 1_000_000)).otherwise(width_us)
    digits = F.conv(F.substring("event_pk", 1, UNTIMED_DIGITS), 16, 10).cast("bigint")
    bucket = F.coalesce(F.floor(F.unix_micros("event_at") / width_us).cast("bigint"),
                        F.lit(_NULL_TIME_BUCKET) + F.coalesce(digits, F.lit(0).cast("bigint")))
    return df.select(*columns, "_uk", bucket.alias("_bucket"))


def _local_flags(df: DataFrame, order: list[str], gap_seconds: int) -> DataFrame:
    """Per (user, bucket): first-row marker, gap to the previous row, the
    new-session flag of every non-first row and the running count of flags."""
    w = Window.partitionBy("_uk", "_bucket").orderBy(*order)
    first = F.lag(F.lit(1)).over(w).isNull()
    gap = F.when(~first, _gap_seconds(F.lag("event_at").over(w), F.col("event_at")))
    flag = ~first & (gap.isNull() | (gap > gap_seconds))
    running = F.sum(flag.cast("bigint")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.select("*", first.alias("_first_in_bucket"), gap.alias("_local_gap"),
                     flag.alias("_local_flag"), running.alias("_local_cum"))


def _bucket_stats(timeline: DataFrame, gap_seconds: int, bucket_seconds: int,
                  hot_users: DataFrame | None, hot_bucket_seconds: int) -> DataFrame:
    """Per (user, bucket): first and last timestamp and the number of
    in-bucket session starts (rows after the first whose gap opens one)."""
    tl = time_buckets(timeline.select(USER, "event_at", "event_pk"), bucket_seconds, hot_users,
                      hot_bucket_seconds)
    flagged = _local_flags(tl, ["event_at", "event_pk"], gap_seconds)
    return flagged.groupBy("_uk", "_bucket").agg(
        F.min("event_at").alias("_b_min"),
        F.max("event_at").alias("_b_max"),
        F.sum(F.col("_local_flag").cast("bigint")).alias("_b_local"),
    )


def _bucket_opens(gap_seconds: int) -> tuple[Column, Column]:
    """Gap from the previous bucket's last event, and whether the bucket's
    first event opens a session, over the user's buckets in time order."""
    ws = Window.partitionBy("_uk").orderBy("_bucket")
    gap = _gap_seconds(F.lag("_b_max").over(ws), F.col("_b_min"))
    return gap, gap.isNull() | (gap > gap_seconds)


def bucket_summary(timeline: DataFrame, gap_seconds: int = 1800,
                   bucket_seconds: int = DAY_SECONDS, hot_users: DataFrame | None = None,
                   hot_bucket_seconds: int = 60, prior: DataFrame | None = None) -> DataFrame:
    """Per (user, bucket): the gap from the previous bucket's last event, whether
    the bucket opens a session, and how many sessions began in earlier buckets.

    ``timeline`` holds (user_pseudo_id, event_at, event_pk) rows; the key is only
    read where the time is missing. Only timestamps matter here: repeated timestamps add gaps of 0, which never open a session, so
    the timeline may contain duplicate deliveries of an event as long as it
    has each user's distinct timestamps and the exact rows without one.
    """
    stats = _bucket_stats(timeline, gap_seconds, bucket_seconds, hot_users, hot_bucket_seconds)
    if prior is not None:
        # earlier history is one more bucket, after untimed events and before timed ones
        stats = stats.unionByName(prior.select(
            F.struct(F.col(USER).alias("u")).alias("_uk"),
            F.lit(_NULL_TIME_BUCKET + 16**UNTIMED_DIGITS).alias("_bucket"),
            F.col("last_at").alias("_b_min"), F.col("last_at").alias("_b_max"),
            (F.col("sessions") - 1).alias("_b_local")))
    gap, opens = _bucket_opens(gap_seconds)
    ws = Window.partitionBy("_uk").orderBy("_bucket")
    earlier = F.sum(opens.cast("bigint") + F.col("_b_local")).over(
        ws.rowsBetween(Window.unboundedPreceding, -1))
    return stats.select("_uk", "_bucket", gap.alias("_b_gap"), opens.alias("_b_flag"),
                        F.coalesce(earlier, F.lit(0).cast("bigint")).alias("_b_offset"))


def user_session_counts(timeline: DataFrame, gap_seconds: int = 1800,
                        bucket_seconds: int = DAY_SECONDS, hot_users: DataFrame | None = None,
                        hot_bucket_seconds: int = 60) -> DataFrame:
    """(user_pseudo_id, num_sessions): each user's number of sessions, i.e. the
    highest session number, from the bucket summary alone (no event-level
    session numbering needed)."""
    stats = _bucket_stats(timeline, gap_seconds, bucket_seconds, hot_users, hot_bucket_seconds)
    _, opens = _bucket_opens(gap_seconds)
    per_bucket = stats.select("_uk", (opens.cast("bigint") + F.col("_b_local")).alias("_n"))
    return per_bucket.groupBy("_uk").agg(F.sum("_n").alias("num_sessions")).select(
        F.col("_uk.u").alias(USER), "num_sessions")


def sessionize(stg: DataFrame, gap_seconds: int = 1800, bucket_seconds: int = DAY_SECONDS,
               hot_users: DataFrame | None = None, hot_bucket_seconds: int = 60,
               timeline: DataFrame | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Add session_number, is_session_first_event, seconds_since_previous_event,
    session_id to every staging row (one output row per input row).

    ``timeline`` (see :func:`bucket_summary`) lets the small per-bucket
    summary come from a cheap source, e.g. two columns of the raw table,
    instead of a second evaluation of ``stg``; it defaults to ``stg`` itself.

    ``prior`` (user_pseudo_id, last_at, sessions) tells where users' sessions
    stand before the first of these events, so that new days can be numbered
    without their history. All events must then have a time after ``prior``.
    """
    columns = stg.columns
    ev = time_buckets(stg, bucket_seconds, hot_users, hot_bucket_seconds)
    ev = _local_flags(ev, ["event_at", "event_pk"], gap_seconds)
    summary = bucket_summary(stg if timeline is None else timeline, gap_seconds,
                             bucket_seconds, hot_users, hot_bucket_seconds, prior)
    # every event's bucket is in the summary; one that is not must not vanish unseen
    joined = ev.join(summary, on=["_uk", "_bucket"], how="left").withColumn(
        "_b_offset", F.coalesce("_b_offset", F.raise_error(F.lit(
            "an event's time bucket is missing from the session summary")).cast("bigint")))
    first = F.col("_first_in_bucket")
    out = joined.select(
        *columns,
        (F.col("_b_offset") + F.col("_b_flag").cast("bigint") + F.col("_local_cum"))
        .alias("session_number"),
        F.when(first, F.col("_b_flag")).otherwise(F.col("_local_flag"))
        .alias("is_session_first_event"),
        F.when(first, F.col("_b_gap")).otherwise(F.col("_local_gap"))
        .alias("seconds_since_previous_event"),
        surrogate_key(F.col(USER), F.col("_b_offset") + F.col("_b_flag").cast("bigint")
                      + F.col("_local_cum")).alias("session_id"),
    )
    return out


SESSIONIZED_COLUMNS = ["event_pk", "user_pseudo_id", "event_at", "event_date", "session_number",
                       "is_session_first_event", "seconds_since_previous_event", "session_id"]


def sessionized_events(sessionized: DataFrame) -> DataFrame:
    """The intermediate model's column set."""
    return sessionized.select(*SESSIONIZED_COLUMNS)
