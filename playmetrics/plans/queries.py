"""Registered queries: Spark callables and their DuckDB oracle SQL.

Every query reads the driver's ``events`` table (through the fixture adapter)
in full, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.functions.params import extract_param, param_map
from playmetrics.functions.variants import param_variant, variant_param
from playmetrics.operators import quality as Q
from playmetrics.operators.actives import daily_bitmaps, distinct_users, numbered_users
from playmetrics.operators.core import _first_non_null
from playmetrics.operators.diff import key_diff
from playmetrics.operators.engagement import (
    retention_by_grant_of,
    retention_cohorts_of,
    retention_flags,
    rolling_returns,
)
from playmetrics.operators.masking import masked, masked_copy
from playmetrics.operators.staging import STAGING_COLUMNS, stage_events
from playmetrics.operators.table_diff import diff_report, digests
from playmetrics.plans.build import build, read_mart, scheduled_run
from playmetrics.plans.models import Models
from playmetrics.plans.oracle import with_models
from playmetrics.plans.sinks import ContractError, write_contracted, write_incremental
from playmetrics.plans.suite import Decl, declarations, sql_failures, suite_report
from playmetrics.schema import FCT_EVENTS, RAW_PARTITION_COLUMN
from playmetrics.session import configure, scratch_path
from playmetrics.sources import bounded_sql
from playmetrics.sources.batch_table import BatchTable
from playmetrics.sources.fixture_events import ECONOMY_EVENTS, read_fixture_raw
from playmetrics.sources.ledger import Ledger
from playmetrics.sources.profiles import ProfileLog
from playmetrics.sources.raw_table import (
    RawTable,
    Shards,
    frame_shards,
    load_pending,
    reload_day,
    row_day,
)
from playmetrics.streaming.event_stream import load_sessions, load_staged_events, numbered
from playmetrics.streaming.shard_stream import load_landed_shards

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str) -> Models:
    configure(spark)
    return Models(read_fixture_raw(spark, sf_dir))


STAGING_NO_KEY = [c for c in STAGING_COLUMNS if c != "event_pk"]


@register("staging_events", with_models(f"SELECT {', '.join(STAGING_NO_KEY)} FROM stg"))
def q_staging_events(spark, sf_dir):
    return models(spark, sf_dir).staging.select(*STAGING_NO_KEY)


PARAM_MODES_SQL = with_models("""
SELECT user_pseudo_id, event_at, event_name,
    NULL::VARCHAR AS level_string,
    CASE WHEN starts_with(event_name, 'level_') AND event_id % 2 = 0
        THEN CAST(1 + k % 30 AS BIGINT) END AS level_int,
    CASE WHEN starts_with(event_name, 'level_') AND event_id % 2 = 1
        THEN CAST(1 + k % 30 AS DOUBLE) END AS level_float,
    CAST(level_number AS DOUBLE) AS level_numeric,
    event_value AS value_numeric,
    CASE WHEN event_id % 2 = 0 THEN CAST(event_value AS BIGINT) END AS value_int,
    board AS board_string,
    NULL::BIGINT AS board_int,
    engagement_time_msec AS engagement_int,
    NULL::DOUBLE AS engagement_float,
    NULL::VARCHAR AS missing_string
FROM stg
""")


@register("extract_param_modes", PARAM_MODES_SQL)
def q_extract_param_modes(spark, sf_dir):
    """Each extraction mode on each param, including wrong-slot and missing keys."""
    raw = models(spark, sf_dir).raw
    keys = ["level", "value", "board", "engagement_time_msec", "no_such_key"]
    return _param_modes(raw.withColumn("_p", param_map("event_params", keys)), extract_param)


@register("param_variant_modes", PARAM_MODES_SQL)
def q_param_variant_modes(spark, sf_dir):
    """The same modes on params that were stored as shredded VARIANT objects."""
    raw, stored = models(spark, sf_dir).raw, scratch_path(spark, "variant-params")
    raw.select("user_pseudo_id", "event_timestamp", "event_name",
               param_variant("event_params").alias("_p")).write.parquet(stored)
    return _param_modes(spark.read.parquet(stored), variant_param)


def _param_modes(rows: DataFrame, of: Callable) -> DataFrame:
    m = F.col("_p")
    return rows.select(
        "user_pseudo_id", F.timestamp_micros("event_timestamp").alias("event_at"), "event_name",
        of(m, "level", "string").alias("level_string"),
        of(m, "level", "int").alias("level_int"),
        of(m, "level", "float").alias("level_float"),
        of(m, "level", "numeric").alias("level_numeric"),
        of(m, "value", "numeric").alias("value_numeric"),
        of(m, "value", "int").alias("value_int"),
        of(m, "board", "string").alias("board_string"),
        of(m, "board", "int").alias("board_int"),
        of(m, "engagement_time_msec", "int").alias("engagement_int"),
        of(m, "engagement_time_msec", "float").alias("engagement_float"),
        of(m, "no_such_key", "string").alias("missing_string"),
    )


@register("session_gaps", with_models("""
SELECT user_pseudo_id, event_at, seconds_since_previous_event FROM ev_gaps
"""))
def q_session_gaps(spark, sf_dir):
    return models(spark, sf_dir).sessionized.select(
        "user_pseudo_id", "event_at", "seconds_since_previous_event")


SESSION_COLS = ["user_pseudo_id", "event_at", "event_date", "session_number",
                "is_session_first_event", "seconds_since_previous_event", "session_id"]


@register("sessionized_events", with_models(f"SELECT {', '.join(SESSION_COLS)} FROM sess"))
def q_sessionized_events(spark, sf_dir):
    return models(spark, sf_dir).int_events_sessionized.select(*SESSION_COLS)


@register("user_days", with_models("SELECT * FROM user_days"))
def q_user_days(spark, sf_dir):
    return models(spark, sf_dir).int_user_days


# the content key is hashed from engine-specific JSON text, so it is not compared
FCT_NO_KEY = [c for c in FCT_EVENTS.fieldNames() if c != "event_pk"]


@register("fct_events", with_models(f"SELECT {', '.join(FCT_NO_KEY)} FROM fct_events"))
def q_fct_events(spark, sf_dir):
    return models(spark, sf_dir).fct_events.select(*FCT_NO_KEY)


@register("dim_users", with_models("SELECT * FROM dim_users"))
def q_dim_users(spark, sf_dir):
    return models(spark, sf_dir).dim_users


@register("first_last_value", with_models("""
SELECT user_pseudo_id,
    arg_min(country, event_at) FILTER (WHERE country IS NOT NULL) AS first_country,
    arg_max(country, event_at) FILTER (WHERE country IS NOT NULL) AS last_country,
    arg_min(acquisition_medium, event_at) FILTER (WHERE acquisition_medium IS NOT NULL)
        AS first_medium,
    arg_max(acquisition_medium, event_at) FILTER (WHERE acquisition_medium IS NOT NULL)
        AS last_medium,
    count_if(country IS NULL) AS null_countries
FROM stg GROUP BY user_pseudo_id
"""))
def q_first_last_value(spark, sf_dir):
    """Earliest / latest non-NULL value by time, on columns with NULLs planted
    by the fixture (country NULL on every 7th event, medium on every 4th)."""
    stg = models(spark, sf_dir).staging
    return stg.groupBy("user_pseudo_id").agg(
        _first_non_null("country").alias("first_country"),
        _first_non_null("country", latest=True).alias("last_country"),
        _first_non_null("acquisition_medium").alias("first_medium"),
        _first_non_null("acquisition_medium", latest=True).alias("last_medium"),
        F.count_if(F.col("country").isNull()).alias("null_countries"),
    )


@register("daily_active_users", with_models("SELECT * FROM daily_active_users"))
def q_daily_active_users(spark, sf_dir):
    return models(spark, sf_dir).daily_active_users


@register("retention_cohorts", with_models("SELECT * FROM retention_cohorts"))
def q_retention_cohorts(spark, sf_dir):
    return models(spark, sf_dir).retention_cohorts


@register("retention_by_grant", with_models("SELECT * FROM retention_by_grant"))
def q_retention_by_grant(spark, sf_dir):
    return models(spark, sf_dir).retention_by_extra_steps_grant


@register("level_funnel_daily", with_models("SELECT * FROM level_funnel_daily"))
def q_level_funnel_daily(spark, sf_dir):
    return models(spark, sf_dir).level_funnel_daily


@register("economy_daily", with_models("SELECT * FROM economy_daily"))
def q_economy_daily(spark, sf_dir):
    return models(spark, sf_dir).extra_steps_economy_daily


# ---------------------------------------------------------------- activity bitmaps

RETENTION_ON = (1, 2, 3, 7, 14, 21, 30)
RETURN_RANGES = ((1, 3), (1, 7), (8, 14), (15, 70))


@register("retention_any_day", with_models(f"""
SELECT cohort_date, count(*) AS cohort_size,
    {", ".join(f"count_if(list_contains(days, cohort_date + {d})) AS retained_d{d}"
               for d in RETENTION_ON)},
    {", ".join(f"CASE WHEN cohort_date + {d} <= any_value(last_date) "
               f"THEN round(retained_d{d} / cohort_size, 4) END AS retention_d{d}"
               for d in RETENTION_ON)}
FROM openers GROUP BY cohort_date
"""))
def q_retention_any_day(spark, sf_dir):
    """Retention on any days, from one bitmap of active days per user."""
    totals = models(spark, sf_dir).user_totals
    newest = totals.where("user_pseudo_id is not null").agg(F.max("last_seen_date")).scalar()
    return retention_cohorts_of(retention_flags(totals, RETENTION_ON), newest, RETENTION_ON)


@register("retention_grant_bitmap", with_models("SELECT * FROM retention_by_grant"))
def q_retention_grant_bitmap(spark, sf_dir):
    """The retention-by-grant mart from bitmaps, without the spine."""
    totals = models(spark, sf_dir).user_totals
    newest = totals.where("user_pseudo_id is not null").agg(F.max("last_seen_date")).scalar()
    return retention_by_grant_of(retention_flags(totals), newest)


@register("rolling_returns", with_models(f"""
, ranges(first_day, last_day) AS (VALUES {", ".join(map(str, RETURN_RANGES))})
SELECT cohort_date, first_day, last_day, count(*) AS cohort_size,
    count_if(len(list_filter(days, lambda d: d >= cohort_date + first_day
                             AND d <= cohort_date + last_day)) > 0) AS returned,
    CASE WHEN cohort_date + last_day <= any_value(last_date)
        THEN round(returned / cohort_size, 4) END AS return_rate
FROM openers, ranges GROUP BY cohort_date, first_day, last_day
"""))
def q_rolling_returns(spark, sf_dir):
    """Users who come back on any day of a range after their first open."""
    totals = models(spark, sf_dir).user_totals
    newest = totals.where("user_pseudo_id is not null").agg(F.max("last_seen_date")).scalar()
    return rolling_returns(retention_flags(totals, (), RETURN_RANGES), newest, RETURN_RANGES)


@register("distinct_users_by_period", with_models("""
, periods AS (
    SELECT 'week' AS grain, CAST(date_trunc('week', event_date) AS DATE) AS period, * FROM stg
    UNION ALL
    SELECT 'month' AS grain, CAST(date_trunc('month', event_date) AS DATE) AS period, * FROM stg)
SELECT grain, period, count(DISTINCT user_pseudo_id) AS active_users,
    count(DISTINCT user_pseudo_id) FILTER (event_name = 'spend_virtual_currency') AS spender_users,
    count(DISTINCT user_pseudo_id) FILTER (event_name = 'level_start_quickplay') AS starter_users
FROM periods GROUP BY grain, period
"""))
def q_distinct_users_by_period(spark, sf_dir):
    """Weekly and monthly distinct users, from daily bitmaps stored in two loads, the second
    of which numbers its new users on."""
    raw = models(spark, sf_dir).raw
    stored, numbers = scratch_path(spark, "daily-bitmaps"), None
    for rows in _halves(raw):
        events = stage_events(rows)
        path = scratch_path(spark, "user-numbers")
        numbered_users(events, numbers).write.parquet(path)
        numbers = spark.read.parquet(path)
        daily_bitmaps(events, numbers).write.mode("append").parquet(stored)
    bitmaps = spark.read.parquet(stored)
    parts = [distinct_users(bitmaps, F.date_trunc(grain, "event_date").cast("date")).withColumn(
        "grain", F.lit(grain)) for grain in ("week", "month")]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- board difficulty

# Another route than the operator's: each outcome looks back for the start it belongs
# to, and a start then takes the earliest outcome that chose it.
ATTEMPTS_SQL = """
, starts AS (
    SELECT user_pseudo_id, board, event_at, event_id,
        CAST(date_trunc('week', event_date) AS DATE) AS week
    FROM stg WHERE event_name = 'level_start_quickplay' AND board IS NOT NULL),
outcomes AS (
    SELECT user_pseudo_id AS who, board AS on_board, event_at AS ended_at,
        CASE event_name WHEN 'level_complete_quickplay' THEN 'completed'
            WHEN 'level_fail_quickplay' THEN 'failed' WHEN 'level_reset_quickplay' THEN 'reset'
            WHEN 'level_retry_quickplay' THEN 'retried' END AS outcome
    FROM stg),
owned AS (
    SELECT s.event_id, arg_min(outcome, (ended_at, outcome)) AS outcome, min(ended_at) AS ended_at
    FROM (SELECT * FROM outcomes WHERE outcome IS NOT NULL) o
    ASOF JOIN starts s ON s.user_pseudo_id = o.who AND s.board = o.on_board
        AND o.ended_at > s.event_at
    GROUP BY s.event_id),
tries AS (
    SELECT s.*, coalesce(outcome, 'unfinished') AS outcome,
        (epoch_us(ended_at) - epoch_us(s.event_at)) // 1000000 AS seconds
    FROM starts s LEFT JOIN owned USING (event_id))
"""


@register("board_difficulty_weekly", with_models(ATTEMPTS_SQL + """
, weekly AS (
    SELECT week, board, count(DISTINCT user_pseudo_id) AS players, count(*) AS attempts,
        count_if(outcome = 'completed') AS completed, count_if(outcome = 'failed') AS failed,
        count_if(outcome = 'reset') AS reset, count_if(outcome = 'retried') AS retried,
        count_if(outcome = 'unfinished') AS unfinished,
        sum(seconds) FILTER (WHERE outcome = 'completed') AS total_seconds
    FROM tries GROUP BY week, board),
rated AS (
    SELECT week, board, players, attempts, completed, failed, reset, retried, unfinished,
        round(completed / attempts, 4) AS completion_rate,
        round((retried + reset) / attempts, 4) AS retry_reset_rate,
        CASE WHEN completed > 0 THEN round(total_seconds / completed, 1) END
            AS seconds_to_complete
    FROM weekly)
SELECT r.*, round(r.completion_rate - b.completion_rate, 4) AS completion_rate_change
FROM rated r LEFT JOIN rated b ON b.board = r.board
    AND b.week = (SELECT max(week) FROM rated x WHERE x.board = r.board AND x.week < r.week)
"""))
def q_board_difficulty_weekly(spark, sf_dir):
    """Attempts per quickplay board and week: outcomes, rates and the weekly change."""
    return models(spark, sf_dir).board_difficulty_weekly


@register("board_migration_weekly", with_models(ATTEMPTS_SQL + """
, begun AS (
    SELECT user_pseudo_id, (list(board ORDER BY event_at, board))[1] AS first_board
    FROM starts GROUP BY user_pseudo_id),
active AS (
    SELECT first_board, week, count(DISTINCT user_pseudo_id) AS active_players
    FROM starts JOIN begun USING (user_pseudo_id) GROUP BY ALL)
SELECT first_board, week, board, count(DISTINCT user_pseudo_id) AS players,
    any_value(active_players) AS active_players,
    round(count(DISTINCT user_pseudo_id) / any_value(active_players), 4) AS player_share,
    count(*) AS attempts, round(count_if(outcome = 'completed') / count(*), 4) AS completion_rate
FROM tries JOIN begun USING (user_pseudo_id) JOIN active USING (first_board, week)
GROUP BY first_board, week, board
"""))
def q_board_migration_weekly(spark, sf_dir):
    """Whether players come back to their first board or move to others, by week."""
    return models(spark, sf_dir).board_migration_weekly


# ---------------------------------------------------------------- ingest

FIRST_DAY_SQL = "(SELECT min(CAST(ts AS DATE)) FROM events)"
LAST_DAY_SQL = "(SELECT max(CAST(ts AS DATE)) FROM events)"


def _loaded(spark: SparkSession, shards: Shards) -> tuple[RawTable, Ledger]:
    """Every shard loaded into a fresh raw table under the checkpoint folder."""
    table = RawTable(spark, scratch_path(spark, "raw-events"))
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    ledger.begin(shards.days()[0])
    load_pending(table, shards, ledger, most=None)
    return table, ledger


def _all_rows(table: RawTable) -> DataFrame:
    """Every loaded day, through the mandatory bound."""
    days = table.days()
    return table.read(days[0], days[-1])


@register("bounded_scan", with_models(f"""
SELECT event_date, count(*) AS num_events, count(DISTINCT user_pseudo_id) AS num_users
FROM stg WHERE event_date BETWEEN {FIRST_DAY_SQL} AND {LAST_DAY_SQL}
GROUP BY event_date
"""))
def q_bounded_scan(spark, sf_dir):
    """Load every day into the raw table, read it back through the mandatory
    day bound (a partition filter), and stage it."""
    table, _ = _loaded(spark, frame_shards(read_fixture_raw(spark, sf_dir)))
    return stage_events(_all_rows(table)).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("num_events"),
        F.count_distinct("user_pseudo_id").alias("num_users"))


@register("partition_stats", """
SELECT CAST(ts AS DATE) AS shard_date, count(*) AS num_rows, true AS has_bytes
FROM events GROUP BY 1
""")
def q_partition_stats(spark, sf_dir):
    table, _ = _loaded(spark, frame_shards(read_fixture_raw(spark, sf_dir)))
    days = table.days()
    return table.stats(days[0], days[-1]).select(
        "shard_date", "num_rows", (F.col("num_bytes") > F.col("num_rows")).alias("has_bytes"))


@register("load_ledger", """
SELECT CAST(ts AS DATE) AS day, count(*) AS num_rows, true AS has_bytes,
    dense_rank() OVER (ORDER BY CAST(ts AS DATE)) = 1 AS first_load
FROM events GROUP BY 1
""")
def q_load_ledger(spark, sf_dir):
    """What two loads (one day, then all pending) have recorded for each day."""
    shards = frame_shards(read_fixture_raw(spark, sf_dir))
    table = RawTable(spark, scratch_path(spark, "raw-events"))
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    ledger.begin(shards.days()[0])
    load_pending(table, shards, ledger)
    load_pending(table, shards, ledger, most=None)
    entries = spark.read.parquet(ledger.path).where("action = 'load'")
    return entries.select("day", "num_rows", (F.col("num_bytes") > 0).alias("has_bytes"),
                          (F.col("version") == 2).alias("first_load"))


@register("load_append", f"""
SELECT CAST(ts AS DATE) AS shard_date,
    count(*) * CASE WHEN CAST(ts AS DATE) = {FIRST_DAY_SQL} THEN 2 ELSE 1 END AS num_rows,
    count(DISTINCT event_id) AS num_events
FROM events GROUP BY 1
""")
def q_load_append(spark, sf_dir):
    """Every day replaced, then the first appended once more: its rows are there twice."""
    shards = frame_shards(read_fixture_raw(spark, sf_dir))
    table, _ = _loaded(spark, shards)
    table.append(shards, table.days()[:1])
    return _all_rows(table).groupBy("shard_date").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_distinct("event_bundle_sequence_id").alias("num_events"))


@register("round_and_safe_cast", with_models("""
SELECT user_pseudo_id, event_at, event_name,
    CASE WHEN starts_with(event_name, 'level_')
        THEN CAST(round((event_id % 9 - 4) / 2.0) AS BIGINT) END AS level_number,
    CASE WHEN event_id % 3 <> 0 THEN initial_extra_steps END AS initial_extra_steps
FROM stg
"""))
def q_round_and_safe_cast(spark, sf_dir):
    """Levels in halves (-2 to 2) and grants of which a third are no integers."""
    configure(spark)
    raw, number = read_fixture_raw(spark, sf_dir), F.col("event_bundle_sequence_id")

    def halves(p):
        level = F.struct(p["key"].alias("key"), F.struct(
            F.lit(None).cast("string").alias("string_value"),
            F.lit(None).cast("bigint").alias("int_value"),
            F.lit(None).cast("double").alias("float_value"),
            ((number % 9 - 4) / 2.0).alias("double_value")).alias("value"))
        return F.when(p["key"] == "level", level).otherwise(p)

    def spoiled(p):
        text = F.when(number % 3 == 0, F.concat(p["value"]["string_value"], F.lit(" steps")))
        value = p["value"].withField("string_value", F.coalesce(text, p["value"]["string_value"]))
        return p.withField("value", value)

    changed = raw.withColumn("event_params", F.transform("event_params", halves)).withColumn(
        "user_properties", F.transform("user_properties", spoiled))
    return stage_events(changed).select("user_pseudo_id", "event_at", "event_name",
                                        "level_number", "initial_extra_steps")


@register("contracted_sink", with_models("""
SELECT attempt, attempt = 'as declared' AS written, count(*) AS num_rows
FROM fct_events, (VALUES ('as declared'), ('extra column'), ('missing column'), ('other type'))
    attempts(attempt) GROUP BY attempt
"""))
def q_contracted_sink(spark, sf_dir):
    """The fact table written under its contract; frames that break it leave it as it was."""
    fct = models(spark, sf_dir).fct_events
    path, outcomes = scratch_path(spark, "contracted"), None
    for attempt, rows in (("as declared", fct), ("extra column", fct.withColumn("more", F.lit(1))),
                          ("missing column", fct.drop("board")),
                          ("other type", fct.withColumn("score", F.col("score").cast("string")))):
        try:
            write_contracted(rows, FCT_EVENTS, path, "fct_events")
            written = True
        except ContractError:
            written = False
        now = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(attempt).alias("attempt"), F.lit(written).alias("written"), "num_rows")
        outcomes = now if outcomes is None else outcomes.unionByName(now)
    return outcomes


@register("blocked_build", with_models("""
SELECT event_date, count(*) AS num_events, true AS was_blocked FROM fct_events
WHERE NOT (starts_with(event_name, 'level') AND ends_with(event_name, 'quickplay'))
GROUP BY event_date
"""))
def q_blocked_build(spark, sf_dir):
    """A second build breaks a rule of error severity (its window ends before its events), so
    the marts of the first one stay."""
    configure(spark)
    # without the funnel events, whose random counts break another rule
    raw = read_fixture_raw(spark, sf_dir).where(~F.col("event_name").like("level%quickplay"))
    days, out = frame_shards(raw).days(), scratch_path(spark, "marts")
    build(spark, raw, out, days[0], days[-1], volume_band=(0, 1 << 40))
    try:
        build(spark, raw.where(F.col("event_name") != "app_remove"), out, days[0], days[-3],
              volume_band=(0, 1 << 40))
        blocked = False
    except Q.QualityError:
        blocked = True
    return read_mart(spark, out, "fct_events").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("num_events")).withColumn("was_blocked", F.lit(blocked))


STRAY, UNDATED = 50, 75  # every so many-th event is dated a day early, or not at all


@register("load_stray_dates", f"""
SELECT CAST(ts AS DATE) AS shard_date, count(*) AS num_rows,
    count(*) FILTER (WHERE event_id % {UNDATED} <> 0 AND event_id % {STRAY} = 0) AS num_stray,
    count(*) FILTER (WHERE event_id % {UNDATED} = 0) AS num_undated
FROM events GROUP BY 1
""")
def q_load_stray_dates(spark, sf_dir):
    """Shards whose rows carry other days' dates or none, loaded one day, then
    the rest, then the first again: every row stays in its shard."""
    number = F.col("event_bundle_sequence_id")
    raw = read_fixture_raw(spark, sf_dir).withColumn("true_day", row_day())
    early = F.date_format(F.date_sub("true_day", 1), "yyyyMMdd")
    raw = raw.withColumn("event_date", F.when(number % UNDATED == 0, F.lit(None)).when(
        number % STRAY == 0, early).otherwise(F.col("event_date")))
    shards = frame_shards(raw, F.col("true_day"))
    table, _ = _loaded(spark, shards)
    table.replace(shards, table.days()[:1])
    dated = F.to_date("event_date", "yyyyMMdd")
    return _all_rows(table).groupBy("shard_date").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(dated != F.col("shard_date")).alias("num_stray"),
        F.count_if(dated.isNull()).alias("num_undated"))


def _last_day_again(raw: DataFrame) -> DataFrame:
    """The last day's rows as a second delivery, differing only in the server
    offset (metadata the staging model drops)."""
    last = raw.agg(F.max("event_date")).scalar()
    return raw.where(F.col("event_date") == last).withColumn(
        "event_server_timestamp_offset", F.lit(17).cast("bigint"))


def _redelivered_raw(raw: DataFrame) -> DataFrame:
    return raw.unionByName(_last_day_again(raw))


@register("staging_dedup", with_models(f"""
SELECT event_date,
    count(*) * CASE WHEN event_date = {LAST_DAY_SQL} THEN 2 ELSE 1 END AS raw_rows,
    count(*) AS staged_events
FROM stg GROUP BY event_date
"""))
def q_staging_dedup(spark, sf_dir):
    """Re-delivered events collapse: raw rows per day vs. staged events per day."""
    configure(spark)
    raw = _redelivered_raw(read_fixture_raw(spark, sf_dir))
    stg = stage_events(raw)
    r = raw.groupBy(F.to_date("event_date", "yyyyMMdd").alias("event_date")).agg(
        F.count(F.lit(1)).alias("raw_rows"))
    s = stg.groupBy("event_date").agg(F.count(F.lit(1)).alias("staged_events"))
    return r.join(s, "event_date", "inner")


@register("monitor_redelivery", with_models(f"""
SELECT event_date, count(*) * 2 AS raw_rows, count(*) AS staged_rows, CAST(2 AS DOUBLE) AS ratio
FROM stg WHERE event_date = {LAST_DAY_SQL} GROUP BY event_date
"""))
def q_monitor_redelivery(spark, sf_dir):
    """Raw rows per staged event by day, flagging the re-delivered day (the
    volume band alone cannot see it: it counts deduplicated events)."""
    configure(spark)
    raw = _redelivered_raw(read_fixture_raw(spark, sf_dir))
    return Q.duplicate_ratio(raw, stage_events(raw))


@register("stream_load", """
SELECT CAST(ts AS DATE) AS shard_date, count(*) AS num_rows,
    count(DISTINCT user_id) AS num_users
FROM events GROUP BY 1
""")
def q_stream_load(spark, sf_dir):
    """Shards landed as files (two deliveries for every day), picked up by the
    availableNow file stream into the raw table, read back through the bound."""
    raw = read_fixture_raw(spark, sf_dir)
    landing, table = scratch_path(spark, "landing"), RawTable(spark, scratch_path(spark, "raw"))
    checkpoint = scratch_path(spark, "stream-ckpt")
    tagged = raw.withColumn("shard", F.date_format(row_day(), "yyyyMMdd"))
    for part in (0, 1):
        late = tagged.where(F.col("event_bundle_sequence_id") % 2 == part)
        late.hint("rebalance", "shard").write.partitionBy("shard").mode("append").parquet(landing)
        load_landed_shards(spark, landing, table.path, checkpoint, pattern="shard=%Y%m%d")
    return _all_rows(table).groupBy("shard_date").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_distinct("user_pseudo_id").alias("num_users"))


SHARD_FOLDER = "shard=%Y%m%d"


def _land(rows: DataFrame, landing: str) -> None:
    """Raw rows as files of their day's folder."""
    tagged = rows.withColumn("shard", F.date_format(row_day(), "yyyyMMdd"))
    tagged.hint("rebalance", "shard").write.partitionBy("shard").mode("append").parquet(landing)


def _halves(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The earlier and the later half of the days."""
    middle = raw.agg(F.expr("percentile_disc(0.5) within group (order by event_date)")).scalar()
    return raw.where(F.col("event_date") <= middle), raw.where(F.col("event_date") > middle)


STREAM_DELAY_HOURS = 48


@register("stream_sessions", with_models(f"""
, all_sessions AS (
    SELECT user_pseudo_id, session_number, session_id, min(event_at) AS started_at,
        max(event_at) AS ended_at, count(*) AS num_events
    FROM sess GROUP BY ALL),
seen AS (SELECT epoch_us(max(event_at)) // 1000 * 1000 AS newest FROM stg)
SELECT a.* FROM all_sessions a, seen
WHERE epoch_us(ended_at) + 1800999999 <= newest - {STREAM_DELAY_HOURS} * 3600000000
"""))
def q_stream_sessions(spark, sf_dir):
    """Sessions that the stream has closed, over two landings of which the second
    delivers the last day of the first once more."""
    configure(spark)
    early, later = _halves(read_fixture_raw(spark, sf_dir))
    landing, out, checkpoint = (scratch_path(spark, f"sessions-{x}") for x in ("in", "out", "ckpt"))
    closed = None
    for rows in (early, later.unionByName(_last_day_again(early))):
        _land(rows, landing)
        closed = load_sessions(spark, landing, out, checkpoint, f"{STREAM_DELAY_HOURS} hours",
                               pattern=SHARD_FOLDER)
    return numbered(closed)


@register("stream_dedup", with_models(f"""
SELECT event_date,
    count(*) * CASE WHEN event_date = {LAST_DAY_SQL} THEN 2 ELSE 1 END AS raw_rows,
    count(*) AS staged_events
FROM stg GROUP BY event_date
"""))
def q_stream_dedup(spark, sf_dir):
    """The last day is delivered again in a later batch; the stream stages it once."""
    configure(spark)
    raw = read_fixture_raw(spark, sf_dir)
    landing, out, checkpoint = (scratch_path(spark, f"staged-{x}") for x in ("in", "out", "ckpt"))
    staged = None
    for rows in (*_halves(raw), _last_day_again(raw)):
        _land(rows, landing)
        staged = load_staged_events(spark, landing, out, checkpoint, f"{STREAM_DELAY_HOURS} hours",
                                    pattern=SHARD_FOLDER)
    delivered = spark.read.parquet(landing).groupBy(
        F.to_date("event_date", "yyyyMMdd").alias("event_date")).agg(
        F.count(F.lit(1)).alias("raw_rows"))
    return delivered.join(staged.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("staged_events")), "event_date")


@register("stream_late_rows", with_models(f"""
SELECT (SELECT count(*) FROM stg) AS staged_events, count(*) AS late_rows
FROM stg WHERE event_date = {FIRST_DAY_SQL}
"""))
def q_stream_late_rows(spark, sf_dir):
    """The first day comes again after everything else, past the watermark: counted, not staged."""
    configure(spark)
    raw = read_fixture_raw(spark, sf_dir)
    landing, out, checkpoint = (scratch_path(spark, f"late-{x}") for x in ("in", "out", "ckpt"))
    first = raw.agg(F.min("event_date")).scalar()
    staged = None
    for rows in (raw, raw.where(F.col("event_date") == first)):
        _land(rows, landing)
        staged = load_staged_events(spark, landing, out, checkpoint, f"{STREAM_DELAY_HOURS} hours",
                                    pattern=SHARD_FOLDER)
    late = F.lit(BatchTable(spark, out).late_rows()).cast("bigint")
    return staged.agg(F.count(F.lit(1)).alias("staged_events")).withColumn("late_rows", late)


def _daily_builds(spark: SparkSession, sf_dir: str) -> str:
    """Marts after a first build of most days and two scheduled runs, of which the second
    also finds an older day that was loaded again."""
    shards = frame_shards(read_fixture_raw(spark, sf_dir))
    table = RawTable(spark, scratch_path(spark, "raw-events"))
    ledger, out = Ledger(spark, scratch_path(spark, "ledger")), scratch_path(spark, "marts")
    days = shards.days()
    ledger.begin(days[0])
    # the fixture's random funnel breaks a declared rule, so the builds must not block
    options = {"block_on_errors": False, "volume_band": (0, 1 << 40)}
    scheduled_run(spark, shards, table, ledger, out, max(len(days) - 3, 1), **options)
    scheduled_run(spark, shards, table, ledger, out, 1, **options)
    reload_day(table, shards, ledger, days[-3])
    scheduled_run(spark, shards, table, ledger, out, None, **options)
    return out


@register("daily_builds_users", with_models("SELECT * FROM dim_users"))
def q_daily_builds_users(spark, sf_dir):
    """The user dimension after daily builds that add new days to the totals of active users."""
    configure(spark)
    return read_mart(spark, _daily_builds(spark, sf_dir), "dim_users")


@register("daily_builds_actives", with_models("SELECT * FROM daily_active_users"))
def q_daily_builds_actives(spark, sf_dir):
    """Daily actives after daily builds: new users come from the first days of active ones."""
    configure(spark)
    return read_mart(spark, _daily_builds(spark, sf_dir), "daily_active_users")


@register("reload_marks_days", with_models(f"""
SELECT event_date, count(*) AS num_events, count_if(platform IS NULL) AS null_platform
FROM fct_events GROUP BY event_date
"""))
def q_reload_marks_days(spark, sf_dir):
    """A day is built from a masked shard, its shard is repaired and loaded again, and the
    next scheduled run brings the marts up to date by itself."""
    configure(spark)
    shards = frame_shards(read_fixture_raw(spark, sf_dir))
    days = shards.days()
    bad = frame_shards(masked(shards.read(days).drop(RAW_PARTITION_COLUMN), "platform", 0.5,
                              NULL_SPIKE_SEED, F.col("event_date") == f"{days[3]:%Y%m%d}"))
    table = RawTable(spark, scratch_path(spark, "raw-events"))
    ledger, out = Ledger(spark, scratch_path(spark, "ledger")), scratch_path(spark, "marts")
    ledger.begin(days[0])
    options = {"block_on_errors": False, "volume_band": (0, 1 << 40)}
    scheduled_run(spark, bad, table, ledger, out, None, **options)
    reload_day(table, shards, ledger, days[3])
    scheduled_run(spark, shards, table, ledger, out, None, **options)
    return read_mart(spark, out, "fct_events").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("num_events"),
        F.count_if(F.col("platform").isNull()).alias("null_platform"))


@register("fct_events_incremental", with_models("""
SELECT event_date, count(*) AS num_events, count(DISTINCT session_id) AS num_sessions
FROM sess GROUP BY event_date
"""))
def q_fct_events_incremental(spark, sf_dir):
    """Fact built through the last day but two, then the rest is loaded and an
    incremental run rewrites only the last existing day and the one before onward."""
    shards = frame_shards(read_fixture_raw(spark, sf_dir))
    table = RawTable(spark, scratch_path(spark, "raw-events"))
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    fct_path = scratch_path(spark, "fct-events")
    days = shards.days()
    ledger.begin(days[0])
    for most in (max(len(days) - 2, 1), None):
        load_pending(table, shards, ledger, most)
        m = Models(table.read(days[0], ledger.state().last_day))
        write_incremental(spark, m.fct_events, FCT_EVENTS, fct_path)
    return spark.read.parquet(fct_path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("num_events"),
        F.count_distinct("session_id").alias("num_sessions"))


# ---------------------------------------------------------------- masking, monitors

NULL_SPIKE_PCT = 0.35
NULL_SPIKE_SEED = "null-spike"
NULL_SELECTED_SQL = (
    "CAST(('0x' || substr(md5('" + NULL_SPIKE_SEED + "' || ':' || CAST(epoch_us(event_at) AS VARCHAR)"
    " || ':' || user_pseudo_id || ':' || event_name), 1, 8)) AS BIGINT) / 4294967296.0 < "
    + str(NULL_SPIKE_PCT))
FAULTED_STG_SQL = f"""
faulted AS (
    SELECT * REPLACE (CASE WHEN event_date = {LAST_DAY_SQL} AND {NULL_SELECTED_SQL}
                      THEN NULL ELSE platform END AS platform)
    FROM stg
)"""


def _with_faulted(final_select: str) -> str:
    return with_models(",\n" + FAULTED_STG_SQL.strip() + "\n" + final_select)


def _masked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of the raw table with platform nulled on 35% of the last day's rows."""
    table, _ = _loaded(spark, frame_shards(read_fixture_raw(spark, sf_dir)))
    copy = RawTable(spark, scratch_path(spark, "masked-events"))
    last = F.col(RAW_PARTITION_COLUMN) == F.lit(table.days()[-1])
    masked_copy(_all_rows(table), copy.path, "platform", NULL_SPIKE_PCT, NULL_SPIKE_SEED, last)
    return _all_rows(copy)


@register("null_out_column", _with_faulted("""
SELECT event_date, count(*) AS num_events, count_if(platform IS NULL) AS null_platform
FROM faulted GROUP BY event_date
"""))
def q_null_out_column(spark, sf_dir):
    """platform masked on a reproducible share of one day, in a copy of the table."""
    return stage_events(_masked_rows(spark, sf_dir)).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("num_events"),
        F.count_if(F.col("platform").isNull()).alias("null_platform"))


@register("monitor_null_rate", _with_faulted("""
SELECT event_date, round(count_if(platform IS NULL) / count(*), 4) AS null_rate
FROM faulted GROUP BY event_date HAVING count_if(platform IS NULL) / count(*) > 0.01
"""))
def q_monitor_null_rate(spark, sf_dir):
    return Q.null_rate(stage_events(_masked_rows(spark, sf_dir)), "platform", 0.01)


@register("table_diff", _with_faulted(f"""
SELECT count(*) AS a_rows, count(*) AS b_rows,
    count_if(event_date = {LAST_DAY_SQL} AND {NULL_SELECTED_SQL}) AS only_in_a,
    count_if(event_date = {LAST_DAY_SQL} AND {NULL_SELECTED_SQL}) AS only_in_b,
    count(*) - count_if(event_date = {LAST_DAY_SQL} AND {NULL_SELECTED_SQL}) AS in_both
FROM stg
"""))
def q_table_diff(spark, sf_dir):
    """Key diff of staging before and after the masking: every touched row
    gets a new content key."""
    clean = stage_events(read_fixture_raw(spark, sf_dir))
    return key_diff(clean, stage_events(_masked_rows(spark, sf_dir)), "event_pk")


# ---------------------------------------------------------------- bounded SQL, profiles, digests

@register("bounded_sql", with_models("""
SELECT event_date AS shard_date, count(*) AS num_rows, count(DISTINCT user_pseudo_id) AS num_users,
    count(board) AS with_board
FROM stg, (SELECT min(event_date) AS first FROM stg)
WHERE event_date BETWEEN first + 2 AND first + 20 GROUP BY event_date
"""))
def q_bounded_sql(spark, sf_dir):
    """A SQL statement over the raw table, whose days are arguments that cannot be left out."""
    table, _ = _loaded(spark, frame_shards(read_fixture_raw(spark, sf_dir)))
    bounded_sql.register(table)
    first = table.days()[0]
    return spark.sql(f"""
        SELECT shard_date, count(*) AS num_rows, count(DISTINCT user_pseudo_id) AS num_users,
            count_if(exists(event_params, p -> p.key = 'board')) AS with_board
        FROM raw_events(DATE '{first}' + 2, DATE '{first}' + 20) GROUP BY shard_date""")


NEW_KEY, NEW_SLOT, NO_COUNTRY, SHARE_SHIFT = 10, 15, 20, 500  # days after the first; of 10,000 rows


def _drifting_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with a param that comes later, one whose slot changes, and a column that goes."""
    raw = read_fixture_raw(spark, sf_dir)
    nth = F.date_diff(row_day(), F.lit(raw.agg(F.min(row_day())).first()[0]))
    empty = F.struct(*[F.lit(None).cast(t).alias(f"{n}_value") for n, t in (
        ("string", "string"), ("int", "bigint"), ("float", "double"), ("double", "double"))])
    combo = F.array(F.struct(F.lit("combo").alias("key"),
                             empty.withField("int_value", F.lit(1).cast("bigint")).alias("value")))

    def retyped(p):
        text = empty.withField("string_value", p["value"]["double_value"].cast("string"))
        return F.when((p["key"] == "score") & (nth >= NEW_SLOT), p.withField("value", text)).otherwise(p)

    has_combo = (nth >= NEW_KEY) & (F.col("event_name") == "user_engagement")
    params = F.transform("event_params", retyped)
    country = F.when(nth < NO_COUNTRY, F.col("geo.country"))
    return raw.withColumn("event_params", F.when(has_combo, F.concat(params, combo)).otherwise(
        params)).withColumn("geo", F.col("geo").withField("country", country))


_DRIFT_NAMES = [  # scope, name, kind, condition; names that are in all rows of every day are left out
    *[("event_params", name, "string_value", f"{column} IS NOT NULL") for name, column in (
        ("board", "board"), ("level_name", "level_name"), ("item_name", "item_name"),
        ("virtual_currency_name", "virtual_currency_name"), ("firebase_screen", "screen_name"),
        ("firebase_screen_class", "screen_class"))],
    *[("event_params", name, kind, f"{column} IS NOT NULL AND event_id % 2 = {odd}")
      for name, column in (("level", "level_number"), ("value", "event_value"))
      for odd, kind in enumerate(("int_value", "double_value"))],
    ("event_params", "engagement_time_msec", "int_value", "engagement_time_msec IS NOT NULL"),
    ("event_params", "score", "double_value", f"score IS NOT NULL AND nth < {NEW_SLOT}"),
    ("event_params", "score", "string_value", f"score IS NOT NULL AND nth >= {NEW_SLOT}"),
    ("event_params", "combo", "int_value", f"event_name = 'user_engagement' AND nth >= {NEW_KEY}"),
    ("user_properties", "initial_extra_steps", "string_value", "initial_extra_steps IS NOT NULL"),
    ("column", "geo.country", "string", f"country IS NOT NULL AND nth < {NO_COUNTRY}"),
    ("column", "traffic_source.medium", "string", "acquisition_medium IS NOT NULL"),
    ("column", "event_value_in_usd", "double",
     "event_name IN (" + ", ".join(f"'{e}'" for e in ECONOMY_EVENTS) + ")"),
]

# Another route than the operator's: every pair of successive days is joined in full.
_DRIFT_SQL = with_models(f"""
, dated AS (
    SELECT *, event_date - (SELECT min(event_date) FROM stg) AS nth FROM stg),
counted AS ({" UNION ALL ".join(
    f"SELECT event_date, '{scope}' AS scope, '{name}' AS name, '{kind}' AS kind, "
    f"count_if({where}) AS n, count(*) AS num_rows FROM dated GROUP BY event_date"
    for scope, name, kind, where in _DRIFT_NAMES)}),
held AS (
    SELECT event_date, scope, name, string_agg(kind, ',' ORDER BY kind) AS kinds,
        CAST(sum(n) * 10000 // max(num_rows) AS BIGINT) AS share
    FROM counted WHERE n > 0 GROUP BY event_date, scope, name),
loads AS (
    SELECT event_date AS day, lead(event_date) OVER (ORDER BY event_date) AS next_day
    FROM (SELECT DISTINCT event_date FROM stg)),
earlier AS (SELECT l.next_day AS shard_date, h.* FROM held h JOIN loads l ON h.event_date = l.day
            WHERE l.next_day IS NOT NULL),
later AS (SELECT l.next_day AS shard_date, h.* FROM held h JOIN loads l ON h.event_date = l.next_day),
pairs AS (
    SELECT coalesce(a.shard_date, b.shard_date) AS shard_date, coalesce(a.scope, b.scope) AS scope,
        coalesce(a.name, b.name) AS name, a.kinds AS kinds_before, b.kinds AS kinds_after,
        a.share AS share_before, b.share AS share_after
    FROM earlier a FULL JOIN later b
        ON a.shard_date = b.shard_date AND a.scope = b.scope AND a.name = b.name)
SELECT *, CASE WHEN kinds_before IS NULL THEN 'new' ELSE 'vanished' END AS change
FROM pairs WHERE kinds_before IS NULL OR kinds_after IS NULL
UNION ALL SELECT *, 'retyped' AS change FROM pairs WHERE kinds_before <> kinds_after
UNION ALL SELECT *, 'share' AS change FROM pairs WHERE abs(share_after - share_before) > {SHARE_SHIFT}
""")


@register("schema_changes", _DRIFT_SQL)
def q_schema_changes(spark, sf_dir):
    """What changed from day to day, from profiles that were taken after each of two loads."""
    configure(spark)
    shards = frame_shards(_drifting_raw(spark, sf_dir))
    table = RawTable(spark, scratch_path(spark, "raw-events"))
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    log = ProfileLog(spark, scratch_path(spark, "profiles"))
    days = shards.days()
    ledger.begin(days[0])
    for most in (max(len(days) // 2, 1), None):
        load_pending(table, shards, ledger, most)
        log.record_loads(table, ledger)
    return log.changes(SHARE_SHIFT)


LOST, GAINED = 40, 60  # every so many-th event is gone from the first day, or new on the second


@register("table_diff_digests", _with_faulted(f"""
SELECT event_date AS shard_date, 'removed' AS change, NULL::VARCHAR AS column_name, count(*) AS num_rows
FROM stg WHERE event_date = {FIRST_DAY_SQL} AND event_id % {LOST} = 0 GROUP BY event_date
UNION ALL
SELECT event_date, 'added', NULL, count(*)
FROM stg WHERE event_date = {FIRST_DAY_SQL} + 1 AND event_id % {GAINED} = 0 GROUP BY event_date
UNION ALL
SELECT event_date, 'changed', unnest([NULL, 'platform']), count(*)
FROM stg WHERE event_date = {LAST_DAY_SQL} AND {NULL_SELECTED_SQL} GROUP BY event_date
"""))
def q_table_diff_digests(spark, sf_dir):
    """Two versions of the raw table by their stored digests: rows lost, rows gained, a column masked."""
    raw, number = read_fixture_raw(spark, sf_dir), F.col("event_bundle_sequence_id")
    first, last = raw.agg(F.min(row_day()), F.max(row_day())).first()
    day = row_day()
    before = raw.where(~((day == F.date_add(F.lit(first), 1)) & (number % GAINED == 0)))
    after = masked(raw.where(~((day == F.lit(first)) & (number % LOST == 0))), "platform",
                   NULL_SPIKE_PCT, NULL_SPIKE_SEED, day == F.lit(last))
    versions, marks = [], []
    for rows in (before, after):
        table, _ = _loaded(spark, frame_shards(rows))
        versions.append(_all_rows(table))
        stored = scratch_path(spark, "digests")
        digests(versions[-1], RAW_PARTITION_COLUMN, "event_bundle_sequence_id").write.parquet(stored)
        marks.append(spark.read.parquet(stored))
    return diff_report(*versions, *marks, "event_bundle_sequence_id")


VOLUME_BAND = (0.8, 1.2)   # the reference's 40k..60k around 50k, as fractions


@register("monitor_daily_volume", with_models(f"""
, daily AS (SELECT event_date, count(*) AS n FROM stg GROUP BY event_date),
band AS (SELECT avg(n) AS mean_n FROM daily),
raw_daily AS (
    SELECT event_date, n * CASE WHEN event_date = {LAST_DAY_SQL} THEN 2 ELSE 1 END AS n
    FROM daily)
SELECT 'raw' AS layer, event_date, n AS num_events FROM raw_daily, band
WHERE n NOT BETWEEN {VOLUME_BAND[0]} * mean_n AND {VOLUME_BAND[1]} * mean_n
UNION ALL
SELECT 'staging' AS layer, event_date, n AS num_events FROM daily, band
WHERE n NOT BETWEEN {VOLUME_BAND[0]} * mean_n AND {VOLUME_BAND[1]} * mean_n
"""))
def q_monitor_daily_volume(spark, sf_dir):
    """Volume band on raw (with a re-delivered day) and on deduplicated
    staging; the band is +-20% of the mean staged daily volume."""
    configure(spark)
    raw = _redelivered_raw(read_fixture_raw(spark, sf_dir))
    stg = stage_events(raw)
    daily = stg.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
    low, high = (F.lit(x) * daily.agg(F.avg("n")).scalar() for x in VOLUME_BAND)
    raw_days = raw.withColumn("event_date", F.to_date("event_date", "yyyyMMdd"))
    out = [Q.daily_volume(frame, low, high).select(
        F.lit(layer).alias("layer"), "event_date", "num_events")
        for layer, frame in (("raw", raw_days), ("staging", stg))]
    return out[0].unionByName(out[1])


# hours after the start of the day that follows the newest one
CHECKED_AFTER = (12, 30, 54)


@register("freshness", with_models(f"""
, newest AS (SELECT max(event_at) AS loaded_at FROM stg),
times(h) AS (VALUES {", ".join(f"({h})" for h in CHECKED_AFTER)}),
aged AS (SELECT CAST(CAST(loaded_at AS DATE) + 1 AS TIMESTAMP) + to_hours(h) AS as_of, loaded_at
         FROM newest, times),
hours AS (SELECT *, round((epoch_us(as_of) - epoch_us(loaded_at)) / 3600000000.0, 2) AS age_hours
          FROM aged)
SELECT as_of, loaded_at, age_hours,
    CASE WHEN age_hours > 50 THEN 'error' WHEN age_hours > 26 THEN 'warn' ELSE 'pass' END
        AS status
FROM hours
"""))
def q_freshness(spark, sf_dir):
    """Hours since the newest event at three check times, with the 26 h warn /
    50 h error policy."""
    newest = models(spark, sf_dir).staging.agg(F.max("event_at").alias("loaded_at"))
    next_day = F.unix_micros(F.date_add(F.to_date("loaded_at"), 1).cast("timestamp"))
    checked = newest.withColumn("hours", F.explode(F.array(*map(F.lit, CHECKED_AFTER))))
    return Q.freshness(checked, F.timestamp_micros(next_day + F.col("hours") * 3_600_000_000))


@register("load_freshness", """
SELECT h AS hours, CAST(h AS DOUBLE) AS age_hours,
    CASE WHEN h > 50 THEN 'error' WHEN h > 26 THEN 'warn' ELSE 'pass' END AS status,
    (SELECT count(*) FROM events) AS num_rows
FROM (VALUES (1), (26), (27), (50), (51)) v(h)
""")
def q_load_freshness(spark, sf_dir):
    """Hours since the newest load of the raw table was written, at check times
    that follow it, beside the number of rows it was measured on."""
    table, _ = _loaded(spark, frame_shards(read_fixture_raw(spark, sf_dir)))
    days = table.days()
    rows = table.stats(days[0], days[-1]).agg(F.sum("num_rows")).scalar()
    checked = table.last_modified(days[0], days[-1]).withColumn(
        "hours", F.explode(F.array(*map(F.lit, (1, 26, 27, 50, 51)))))
    as_of = F.timestamp_micros(F.unix_micros("loaded_at")
                               + F.col("hours").cast("bigint") * 3_600_000_000)
    aged = Q.freshness(checked, as_of)
    return aged.select(F.round(F.col("age_hours")).cast("int").alias("hours"), "age_hours",
                       "status", rows.alias("num_rows"))


# ---------------------------------------------------------------- data tests

MODEL_PROPERTY = {"stg_events": "staging"}  # other models bear the property's name


def _suite_frames(m: Models, wanted: set[str]) -> dict[str, DataFrame]:
    return {name: getattr(m, MODEL_PROPERTY.get(name, name)) for name in wanted}


ORACLE_RELATION = {
    "stg_events": "stg", "int_events_sessionized": "sess", "int_user_days": "user_days",
    "fct_events": "fct_events", "dim_users": "dim_users",
    "daily_active_users": "daily_active_users", "retention_cohorts": "retention_cohorts",
    "retention_by_extra_steps_grant": "retention_by_grant",
    "level_funnel_daily": "level_funnel_daily", "extra_steps_economy_daily": "economy_daily",
}


def _sql_text(text: str) -> str:
    return text.replace("'", "''")


# The suite runs on models spoiled on purpose, so that every check has something
# to find: some rows of each model are repeated, some values are removed or foreign.
SPOILED_WHERE = {
    "dim_users": "day(last_seen_date) % 3 = 0",
    "daily_active_users": "day(activity_date) % 3 = 0",
    "retention_cohorts": "day(cohort_date) % 3 = 0",
    "retention_by_extra_steps_grant": "grant_bucket <> 'unassigned'",
}
SPOILED_DAY = "day(event_date) % 3 = 0"
FOREIGN_PLATFORM = "WEB"


def _spoiled(df: DataFrame, model: str, kind: str, decls: list[Decl]) -> DataFrame:
    where = F.expr(SPOILED_WHERE.get(model, SPOILED_DAY))
    if kind == "unique":
        return df.union(df.where(where))
    if kind == "expression":
        return df
    value = F.lit(FOREIGN_PLATFORM) if kind == "accepted_values" else F.lit(None)
    return df.select(*[F.when(where, value).otherwise(F.col(c)).alias(c)
                       if c in {d.arg for d in decls} else F.col(c) for c in df.columns])


def _spoiled_sql(relation: str, model: str, kind: str, decls: list[Decl]) -> str:
    where = SPOILED_WHERE.get(model, SPOILED_DAY)
    if kind == "unique":
        return f"(SELECT * FROM {relation} UNION ALL SELECT * FROM {relation} WHERE {where})"
    if kind == "expression":
        return relation
    value = f"'{FOREIGN_PLATFORM}'" if kind == "accepted_values" else "NULL"
    replaced = ", ".join(f"CASE WHEN {where} THEN {value} ELSE {d.arg} END AS {d.arg}" for d in decls)
    return f"(SELECT * REPLACE ({replaced}) FROM {relation})"


def _declared(kind: str, first: str, last: str) -> dict[str, list[Decl]]:
    by_model: dict[str, list[Decl]] = {}
    for d in declarations(first, last):
        if d.kind == kind:
            by_model.setdefault(d.model, []).append(d)
    return by_model


def _suite_oracle(kind: str) -> str:
    parts = []
    for model, decls in _declared(kind, FIRST_DAY_SQL, LAST_DAY_SQL).items():
        relation = _spoiled_sql(ORACLE_RELATION[model], model, kind, decls)
        parts += [f"SELECT '{_sql_text(d.name)}' AS check_name, '{d.severity}' AS severity, "
                  f"{sql_failures(d, relation)} AS failures" for d in decls]
    return with_models("\nUNION ALL\n".join(parts))


def _suite_query(kind: str):
    def run(spark, sf_dir):
        """The declared checks of one kind over spoiled models; only those models are built."""
        m = models(spark, sf_dir)
        first, last = m.raw.agg(F.min(row_day()), F.max(row_day())).first()
        by_model = _declared(kind, f"date '{first}'", f"date '{last}'")
        frames = {model: _spoiled(df, model, kind, by_model[model])
                  for model, df in _suite_frames(m, set(by_model)).items()}
        report = suite_report(spark, frames, [d for ds in by_model.values() for d in ds])
        return report.select(F.col("check").alias("check_name"), "severity", "failures")
    return run


for _kind in ("unique", "not_null", "accepted_values", "expression"):
    register(f"check_{_kind}", _suite_oracle(_kind))(_suite_query(_kind))


@register("check_dau_reconciles", with_models("""
, spine AS (SELECT event_date, count(DISTINCT user_pseudo_id) AS spine_dau
           FROM user_days WHERE NOT (has_played_quickplay AND day(event_date) % 2 = 0)
           GROUP BY event_date)
SELECT m.activity_date, m.dau, s.spine_dau
FROM daily_active_users m JOIN spine s ON m.activity_date = s.event_date
WHERE m.dau <> s.spine_dau
"""))
def q_check_dau_reconciles(spark, sf_dir):
    """Days on which the mart's DAU differs from a spine that lost some users."""
    m = models(spark, sf_dir)
    spine = m.int_user_days.where("not (has_played_quickplay and day(event_date) % 2 = 0)")
    return Q.dau_reconciles(m.daily_active_users, spine)


def all_queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
