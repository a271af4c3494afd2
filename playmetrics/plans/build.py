"""One build of the whole model DAG: materialize, stage, check, publish.

Staging with its session columns is computed once and written as a table in
the shared checkpoint folder. What it says about each user and day, and all
days of each user added up (see ``operators.user_state``), become tables beside
the marts, for later builds to start from. Every mart is written under its
contract into new folders, and the data-test suite runs over what is written.
Only if no error-severity check fails does one version file name the new
folders (see ``sources.published``): readers see all marts of the old build or all of
the new one, also when a build stops halfway. Otherwise the old version stays and the
report says why.

A build that is told which shards are new (``new_days``) reads only events from
the earliest day they touch. It takes the totals of the users who were active
since then from their buckets, numbers their sessions on, adds the new days up
and writes those buckets; buckets without such users are not read and stay, as
do older days of the daily tables. Its checks and monitors cover what it writes.
This equals a full build as long as the events have a time and are dated by
it. Where one is not, or nothing is published yet, the build is a full one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.operators import quality as Q
from playmetrics.operators.core import fct_events
from playmetrics.operators.economy import extra_steps_economy_daily
from playmetrics.operators.engagement import (
    daily_active_users,
    retention_by_grant_of,
    retention_cohorts_of,
    retention_flags,
)
from playmetrics.operators.funnels import level_funnel_daily
from playmetrics.operators.user_state import (
    added_up,
    day_totals,
    sessions_before,
    spine,
    user_bucket,
    user_day_state,
    users,
)
from playmetrics.plans.models import Models
from playmetrics.plans.sinks import enforce_contract
from playmetrics.plans.suite import declarations, suite_report
from playmetrics.schema import (
    MART_CONTRACTS,
    RAW_PARTITION_COLUMN,
    STATE_SCHEMA,
    TOTALS_SCHEMA,
)
from playmetrics.session import configure, scratch_path
from playmetrics.sources.files import remove
from playmetrics.sources.ledger import Ledger
from playmetrics.sources.published import NULL_PART, WHOLE, Published
from playmetrics.sources.raw_table import RawTable, Shards, load_pending

FCT = "fct_events"
STATE = "_user_day_state"    # not marts: what the next build starts from
TOTALS = "_user_totals"      # all days of a user added up
BEFORE = "_user_totals_before"  # the same, of days before the note of that name
BUCKET = "user_bucket"
USER_BUCKETS = 16  # a bucket should hold a few hundred megabytes of users
DAY = "event_date"
# how a table is divided into parts; others are replaced whole
PARTED = {STATE: DAY, FCT: DAY, "level_funnel_daily": DAY, "extra_steps_economy_daily": DAY,
          "daily_active_users": "activity_date", TOTALS: BUCKET, BEFORE: BUCKET,
          "dim_users": BUCKET}


@dataclass
class BuildResult:
    out: str
    tables: list[str] = field(default_factory=list)  # marts and tables this build has published
    report: DataFrame | None = None

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_mart(spark, self.out, name)


def read_mart(spark: SparkSession, out_dir: str, name: str, version: int | None = None) -> DataFrame:
    """A mart as the newest (or a given) version has it, with its contracted columns."""
    return Published(spark, out_dir, version).read(name, MART_CONTRACTS[name])


class Scratch:
    """Tables of one build in the checkpoint folder, removed together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            remove(self.spark, path)


def build(spark: SparkSession, raw: DataFrame, out_dir: str, window_start: dt.date,
          window_end: dt.date, rebuild_start_date: dt.date | None = None,
          volume_band: tuple[int, int] = (40_000, 60_000), null_rate_column: str = "platform",
          null_rate_threshold: float = 0.01, block_on_errors: bool = True,
          loaded: DataFrame | None = None, as_of: dt.datetime | None = None,
          new_days: list[dt.date] | None = None, user_buckets: int = USER_BUCKETS,
          notes: dict[str, str] | None = None, **model_kwargs) -> BuildResult:
    """Build, check and publish every mart under ``out_dir``.

    A failing error check raises :class:`QualityError` after the report is
    written and before any mart is replaced, unless ``block_on_errors`` is off.
    ``loaded`` (one row, ``loaded_at``) adds the freshness of the load as of
    ``as_of``: late is a warning, far too late an error. ``notes`` are kept with
    the published version.
    """
    configure(spark)
    out = out_dir.rstrip("/")
    old = Published(spark, out)
    if int(old.notes.get("user_buckets", user_buckets)) != user_buckets:
        new_days = None  # users are divided otherwise: start from their days
    since = None
    if new_days and rebuild_start_date is None:
        since = first_day_touched(spark, raw, out, new_days)
    scratch = Scratch(spark)
    staged = Staged(spark, old)
    try:
        frames, recent = _stage(spark, scratch, staged, raw, since, rebuild_start_date,
                                user_buckets, model_kwargs)
        checks = [
            Q.Check("singular:dau_reconciles",
                    Q.dau_reconciles(frames["daily_active_users"], frames["int_user_days"])),
            Q.Check("monitor:daily_volume", Q.daily_volume(frames["stg_events"], *volume_band),
                    "warn"),
            Q.Check(f"monitor:null_rate:{null_rate_column}",
                    Q.null_rate(frames["stg_events"], null_rate_column, null_rate_threshold), "warn"),
            Q.Check("monitor:redelivered_events",
                    Q.duplicate_ratio(recent, frames["stg_events"]), "warn"),
            Q.Check("monitor:event_date_is_utc_day",
                    frames["stg_events"].where(F.col("event_date") != F.to_date("event_at")), "warn"),
        ]
        if loaded is not None:
            age = Q.freshness(loaded, as_of or dt.datetime.now(dt.timezone.utc))
            checks += [Q.Check("freshness:raw:late", age.where("status = 'warn'"), "warn"),
                       Q.Check("freshness:raw:stale", age.where("status = 'error'"))]
        result = BuildResult(out)
        report = suite_report(spark, frames, declarations(window_start, window_end), checks)
        report.coalesce(1).write.mode("overwrite").parquet(f"{out}/_checks")
        result.report = spark.read.parquet(f"{out}/_checks")
        if block_on_errors:
            Q.raise_on_errors(result.report.collect())  # one small row per check
        published = staged.publish({"user_buckets": str(user_buckets), **(notes or {})})
        result.tables = sorted(published.tables)
        published.vacuum()
        return result
    except Q.QualityError:
        staged.drop()
        raise
    finally:
        scratch.drop()


class Staged:
    """New parts of the tables, written but not yet named by a version."""

    def __init__(self, spark: SparkSession, old: Published):
        self.spark, self.old = spark, old
        self.folders: dict[str, str] = {}
        self.new: dict[str, dict[str, str]] = {}   # parts this build has written
        self.all: dict[str, dict[str, str]] = {}   # with the old parts that stay
        self.notes: dict[str, str] = {}

    def write(self, rows: DataFrame, table: str,
              stays: Callable[[str], bool] = lambda part: False) -> None:
        """Write a table's new parts; of the old ones those stay that ``stays`` says."""
        if table in MART_CONTRACTS:
            wanted = [c for c in rows.columns if c != BUCKET]
            enforce_contract(rows.select(*wanted), MART_CONTRACTS[table], table)
        column = PARTED.get(table)
        self.folders[table] = self.old.new_folder(table)
        path = f"{self.old.root}/{self.folders[table]}"
        if column is None:
            rows.write.parquet(path)
        else:
            # a few right-sized files for each part (AQE splits big ones, merges small ones)
            rows.hint("rebalance", column).write.partitionBy(column).parquet(path)
        self.new[table] = self.old.written(self.folders[table], column)
        kept = {x: f for x, f in self.old.tables.get(table, {}).items() if stays(x)}
        self.all[table] = {**kept, **self.new[table]}

    def _read(self, table: str, parts: dict[str, str], schema: T.StructType | None) -> DataFrame:
        view = Published(self.spark, self.old.root)
        view.tables = {table: parts}
        return view.read(table, schema or MART_CONTRACTS[table])

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table as it will be published."""
        return self._read(table, self.all[table], schema)

    def new_rows(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """What this build has written of the table."""
        return self._read(table, self.new[table], schema)

    def publish(self, notes: dict[str, str]) -> Published:
        return self.old.publish(self.all, {**notes, **self.notes})

    def drop(self) -> None:
        for folder in self.folders.values():
            remove(self.spark, f"{self.old.root}/{folder}")


def published_days(published: Published, table: str = FCT) -> list[dt.date]:
    """Days that a daily table has parts for."""
    return [dt.date.fromisoformat(x) for x in published.parts(table)
            if x not in (NULL_PART, WHOLE)]


def first_day_touched(spark: SparkSession, raw: DataFrame, out: str, new_days: list[dt.date]
                      ) -> dt.date | None:
    """The day from which new shards can change anything; None: only a full build will do."""
    published = Published(spark, out)
    days = published_days(published)
    if not days or not published.parts(STATE):
        return None
    new = raw.where(F.col(RAW_PARTITION_COLUMN).isin(new_days))
    earliest, odd = new.agg(F.min(F.timestamp_micros("event_timestamp")).cast("date"),
                            F.count_if(_odd())).first()
    if odd or earliest is None:
        return None
    # a day that was loaded again may also have lost rows
    again = [d for d in new_days if d <= max(days)]
    since = min([earliest, max(days) - dt.timedelta(days=1), *again])
    return None if recent_rows(raw, since).where(_odd()).limit(1).count() else since


def _odd() -> Column:
    """Events without a time, or not dated by it."""
    own_day = F.date_format(F.timestamp_micros("event_timestamp"), "yyyyMMdd")
    return ~F.coalesce(F.col("event_date") == own_day, F.lit(False))


def recent_rows(raw: DataFrame, since: dt.date) -> DataFrame:
    """Raw events from ``since`` on by time or by date, whatever their shard.

    Both conditions reach the Parquet scan, so row groups of older days are
    skipped by their statistics.
    """
    start = int(dt.datetime.combine(since, dt.time(), dt.timezone.utc).timestamp()) * 1_000_000
    return raw.where((F.col("event_timestamp") >= start)
                     | (F.col("event_date") >= f"{since:%Y%m%d}"))


def _before(staged: Staged, recent: DataFrame, since: dt.date, buckets: int
            ) -> tuple[DataFrame, set[str]]:
    """Totals of days before ``since`` for all users of the buckets with an active one, and
    those buckets.

    They come from the totals that the last build left, with the days between added;
    where there are none, or they reach too far, from all users' days.
    """
    old = staged.old
    noted = old.notes.get("totals_before")
    until = dt.date.fromisoformat(noted) if noted else None
    afresh = until is None or until > since
    earlier = [x for x in old.parts(STATE) if x == NULL_PART or x < since.isoformat()]
    if not afresh:
        earlier = [x for x in earlier if x != NULL_PART and x >= until.isoformat()]
    between = old.read(STATE, STATE_SCHEMA, earlier)
    rows = day_totals(between)
    if afresh:
        wanted = {str(b) for b in range(buckets)}
    else:
        # active now, on the days between, or on the days that are written again
        again = old.read(STATE, STATE_SCHEMA, [x for x in old.parts(STATE) if x >= since.isoformat()])
        active = recent.select(user_bucket(buckets)).union(
            between.select(user_bucket(buckets))).union(again.select(user_bucket(buckets)))
        wanted = {str(r[0]) for r in active.distinct().collect()}  # at most as many as buckets
        rows = rows.unionByName(old.read(BEFORE, TOTALS_SCHEMA, sorted(wanted)))
    staged.write(added_up(rows).withColumn(BUCKET, user_bucket(buckets)), BEFORE,
                 lambda part: not afresh and part not in wanted)
    staged.notes["totals_before"] = since.isoformat()
    return staged.new_rows(BEFORE, TOTALS_SCHEMA), wanted


def _stage(spark, scratch, staged, raw, since, rebuild_start_date, buckets, model_kwargs
           ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write every table's new parts; the frames to check, and the raw rows they come from."""
    recent, before, active = raw, None, set()
    if since is not None:
        recent = recent_rows(raw, since)
        before, active = _before(staged, recent, since, buckets)
        model_kwargs = {**model_kwargs, "prior": sessions_before(before)}
    else:
        staged.notes["totals_before"] = ""

    def old_day(part: str) -> bool:
        return since is not None and (part == NULL_PART or part < since.isoformat())

    def idle_bucket(part: str) -> bool:
        return since is not None and part not in active

    sessionized = scratch.table(Models(recent, **model_kwargs).sessionized, "sessionized")
    staged.write(user_day_state(sessionized), STATE, old_day)
    state = staged.new_rows(STATE, STATE_SCHEMA)
    user_days = spine(state)

    rows = day_totals(state)
    if before is not None:
        rows = rows.unionByName(before)
    staged.write(added_up(rows).withColumn(BUCKET, user_bucket(buckets)), TOTALS, idle_bucket)
    totals = staged.new_rows(TOTALS, TOTALS_SCHEMA)
    staged.write(users(totals).withColumn(BUCKET, user_bucket(buckets)), "dim_users", idle_bucket)

    events = fct_events(sessionized)
    days = published_days(staged.old)
    if since is None and days:
        # without new days only the last ones, or those from a given day, are rewritten
        bound = rebuild_start_date or max(days) - dt.timedelta(days=1)
        staged.write(events.where(F.col(DAY) >= F.lit(bound)), FCT,
                     lambda part: part == NULL_PART or part < bound.isoformat())
    else:
        staged.write(events, FCT, old_day)
    fct = staged.new_rows(FCT) if since is not None else staged.read(FCT)
    # the funnel and economy marts read the fact table, as in the DAG
    staged.write(level_funnel_daily(fct), "level_funnel_daily", old_day)
    staged.write(extra_steps_economy_daily(fct), "extra_steps_economy_daily", old_day)
    first_seen = totals.select("user_pseudo_id", "first_seen_date")
    staged.write(daily_active_users(user_days, first_seen), "daily_active_users", old_day)

    # retention may change for any cohort: one scan of a narrow row per user
    everyone = staged.read(TOTALS, TOTALS_SCHEMA)
    newest = everyone.where(F.col("user_pseudo_id").isNotNull()).agg(
        F.max("last_seen_date")).scalar()
    flags = retention_flags(everyone)
    staged.write(retention_cohorts_of(flags, newest), "retention_cohorts")
    staged.write(retention_by_grant_of(flags, newest), "retention_by_extra_steps_grant")
    frames = {
        # staging and sessionized events are the same materialized table here;
        # one frame lets their shared uniqueness test run once
        "stg_events": sessionized, "int_events_sessionized": sessionized,
        "int_user_days": user_days, FCT: fct,
        **{name: staged.new_rows(name) for name in MART_CONTRACTS if name != FCT},
    }
    return frames, recent


def scheduled_run(spark: SparkSession, shards: Shards, table: RawTable, ledger: Ledger, out_dir: str,
                  most_days: int | None = 1, rebuild_start_date: dt.date | None = None,
                  as_of: dt.datetime | None = None, **build_kwargs) -> BuildResult | None:
    """One scheduled cycle: load what is pending, then bring the marts up to date
    (see :func:`build`) with every day that was loaded, or loaded again, since the
    published build: new days, repaired ones, and those of builds that were
    blocked. Returns None when there are none and no rebuild was asked for."""
    load_pending(table, shards, ledger, most_days)
    state = ledger.state()
    built = int(Published(spark, out_dir).notes.get("ledger_version", 0))
    new = state.loaded_after(built)
    if not new and rebuild_start_date is None:
        return None
    span = (state.first_day, state.last_day)
    return build(spark, table.read(*span), out_dir, *span, rebuild_start_date=rebuild_start_date,
                 loaded=table.last_modified(*span), as_of=as_of, new_days=new,
                 notes={"ledger_version": str(state.version)}, **build_kwargs)
