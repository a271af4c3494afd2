"""Deduplicated events and sessions as streams over landed shards.

Both read the files that land in one folder per day, and both keep event-time
state behind a watermark of ``delay``:

* ``load_staged_events`` drops re-deliveries by content key, in whichever
  batches they land, as long as they come within the delay;
* ``load_sessions`` puts the deduplicated events of a user into sessions. A session is
  written once it is closed: when the watermark has passed its last event by more
  than the gap. Sessions that are still open stay in the stream's state.

Rows that come after the watermark are left out by Spark's stateful operators.
Their number is recorded in the table's ledger with the batch, so that it shows when a
day has to be loaded again by the daily path, which has no watermark.

Each micro-batch is counted once (see ``sources.batch_table``). Event time is the
event's time, else the day it is dated, else the day of its folder. Sessions
only read events that have a time; those of no user are one user's, as in the
batch model.

State is kept in RocksDB unless the session names another store, so that it may
outgrow an executor's memory; its partitions are those of
``spark.sql.shuffle.partitions`` at the first start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmetrics.functions.params import surrogate_key
from playmetrics.operators.sessions import USER
from playmetrics.operators.staging import STAGING_COLUMNS, keyed_events
from playmetrics.schema import RAW_SCHEMA
from playmetrics.session import configure
from playmetrics.sources.batch_table import BatchTable

PLACED = "placed_at"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"
DAY_FORMAT = "%Y%m%d"


def landed_events(spark: SparkSession, landing: str, pattern: str = "events_%Y%m%d",
                  files_per_batch: int | None = None) -> DataFrame:
    """Keyed events of all files that land, with their event time in ``placed_at``."""
    prefix, day, rest = pattern.partition(DAY_FORMAT)
    if not day or rest:
        raise ValueError("a shard folder's name ends in its day, as in events_%Y%m%d")
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    shard = F.try_to_timestamp(F.substring(folder, len(prefix) + 1, 8), F.lit("yyyyMMdd"))
    raw = reader.parquet(f"{landing.rstrip('/')}/*").withColumn("shard_start", shard)
    keyed = keyed_events(raw, "shard_start")
    no_day = F.raise_error(F.lit("a landed folder names no day")).cast("timestamp")
    placed = F.coalesce("event_at", F.col("event_date").cast("timestamp"), "shard_start", no_day)
    return keyed.withColumn(PLACED, placed).drop("shard_start")


def deduplicated(events: DataFrame, delay: str) -> DataFrame:
    """One row per content key; a key is remembered for ``delay`` of event time."""
    return events.withWatermark(PLACED, delay).dropDuplicatesWithinWatermark(["event_pk"])


def sessions(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Closed sessions of a deduplicated stream.

    A gap is measured in whole seconds, truncated, and one of exactly ``gap_seconds``
    continues the session; hence a window that ends a microsecond short of the next one.
    """
    window = F.session_window(PLACED, f"{gap_seconds} seconds 999 milliseconds 999 microseconds")
    closed = events.where(F.col("event_at").isNotNull()).groupBy(USER, window).agg(
        F.min("event_at").alias("started_at"), F.max("event_at").alias("ended_at"),
        F.count(F.lit(1)).alias("num_events"))
    return closed.select(USER, "started_at", "ended_at", "num_events")


def numbered(closed: DataFrame) -> DataFrame:
    """Closed sessions with each user's session number and identifier. A window per user
    over sessions is small: even a user who never stops has a few a day."""
    number = F.row_number().over(Window.partitionBy(USER).orderBy("started_at")).cast("bigint")
    return closed.withColumn("session_number", number).withColumn(
        "session_id", surrogate_key(USER, "session_number"))


def _run(spark: SparkSession, rows: DataFrame, table: BatchTable, checkpoint: str) -> None:
    """Everything that has landed, into the table; then what came too late, into its ledger."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(batch, batch_id)

    if spark.conf.get(STORE, None) in (None, "") or "HDFSBacked" in spark.conf.get(STORE):
        spark.conf.set(STORE, ROCKS)
    spark.conf.set(KEPT_PROGRESS, "100000")  # one small entry per batch of this run
    query = (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    for progress in query.recentProgress:
        late = sum(x["numRowsDroppedByWatermark"] for x in progress["stateOperators"])
        if late:
            table.ledger.record_late(progress["batchId"], late)


def _load(spark: SparkSession, landing: str, path: str, checkpoint: str, delay: str,
          made: Callable[[DataFrame], DataFrame], options: dict) -> DataFrame:
    configure(spark)
    table = BatchTable(spark, path)
    rows = made(deduplicated(landed_events(spark, landing, **options), delay))
    _run(spark, rows, table, checkpoint)
    return table.read(rows.schema)


def load_staged_events(spark: SparkSession, landing: str, path: str, checkpoint: str,
                       delay: str = "2 days", **options) -> DataFrame:
    """Add what has landed since the last run to the staged events at ``path``; all of them."""
    return _load(spark, landing, path, checkpoint, delay,
                 lambda events: events.select(*STAGING_COLUMNS), options)


def load_sessions(spark: SparkSession, landing: str, path: str, checkpoint: str,
                  delay: str = "2 days", gap_seconds: int = 1800, **options) -> DataFrame:
    """Add the sessions that have closed since the last run to those at ``path``; all of them."""
    return _load(spark, landing, path, checkpoint, delay,
                 lambda events: sessions(events, gap_seconds), options)
