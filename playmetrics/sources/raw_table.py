"""The day-partitioned raw events table: bounded reads, day loads, statistics.

A partition is an export day (shard), whatever the dates in its rows: a row
dated otherwise, or not dated at all, stays in the shard that delivered it. A
load replaces exactly the requested days, so repeating one changes nothing and
no other day is ever touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.schema import RAW_PARTITION_COLUMN, RAW_SCHEMA
from playmetrics.sources.files import folders, remove
from playmetrics.sources.ledger import DayLoad, Ledger

RAW_TABLE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields + [T.StructField(RAW_PARTITION_COLUMN, T.DateType(), True)])


def _as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


# ------------------------------------------------------------------ sources

@dataclass(frozen=True)
class Shards:
    """Export days on offer, and how to read some of them.

    ``read`` returns raw rows with the day of their shard in the partition
    column. ``mixed`` says that one task may hold rows of many days.
    """

    days: Callable[[], list[dt.date]]
    read: Callable[[list[dt.date]], DataFrame]
    mixed: bool


def row_day() -> Column:
    """A raw row's own day: its date text, else the UTC day of its time."""
    return F.coalesce(F.to_date("event_date", "yyyyMMdd"),
                      F.to_date(F.timestamp_micros("event_timestamp")))


def frame_shards(raw: DataFrame, shard_day: Column | None = None) -> Shards:
    """Shards of a frame that holds the rows of many days; ``shard_day`` tells a row's shard.

    A row without a shard is an error, since no load would ever pick it up.
    """
    tagged = raw.withColumn(RAW_PARTITION_COLUMN, row_day() if shard_day is None else shard_day)

    def days() -> list[dt.date]:
        found = [r[0] for r in tagged.select(RAW_PARTITION_COLUMN).distinct().collect()]
        if None in found:
            raise ValueError("some raw rows belong to no shard day")
        return sorted(found)

    def read(wanted: list[dt.date]) -> DataFrame:
        return tagged.where(F.col(RAW_PARTITION_COLUMN).isin(wanted))

    return Shards(days, read, mixed=True)


def folder_shards(spark: SparkSession, root: str, pattern: str = "events_%Y%m%d") -> Shards:
    """Shards that lie in one Parquet folder per day, named by ``pattern``.

    A row's shard is the folder it is read from.
    """
    root = root.rstrip("/")

    def days() -> list[dt.date]:
        out = []
        for name in folders(spark, root):
            try:
                out.append(dt.datetime.strptime(name, pattern).date())
            except ValueError:  # not a shard folder
                continue
        return out

    def read(wanted: list[dt.date]) -> DataFrame:
        frames = spark.read.schema(RAW_SCHEMA).parquet(
            *[f"{root}/{d.strftime(pattern)}" for d in wanted])
        # the folder's name is the last but one part of the file's path
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        names = F.create_map(*[F.lit(x) for d in wanted for x in (d.strftime(pattern), d)])
        return frames.withColumn(RAW_PARTITION_COLUMN, names[folder])

    return Shards(days, read, mixed=False)


# ------------------------------------------------------------------ the table

class RawTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, start: dt.date | str | None, end: dt.date | str | None) -> DataFrame:
        """Raw rows of shards ``start..end`` (inclusive); an unbounded read is refused.

        The superset schema reads older, narrower days with NULLs in fields that
        came later. The bound is a partition filter: other days are not scanned.
        """
        if start is None or end is None:
            raise ValueError("a raw read needs a first and a last day")
        df = self.spark.read.schema(RAW_TABLE_SCHEMA).parquet(self.path)
        return df.where(F.col(RAW_PARTITION_COLUMN).between(_as_date(start), _as_date(end)))

    def days(self) -> list[dt.date]:
        """Days that have a partition, from the folder names alone."""
        mark = f"{RAW_PARTITION_COLUMN}="
        return [dt.date.fromisoformat(x.removeprefix(mark))
                for x in folders(self.spark, self.path) if x.startswith(mark)]

    def _write(self, shards: Shards, days: list[dt.date], mode: str) -> None:
        rows = shards.read(days).select(*RAW_TABLE_SCHEMA.fieldNames())
        # Tasks of a per-day source each write one partition. Mixed rows are
        # grouped by day first (AQE splits big days), so that a day gets a few
        # right-sized files instead of one from every task.
        if shards.mixed:
            rows = rows.hint("rebalance", RAW_PARTITION_COLUMN)
        (rows.write.partitionBy(RAW_PARTITION_COLUMN)
         .option("partitionOverwriteMode", "dynamic").mode(mode).parquet(self.path))

    def replace(self, shards: Shards, days: Iterable[dt.date]) -> list[DayLoad]:
        """Make the given days equal to their shards; rows and bytes of each."""
        days = sorted(set(days))
        if not days:
            return []
        again = [d for d in days if d in self.days()]
        self._write(shards, days, "overwrite")
        if again:
            # a shard that has become empty writes no file, so its old partition has to go
            filled = {r[0] for r in shards.read(again).select(RAW_PARTITION_COLUMN)
                      .distinct().collect()}
            for day in set(again) - filled:
                self.clear(day)
        return self._measured(days)

    def append(self, shards: Shards, days: Iterable[dt.date]) -> list[DayLoad]:
        """Add the shards' rows to what the days already hold."""
        days = sorted(set(days))
        if not days:
            return []
        self._write(shards, days, "append")
        return self._measured(days)

    def _measured(self, days: list[dt.date]) -> list[DayLoad]:
        written = {}
        if self.days():
            stats = self.stats(days[0], days[-1]).where(F.col(RAW_PARTITION_COLUMN).isin(days))
            written = {r[0]: DayLoad(*r) for r in stats.collect()}
        return [written.get(d, DayLoad(d, 0, 0)) for d in days]

    def clear(self, day: dt.date) -> None:
        """Remove one day's partition."""
        remove(self.spark, f"{self.path}/{RAW_PARTITION_COLUMN}={day.isoformat()}")

    def stats(self, start: dt.date | str, end: dt.date | str) -> DataFrame:
        """(shard_date, num_rows, num_bytes) of each partition in the range.

        Bytes are the sizes of the data files, from the scan's file metadata.
        """
        files = self.read(start, end).groupBy(
            RAW_PARTITION_COLUMN, F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("n"))
        return files.groupBy(RAW_PARTITION_COLUMN).agg(
            F.sum("n").alias("num_rows"), F.sum("size").alias("num_bytes"))

    def last_modified(self, start: dt.date | str, end: dt.date | str) -> DataFrame:
        """One row: when the newest data file in the range was written."""
        return self.read(start, end).agg(
            F.max("_metadata.file_modification_time").alias("loaded_at"))


# ------------------------------------------------------------------ loads

def load_pending(table: RawTable, shards: Shards, ledger: Ledger, most: int | None = 1
                 ) -> list[DayLoad]:
    """Load the first ``most`` days that are offered but not in the ledger (None: all of them).

    The ledger is written after the data, so a crash in between only repeats
    loads that change nothing.
    """
    state = ledger.state()
    if state is None:
        raise RuntimeError("the ledger has not begun: call begin() with the first day wanted")
    loads = table.replace(shards, state.pending(shards.days())[:most])
    if loads:
        ledger.record(loads)
    return loads


def reload_day(table: RawTable, shards: Shards, ledger: Ledger, day: dt.date) -> DayLoad:
    """Replace one day by its shard again (the repair path) and record the new counts."""
    if day not in shards.days():
        raise ValueError(f"no shard is offered for {day}")
    (load,) = table.replace(shards, [day])
    state = ledger.state()
    if state is not None and day in state.loads:
        ledger.record([load])
    return load
