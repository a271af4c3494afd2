"""What has been loaded: one row per day and load, with its rows and bytes.

The ledger is an append-only Parquet table. Its order is a version number, not
a clock, and every append is one committed job, so a crash leaves either the
whole entry or none. What is still to load follows from it: the days a source
offers, less the days in the ledger.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.sources.files import exists

LEDGER_SCHEMA = ("version long, action string, day date, num_rows long, num_bytes long, "
                 "recorded_at timestamp, batch long")
BEGIN, LOAD, BATCH, LATE = "begin", "load", "batch", "late"


@dataclass(frozen=True)
class DayLoad:
    day: dt.date | None  # a stream's batch is of no one day
    num_rows: int
    num_bytes: int


@dataclass(frozen=True)
class LedgerState:
    """Entries since the last beginning: the first day wanted and each day's newest load."""

    first_day: dt.date
    loads: dict[dt.date, DayLoad] = field(default_factory=dict)
    versions: dict[dt.date, int] = field(default_factory=dict)  # of each day's newest load

    @property
    def last_day(self) -> dt.date:
        if not self.loads:
            raise RuntimeError("the ledger holds no loaded day")
        return max(self.loads)

    @property
    def version(self) -> int:
        return max(self.versions.values(), default=0)

    def loaded_after(self, version: int) -> list[dt.date]:
        """Days loaded, or loaded again, since the ledger stood at ``version``."""
        return sorted(d for d, v in self.versions.items() if v > version)

    def pending(self, offered: list[dt.date]) -> list[dt.date]:
        return sorted(d for d in set(offered) - self.loads.keys() if d >= self.first_day)


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        """Every entry; columns that older entries lack are NULL."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def _append(self, action: str, loads: list[DayLoad], batch: int | None = None) -> None:
        newest = self.entries().agg(F.max("version")).first()[0] or 0
        now = dt.datetime.now(dt.timezone.utc)
        rows = [(newest + 1, action, x.day, x.num_rows, x.num_bytes, now, batch) for x in loads]
        self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(
            self.path)

    def begin(self, first_day: dt.date) -> None:
        """Start over: earlier entries no longer count."""
        self._append(BEGIN, [DayLoad(first_day, 0, 0)])

    def record(self, loads: list[DayLoad]) -> None:
        self._append(LOAD, loads)

    def record_batch(self, batch: int, num_rows: int) -> None:
        """A stream's micro-batch is in place; from here on a repeat of it adds nothing."""
        self._append(BATCH, [DayLoad(None, num_rows, 0)], batch)

    def record_late(self, batch: int, num_rows: int) -> None:
        """Rows that a micro-batch left out because they came after the watermark."""
        self._append(LATE, [DayLoad(None, num_rows, 0)], batch)

    def batches(self, action: str = BATCH) -> DataFrame:
        """(batch, num_rows) of a stream, the newest entry of each batch."""
        rows = self.entries().where(F.col("action") == action)
        return rows.groupBy("batch").agg(F.max_by("num_rows", "version").alias("num_rows"))

    def state(self) -> LedgerState | None:
        """None before the first beginning. The ledger has a few rows per day, so it fits here."""
        state = None
        days = self.entries().where(F.col("action").isin(BEGIN, LOAD))
        for r in days.orderBy("version", "day").collect():
            if r.action == BEGIN:
                state = LedgerState(r.day)
            elif state is not None:
                state.loads[r.day] = DayLoad(r.day, r.num_rows, r.num_bytes)
                state.versions[r.day] = r.version
        return state
