"""Profiles of the loaded days, kept beside the ledger; the newest one of a day counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.operators.profile import PROFILE_SCHEMA, SHIFT, changes, profile
from playmetrics.schema import RAW_PARTITION_COLUMN
from playmetrics.sources.files import exists
from playmetrics.sources.ledger import Ledger
from playmetrics.sources.raw_table import RawTable


class ProfileLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        schema = f"version long, {PROFILE_SCHEMA}"
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def record_loads(self, table: RawTable, ledger: Ledger) -> list:
        """Profile the days that were loaded, or loaded again, since the last call."""
        state = ledger.state()
        if state is None:
            return []
        days = state.loaded_after(self.entries().agg(F.max("version")).first()[0] or 0)
        # a day without rows has no partition, and so no profile
        held = sorted(set(days) & set(table.days()))
        if held:
            rows = table.read(held[0], held[-1]).where(F.col(RAW_PARTITION_COLUMN).isin(held))
            found = profile(rows).withColumn("version", F.lit(state.version).cast("long"))
            found.coalesce(1).write.mode("append").parquet(self.path)  # a few rows per day and key
        return held

    def newest(self) -> DataFrame:
        """The profile of each day as it was last loaded."""
        rows = self.entries()
        last = rows.groupBy(F.col(RAW_PARTITION_COLUMN).alias("day")).agg(
            F.max("version").alias("last"))
        return rows.join(last, (F.col(RAW_PARTITION_COLUMN) == F.col("day"))
                         & (F.col("version") == F.col("last"))).drop("day", "last", "version")

    def changes(self, shift: int = SHIFT) -> DataFrame:
        return changes(self.newest(), shift)
