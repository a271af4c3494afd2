"""Null out a column on a reproducible share of rows, into a copy of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.schema import RAW_PARTITION_COLUMN, RAW_SCHEMA


def row_share(seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the event alone: the first
    32 bits of their md5, which any SQL engine can compute."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(""))
             for c in ("event_timestamp", "user_pseudo_id", "event_name")]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def masked(raw: DataFrame, column: str, share: float = 1.0, seed: str = "mask",
           where: Column | None = None) -> DataFrame:
    """``raw`` with ``column`` nulled on a share of the rows (of those that meet ``where``)."""
    if column not in RAW_SCHEMA.fieldNames():
        raise ValueError(f"only whole raw columns can be masked, and {column!r} is none")
    if not 0 < share <= 1:
        raise ValueError(f"the share of rows to mask must be above 0 and at most 1, not {share}")
    chosen = row_share(seed) < share if share < 1 else F.lit(True)
    if where is not None:
        chosen = chosen & where
    null = F.lit(None).cast(RAW_SCHEMA[column].dataType)
    return raw.withColumn(column, F.when(chosen, null).otherwise(F.col(column)))


def masked_copy(raw: DataFrame, path: str, column: str, share: float = 1.0, seed: str = "mask",
                where: Column | None = None) -> None:
    """Write raw-table rows with ``column`` masked to a new table; the original stays as it is."""
    rows = masked(raw, column, share, seed, where)
    rows.hint("rebalance", RAW_PARTITION_COLUMN).write.partitionBy(RAW_PARTITION_COLUMN).parquet(
        path)
