"""Contracted table writes and the incremental event-fact overwrite."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.sources.files import folders


class ContractError(ValueError):
    """A frame's columns do not match its declared contract."""


def contract_violations(schema: T.StructType, contract: T.StructType) -> list[str]:
    """Differences in column names, order and types (nullability is free)."""
    problems = []
    have = [(f.name, f.dataType) for f in schema.fields]
    want = [(f.name, f.dataType) for f in contract.fields]
    have_names, want_names = [n for n, _ in have], [n for n, _ in want]
    for name in want_names:
        if name not in have_names:
            problems.append(f"missing column {name}")
    for name in have_names:
        if name not in want_names:
            problems.append(f"unexpected column {name}")
    types = dict(have)
    for name, dtype in want:
        if name in types and types[name] != dtype:
            problems.append(f"column {name} is {types[name].simpleString()}, "
                            f"contract says {dtype.simpleString()}")
    if not problems and have_names != want_names:
        problems.append(f"column order {have_names} differs from contract {want_names}")
    return problems


def enforce_contract(df: DataFrame, contract: T.StructType, name: str = "table") -> DataFrame:
    problems = contract_violations(df.schema, contract)
    if problems:
        raise ContractError(f"{name}: " + "; ".join(problems))
    return df


def write_contracted(df: DataFrame, contract: T.StructType, path: str, name: str = "table",
                     partition_by: str | None = None) -> None:
    """Check the exact schema first, then overwrite the table; nothing is
    written when the check fails."""
    enforce_contract(df, contract, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def incremental_rows(spark: SparkSession, fct: DataFrame, path: str,
                     rebuild_start_date: dt.date | None = None,
                     date_column: str = "event_date") -> DataFrame:
    """Rows an incremental run rewrites.

    First run (no table yet): everything. With ``rebuild_start_date``: that
    day and every later day. Otherwise the last existing day and the one
    before it, so sessions crossing midnight settle once the next day exists.
    The bound comes from the names of the table's partitions; no file is opened.
    """
    days = partition_days(spark, path, date_column)
    if not days:
        return fct
    since = rebuild_start_date or max(days) - dt.timedelta(days=1)
    return fct.where(F.col(date_column) >= F.lit(since))


def partition_days(spark: SparkSession, path: str, date_column: str = "event_date") -> list[dt.date]:
    """Days that the table at ``path`` has partitions for."""
    mark, null = f"{date_column}=", "__HIVE_DEFAULT_PARTITION__"
    names = [x.removeprefix(mark) for x in folders(spark, path) if x.startswith(mark)]
    return [dt.date.fromisoformat(x) for x in names if x != null]


def replace_days(rows: DataFrame, path: str, date_column: str = "event_date") -> None:
    """Replace exactly the day partitions that ``rows`` hold.

    A REBALANCE on the date first groups each day into advisory-sized tasks
    (AQE splits big days, merges small ones), so that a day gets a few
    right-sized files instead of one from every task.
    """
    (rows.hint("rebalance", date_column).write.partitionBy(date_column)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def write_incremental(spark: SparkSession, fct: DataFrame, contract: T.StructType, path: str,
                      rebuild_start_date: dt.date | None = None, name: str = "fct_events",
                      date_column: str = "event_date") -> None:
    """Write the rows of :func:`incremental_rows` into their day partitions."""
    rows = incremental_rows(spark, fct, path, rebuild_start_date, date_column)
    replace_days(enforce_contract(rows, contract, name), path, date_column)
