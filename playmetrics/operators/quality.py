"""Data-quality checks and monitors.

Every check returns a DataFrame of violating rows: the check passes iff it
is empty. ``run_checks`` turns a list of checks into one report DataFrame
(check, severity, failures, status) computed on the cluster; only error
checks with failures make ``raise_on_errors`` fail.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their counts."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is outside the list; NULL passes."""
    return df.where(~F.col(column).isin(values))


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows where the expression is false; a NULL result passes."""
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~cond)


def dau_reconciles(dau: DataFrame, user_days: DataFrame) -> DataFrame:
    """Days whose mart DAU differs from the spine's distinct users."""
    spine = user_days.groupBy("event_date").agg(
        F.count_distinct("user_pseudo_id").alias("spine_dau"))
    joined = dau.select("activity_date", "dau").join(
        spine, dau["activity_date"] == spine["event_date"], "inner")
    return joined.where(F.col("dau") != F.col("spine_dau")).select(
        "activity_date", "dau", "spine_dau")


def daily_volume(events: DataFrame, low: int | Column = 40_000, high: int | Column = 60_000,
                 date_column: str = "event_date") -> DataFrame:
    """Days whose row count is outside [low, high]."""
    daily = events.groupBy(date_column).agg(F.count(F.lit(1)).alias("num_events"))
    return daily.where(~F.col("num_events").between(low, high))


def null_rate(events: DataFrame, column: str = "platform", threshold: float = 0.01,
              date_column: str = "event_date") -> DataFrame:
    """Days whose NULL share of ``column`` exceeds ``threshold`` (rate to 4 places)."""
    daily = events.groupBy(date_column).agg(
        (F.count_if(F.col(column).isNull()) / F.count(F.lit(1))).alias("_rate"))
    return daily.where(F.col("_rate") > threshold).select(
        date_column, F.round("_rate", 4).alias("null_rate"))


def duplicate_ratio(raw: DataFrame, staged: DataFrame, date_column: str = "event_date",
                    raw_date: Column | None = None, max_ratio: float = 1.0) -> DataFrame:
    """Days where raw rows per staged event exceed ``max_ratio`` (re-deliveries).
    Complements the volume band, which counts deduplicated rows."""
    rd = raw_date if raw_date is not None else F.to_date("event_date", "yyyyMMdd")
    r = raw.groupBy(rd.alias(date_column)).agg(F.count(F.lit(1)).alias("raw_rows"))
    s = staged.groupBy(date_column).agg(F.count(F.lit(1)).alias("staged_rows"))
    j = r.join(s, date_column, "inner").withColumn(
        "ratio", F.round(F.col("raw_rows") / F.col("staged_rows"), 4))
    return j.where(F.col("raw_rows") > F.col("staged_rows") * max_ratio)


def freshness(loaded: DataFrame, as_of: dt.datetime | Column, loaded_at: str = "loaded_at",
              warn_hours: float = 26, error_hours: float = 50) -> DataFrame:
    """One row per input row: hours since ``loaded_at`` and its status.

    ``loaded`` is typically a one-row aggregate (newest file time of the raw
    table, or newest event time); ``as_of`` is explicit so results do not
    depend on the wall clock.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    age = (F.unix_micros(as_of)
           - F.unix_micros(F.col(loaded_at))) / F.lit(3_600_000_000.0)
    status = (F.when(age > error_hours, "error").when(age > warn_hours, "warn")
              .otherwise("pass"))
    return loaded.select(as_of.alias("as_of"), F.col(loaded_at), F.round(age, 2).alias("age_hours"),
                         status.alias("status"))


def count_row_violations(df: DataFrame, named: list[tuple[str, Column]]) -> DataFrame:
    """(check, failures) for many row-level violation predicates in ONE pass.

    Each predicate is counted with ``count_if`` in a single global aggregate
    (partial counts per task, one tiny merge), so a table is scanned once for
    all its not-null / accepted-values / expression tests. A NULL predicate
    does not count, which is the pass-on-NULL rule of those tests.
    """
    counts = df.agg(*[F.count_if(cond).alias(f"_c{i}") for i, (_, cond) in enumerate(named)])
    rows = F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"_c{i}").alias("failures"))
                     for i, (name, _) in enumerate(named)])
    return counts.select(F.explode(rows).alias("_r")).select("_r.check", "_r.failures")


@dataclass
class Check:
    name: str
    violations: DataFrame
    severity: str = "error"   # "error" blocks, "warn" only reports


def run_checks(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """One report row per check. Each check's failures are counted by an
    aggregate on the cluster; the per-check one-row results are unioned."""
    rows = [
        c.violations.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures")
        for c in checks
    ]
    if not rows:
        return spark.createDataFrame([], "check string, severity string, failures bigint, "
                                         "status string")
    return with_status(reduce(DataFrame.unionByName, rows))


def with_status(report: DataFrame) -> DataFrame:
    """pass when no failures; otherwise warn or fail by severity."""
    status = (F.when(F.col("failures") == 0, "pass")
              .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return report.withColumn("status", status)


class QualityError(RuntimeError):
    pass


def raise_on_errors(report_rows: list) -> None:
    """Fail when any error-severity check has failures; warnings only report."""
    failed = [r["check"] for r in report_rows if r["status"] == "fail"]
    if failed:
        raise QualityError("failed checks: " + ", ".join(failed))
