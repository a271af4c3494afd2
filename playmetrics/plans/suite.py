"""The declared data-test suite of the models, as data.

Each entry is rendered twice: on Spark, as violation frames (``spark_checks``,
for inspecting the offending rows) and as one report (``suite_report``); for
the oracle, as SQL counting the same violations.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.operators import quality as Q
from playmetrics.operators.engagement import RETENTION_DAYS
from playmetrics.platform_values import PLATFORMS


@dataclass(frozen=True)
class Decl:
    model: str
    kind: str          # unique | not_null | accepted_values | expression
    arg: str           # column, or SQL expression
    severity: str = "error"
    label: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.model}:{self.label or self.arg}"


def _for_each_day(rule: str) -> str:
    """A rule with {d} in it, required for every retention day."""
    return " and ".join(rule.format(d=d) for d in RETENTION_DAYS)


def declarations(window_start: dt.date | str, window_end: dt.date | str) -> list[Decl]:
    """The 59 declared tests (the prod-only schema-change monitor is replaced
    by the contract check at write time). The window is two dates, or two SQL
    expressions for them."""
    first, last = (x if isinstance(x, str) else f"date '{x.isoformat()}'"
                   for x in (window_start, window_end))
    rates = _for_each_day("(retention_d{d} is null or retention_d{d} between 0 and 1)")
    u, n = "unique", "not_null"
    # Models, columns, limits and expressions are the declared rules.
    d = [
        Decl("stg_events", u, "event_pk"), Decl("stg_events", n, "event_pk"),
        Decl("stg_events", n, "event_date"), Decl("stg_events", n, "event_at"),
        Decl("stg_events", n, "event_name"), Decl("stg_events", n, "user_pseudo_id"),
        Decl("stg_events", "accepted_values", "platform"),
        Decl("int_events_sessionized", u, "event_pk"),
        Decl("int_events_sessionized", n, "event_pk"),
        Decl("int_events_sessionized", n, "session_id"),
        Decl("int_user_days", u, "user_day_pk"), Decl("int_user_days", n, "user_day_pk"),
        Decl("int_user_days", n, "user_pseudo_id"), Decl("int_user_days", n, "event_date"),
        Decl("int_user_days", n, "num_sessions"),
        Decl("fct_events", u, "event_pk"), Decl("fct_events", n, "event_pk"),
        Decl("fct_events", n, "event_date"), Decl("fct_events", n, "event_name"),
        Decl("fct_events", n, "user_pseudo_id"), Decl("fct_events", n, "session_id"),
        Decl("fct_events", "expression", f"event_date between {first} and {last}",
             label="event_date within the loaded days"),
        Decl("dim_users", u, "user_pseudo_id"), Decl("dim_users", n, "user_pseudo_id"),
        Decl("dim_users", n, "has_observed_first_open"), Decl("dim_users", n, "first_seen_date"),
        Decl("dim_users", "expression", "last_seen_date >= first_seen_date"),
        Decl("dim_users", "expression", "num_events > 0 and num_days_active > 0"),
        Decl("daily_active_users", u, "activity_date"),
        Decl("daily_active_users", n, "activity_date"), Decl("daily_active_users", n, "dau"),
        Decl("daily_active_users", "expression", "dau >= new_users"),
        Decl("daily_active_users", "expression", "dau > 0 and returning_users >= 0"),
        Decl("retention_cohorts", u, "cohort_date"), Decl("retention_cohorts", n, "cohort_date"),
        Decl("retention_cohorts", n, "cohort_size"),
        Decl("retention_cohorts", "expression", "cohort_size > 0"),
        Decl("retention_cohorts", "expression", rates, label="rates within 0 and 1"),
        Decl("retention_by_extra_steps_grant", u, "grant_bucket"),
        Decl("retention_by_extra_steps_grant", n, "grant_bucket"),
        Decl("retention_by_extra_steps_grant", n, "cohort_users"),
        Decl("retention_by_extra_steps_grant", "expression", rates,
             label="rates within 0 and 1"),
        Decl("retention_by_extra_steps_grant", "expression",
             _for_each_day("d{d}_denominator <= cohort_users")),
        Decl("retention_by_extra_steps_grant", "expression",
             _for_each_day("retained_d{d} <= d{d}_denominator")),
        Decl("level_funnel_daily", u, "funnel_day_pk"),
        Decl("level_funnel_daily", n, "funnel_day_pk"),
        Decl("level_funnel_daily", n, "event_date"), Decl("level_funnel_daily", n, "board"),
        Decl("level_funnel_daily", "expression", "completes <= starts"),
        Decl("level_funnel_daily", "expression", "ends <= starts"),
        Decl("level_funnel_daily", "expression",
             "completion_rate is null or completion_rate between 0 and 1"),
        Decl("extra_steps_economy_daily", u, "event_date"),
        Decl("extra_steps_economy_daily", n, "event_date"),
        Decl("extra_steps_economy_daily", n, "spend_events"),
        Decl("extra_steps_economy_daily", "expression",
             "steps_spent >= 0 and steps_used >= 0 and steps_granted_by_ads >= 0"),
        Decl("extra_steps_economy_daily", "expression", "spenders <= spend_events"),
    ]
    return d


def row_predicate(decl: Decl) -> Column:
    """The per-row violation predicate of a row-level declaration."""
    if decl.kind == "not_null":
        return F.col(decl.arg).isNull()
    if decl.kind == "accepted_values":
        return ~F.col(decl.arg).isin(PLATFORMS)
    if decl.kind == "expression":
        return ~F.expr(decl.arg)
    raise ValueError(f"{decl.kind} is not a row-level test")


def suite_report(spark: SparkSession, frames: dict, decls: list[Decl],
                 extra: list[Q.Check] | None = None) -> DataFrame:
    """(check, severity, failures, status) for every declaration and extra check.

    Row-level tests of one model share one scan of it; uniqueness tests are
    one grouped count each; extra checks count their violation frames.
    """
    parts = []
    by_model: dict[str, list[Decl]] = {}
    unique_counts: dict[tuple[int, str], DataFrame] = {}
    for decl in decls:
        if decl.kind == "unique":
            # models backed by the same frame share one grouped count per column
            key = (id(frames[decl.model]), decl.arg)
            if key not in unique_counts:
                unique_counts[key] = Q.unique(frames[decl.model], decl.arg).agg(
                    F.count(F.lit(1)).alias("failures"))
            parts.append(unique_counts[key].select(
                F.lit(decl.name).alias("check"), F.lit(decl.severity).alias("severity"),
                "failures"))
        else:
            by_model.setdefault(decl.model, []).append(decl)
    for model, group in by_model.items():
        counted = Q.count_row_violations(frames[model], [(d.name, row_predicate(d))
                                                         for d in group])
        severity = F.create_map(*[x for d in group for x in (F.lit(d.name), F.lit(d.severity))])
        parts.append(counted.select("check", severity[F.col("check")].alias("severity"),
                                    "failures"))
    if extra:
        parts.append(Q.run_checks(spark, extra).drop("status"))
    return Q.with_status(reduce(DataFrame.unionByName, parts))


def sql_failures(decl: Decl, relation: str) -> str:
    """SQL counting the violations of one declaration over ``relation``."""
    if decl.kind == "unique":
        return (f"(SELECT count(*) FROM (SELECT {decl.arg} FROM {relation} "
                f"WHERE {decl.arg} IS NOT NULL GROUP BY {decl.arg} HAVING count(*) > 1))")
    if decl.kind == "not_null":
        return f"(SELECT count(*) FROM {relation} WHERE {decl.arg} IS NULL)"
    if decl.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in PLATFORMS)
        return f"(SELECT count(*) FROM {relation} WHERE {decl.arg} NOT IN ({values}))"
    return f"(SELECT count(*) FROM {relation} WHERE NOT ({decl.arg}))"
