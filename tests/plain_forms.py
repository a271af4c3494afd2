"""Plain forms of operators, for comparison in tests."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.functions.params import surrogate_key
from playmetrics.operators import quality as Q
from playmetrics.operators.sessions import USER, _gap_seconds
from playmetrics.plans.suite import Decl
from playmetrics.platform_values import PLATFORMS


def sessionize_single_window(stg: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Textbook single-window form; the reference definition, used by tests."""
    w = Window.partitionBy(USER).orderBy("event_at", "event_pk")
    gap = _gap_seconds(F.lag("event_at").over(w), F.col("event_at"))
    out = (stg.withColumn("seconds_since_previous_event", gap)
              .withColumn("is_session_first_event",
                          F.col("seconds_since_previous_event").isNull()
                          | (F.col("seconds_since_previous_event") > gap_seconds))
              .withColumn("session_number", F.sum(F.col("is_session_first_event").cast("bigint"))
                          .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return out.withColumn("session_id", surrogate_key(USER, "session_number"))


def spark_checks(frames: dict, decls: list[Decl]) -> list[Q.Check]:
    checks = []
    for decl in decls:
        df = frames[decl.model]
        if decl.kind == "unique":
            v = Q.unique(df, decl.arg)
        elif decl.kind == "not_null":
            v = Q.not_null(df, decl.arg)
        elif decl.kind == "accepted_values":
            v = Q.accepted_values(df, decl.arg, PLATFORMS)
        else:
            v = Q.expression_is_true(df, decl.arg)
        checks.append(Q.Check(decl.name, v, decl.severity))
    return checks
