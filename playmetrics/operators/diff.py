"""Row-level key diff of two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: row counts of both versions and the keys found only in each.

    Per-key counts are pre-aggregated on each side (map-side combine), then a
    single full outer join on the key (a shuffle join, no broadcast) feeds
    one global aggregate. Keys that are NULL are compared as values.
    """
    ka = a.groupBy(key).agg(F.count(F.lit(1)).alias("_na"))
    kb = b.groupBy(key).agg(F.count(F.lit(1)).alias("_nb"))
    j = ka.join(kb, ka[key].eqNullSafe(kb[key]), "full_outer")
    return j.agg(
        F.coalesce(F.sum("_na"), F.lit(0)).cast("bigint").alias("a_rows"),
        F.coalesce(F.sum("_nb"), F.lit(0)).cast("bigint").alias("b_rows"),
        F.count_if(F.col("_nb").isNull()).alias("only_in_a"),
        F.count_if(F.col("_na").isNull()).alias("only_in_b"),
        F.count_if(F.col("_na").isNotNull() & F.col("_nb").isNotNull()).alias("in_both"),
    )


def keys_only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` missing from ``b`` (EXCEPT DISTINCT on the key)."""
    return a.select(key).subtract(b.select(key))
