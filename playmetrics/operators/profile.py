"""What a load of raw events holds, and what changed from one load to the next.

A profile has one row for each load, name and kind: every leaf column with its type,
every param key with the slot its values are in. ``changes`` reads profiles alone:
names that are new, vanished, hold another kind, or are in clearly more or fewer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.schema import RAW_PARTITION_COLUMN

PROFILE_SCHEMA = (f"{RAW_PARTITION_COLUMN} date, scope string, name string, kind string, "
                  "num_values long, num_rows long")
COLUMN, EMPTY = "column", "empty"  # scope of plain columns; kind of a param without a value
SHIFT = 500  # per 10,000 rows


def leaf_columns(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], str]]:
    """(path, type) of every field that is not a struct itself; arrays count as one."""
    out = []
    for f in schema.fields:
        path = (*prefix, f.name)
        out += (leaf_columns(f.dataType, path) if isinstance(f.dataType, T.StructType)
                else [(path, f.dataType.simpleString())])
    return out


def _is_params(kind: T.DataType) -> bool:
    return (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)
            and {"key", "value"} <= set(kind.elementType.fieldNames()))


def _long(wide: DataFrame, counted: list[tuple[Column, Column, Column, Column]]) -> DataFrame:
    """One row per (scope, name, kind, count) entry of each row of a small aggregate."""
    entries = F.array(*[F.struct(scope.alias("scope"), name.alias("name"), kind.alias("kind"),
                                 n.alias("num_values")) for scope, name, kind, n in counted])
    return wide.select(RAW_PARTITION_COLUMN, F.explode(entries).alias("e")).select(
        RAW_PARTITION_COLUMN, "e.*").where("num_values > 0")


def _column_profile(raw: DataFrame) -> DataFrame:
    leaves = [x for x in leaf_columns(raw.schema) if x[0] != (RAW_PARTITION_COLUMN,)]
    wide = raw.groupBy(RAW_PARTITION_COLUMN).agg(*[
        F.count(F.col(".".join(f"`{p}`" for p in path))).alias(f"n{i}")
        for i, (path, _) in enumerate(leaves)])
    return _long(wide, [(F.lit(COLUMN), F.lit(".".join(path)), F.lit(kind), F.col(f"n{i}"))
                        for i, (path, kind) in enumerate(leaves)])


def _param_profile(raw: DataFrame, scope: str) -> DataFrame:
    slots = [s for s in raw.schema[scope].dataType.elementType["value"].dataType.fieldNames()
             if s.endswith("_value")]
    entry = raw.select(RAW_PARTITION_COLUMN, F.explode(scope).alias("p")).where("p.key is not null")
    held = {s: F.col("p.value")[s].isNotNull() for s in slots}
    none = ~F.greatest(*[F.coalesce(h, F.lit(False)) for h in held.values()])
    wide = entry.groupBy(RAW_PARTITION_COLUMN, F.col("p.key").alias("key")).agg(
        *[F.count_if(h).alias(s) for s, h in held.items()], F.count_if(none).alias(EMPTY))
    return _long(wide, [(F.lit(scope), F.col("key"), F.lit(s), F.col(s)) for s in (*slots, EMPTY)])


def profile(raw: DataFrame) -> DataFrame:
    """Profile of raw-table rows, by shard: PROFILE_SCHEMA.

    Counts are combined before the shuffle, and what is shuffled has a row per shard and
    key. Names without any value in a shard have no row there.
    """
    parts = [_column_profile(raw)]
    parts += [_param_profile(raw, f.name) for f in raw.schema.fields if _is_params(f.dataType)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    rows = raw.groupBy(F.col(RAW_PARTITION_COLUMN).alias("of")).agg(
        F.count(F.lit(1)).alias("num_rows"))
    return found.join(rows, F.col(RAW_PARTITION_COLUMN).eqNullSafe(F.col("of"))).drop("of")


def changes(profiles: DataFrame, shift: int = SHIFT) -> DataFrame:
    """(shard_date, scope, name, change, kinds and share before and after) between a load and the next.

    ``change`` is ``new``, ``vanished``, ``retyped`` (other kinds) or ``share`` (moved by more
    than ``shift`` of 10,000 rows). A name that comes back is new again. The first load has
    nothing to be compared with. Loads are few (a row per day), so they are numbered in one task.
    """
    day = RAW_PARTITION_COLUMN
    share = F.expr("sum(num_values) * 10000 div max(num_rows)")
    names = profiles.where("num_values > 0").groupBy(day, "scope", "name").agg(
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), share.alias("share"))
    in_order = Window.orderBy("day")
    loads = profiles.select(F.col(day).alias("day")).distinct().select(
        "day", F.row_number().over(in_order).alias("nth"), F.lead("day").over(in_order).alias("next_day"))
    own = Window.partitionBy("scope", "name").orderBy("nth")
    seen = names.join(loads, F.col(day) == F.col("day")).select(
        "*", *[F.lag(c).over(own).alias(f"{c}_before") for c in ("nth", "kinds", "share")],
        F.lead("nth").over(own).alias("nth_after"))

    def change(what: str, at: str, before: bool, after: bool, where: str) -> Column:
        kinds, part = ("kinds_before", "share_before") if after else ("kinds", "share")
        entry = F.struct(
            F.col(at).alias(day), F.lit(what).alias("change"),
            (F.col(kinds) if before else F.lit(None).cast("string")).alias("kinds_before"),
            (F.col("kinds") if after else F.lit(None).cast("string")).alias("kinds_after"),
            (F.col(part) if before else F.lit(None).cast("long")).alias("share_before"),
            (F.col("share") if after else F.lit(None).cast("long")).alias("share_after"))
        return F.when(F.expr(where), entry)

    found = F.array(
        change("new", day, False, True, "nth > 1 and (nth_before is null or nth_before < nth - 1)"),
        change("vanished", "next_day", True, False,
               "next_day is not null and (nth_after is null or nth_after > nth + 1)"),
        change("retyped", day, True, True, "nth_before = nth - 1 and kinds <> kinds_before"),
        change("share", day, True, True,
               f"nth_before = nth - 1 and abs(share - share_before) > {int(shift)}"))
    return seen.select("scope", "name", F.explode(F.array_compact(found)).alias("c")).select(
        "scope", "name", "c.*")
