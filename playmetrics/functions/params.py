"""Column builders for key-value params, keys and casts.

Everything here returns a ``Column`` so it stays inside Catalyst and
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Value-slot expression per extraction mode. An exported param carries its
# value in exactly one typed slot; "numeric" accepts any numeric slot.
MODES = ("string", "int", "float", "numeric")


def _slot(value: Column, mode: str) -> Column:
    if mode == "string":
        return value["string_value"]
    if mode == "int":
        return value["int_value"]
    if mode == "float":
        return F.coalesce(value["float_value"], value["double_value"])
    if mode == "numeric":
        return F.coalesce(value["int_value"].cast("double"), value["float_value"],
                          value["double_value"])
    raise ValueError(f"unknown extraction mode {mode!r}; expected one of {MODES}")


def param_map(array_col: str | Column, keys: Iterable[str]) -> Column:
    """Map key -> value struct holding only the wanted keys of a params array.

    Entries are filtered to the wanted keys before the map is built, so a
    NULL or repeated *unrelated* key is harmless, while a wanted key that
    occurs twice raises (``spark.sql.mapKeyDedupPolicy=EXCEPTION``).
    """
    wanted = sorted(set(keys))
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    kept = F.filter(arr, lambda p: p["key"].isin(wanted))
    return F.map_from_entries(kept)


def extract_param(pmap: Column, key: str, mode: str = "string") -> Column:
    """Typed value of ``key`` from a map built by :func:`param_map`; NULL if
    absent or held in another slot."""
    return _slot(F.try_element_at(pmap, F.lit(key)), mode)


def round_to_long(c: Column) -> Column:
    """Float to integer rounding half away from zero (2.5 -> 3, -2.5 -> -3)."""
    return F.round(c, 0).cast("bigint")


# Fixed value: the marker the packaged surrogate-key macro substitutes for
# NULL inputs, so that NULL and the empty string hash differently.
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 hex over the '-'-joined text of the columns, NULL-safe."""
    parts = []
    for i, c in enumerate(cols):
        column = F.col(c) if isinstance(c, str) else c
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(column.cast("string"), F.lit(SURROGATE_NULL_MARKER)))
    return F.md5(F.concat(*parts))


# JSON options for content keys: keep NULL fields (else an absent value and a
# NULL would collide) and keep microseconds (the default writer truncates to
# milliseconds, which would merge events 1 µs apart).
JSON_KEY_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def content_key(*cols: str | Column) -> Column:
    """md5 hex of the JSON of a struct of ``cols``: identical payload, identical key."""
    struct = F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])
    return F.md5(F.to_json(struct, JSON_KEY_OPTIONS))
