"""Params as one VARIANT object, so that a new key needs no code and no schema.

``{"level": {"int_value": 3, ...}, ...}``: each key holds its typed slots. Written to
Parquet the frequent keys are shredded into columns of their own, and a read of some
keys only scans those.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playmetrics.functions.params import MODES


def param_variant(array_col: str | Column) -> Column:
    """All params of a row as a VARIANT object; a key that occurs twice raises.

    A NULL array gives NULL. Entries that are NULL or have no key are left out.
    """
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    named = F.filter(arr, lambda p: p["key"].isNotNull())
    return F.to_variant_object(F.map_from_entries(named))


def _path(key: str, slot: str) -> str:
    quote = '"' if "'" in key else "'"
    if quote in key:
        raise ValueError(f"a key with both kinds of quotes cannot be looked up: {key!r}")
    return f"$[{quote}{key}{quote}].{slot}"


def variant_param(params: Column, key: str, mode: str = "string") -> Column:
    """Typed value of ``key``; NULL if absent or held in another slot."""
    def slot(name: str, kind: str) -> Column:
        return F.variant_get(params, _path(key, name), kind)

    if mode == "string":
        return slot("string_value", "string")
    if mode == "int":
        return slot("int_value", "bigint")
    real = F.coalesce(slot("float_value", "double"), slot("double_value", "double"))
    if mode == "float":
        return real
    if mode == "numeric":
        return F.coalesce(slot("int_value", "bigint").cast("double"), real)
    raise ValueError(f"unknown extraction mode {mode!r}; expected one of {MODES}")
