"""The raw table for ``spark.sql``: a table function whose two days cannot be left out.

``register(table)`` makes ``raw_events(first_day, last_day)`` known to the session. It
is a SQL function, so Catalyst inlines it and constant days reach the scan as
partition filters. Without its days it does not resolve; a NULL day raises an error,
where a comparison with it would quietly find nothing.
"""

from __future__ import annotations

import re

from playmetrics.schema import RAW_PARTITION_COLUMN
from playmetrics.sources.raw_table import RAW_TABLE_SCHEMA, RawTable

NAME = re.compile(r"[a-z_][a-z0-9_]*")


def register(table: RawTable, name: str = "raw_events") -> None:
    """Make ``name(first_day, last_day)`` read the table's shards first..last (inclusive)."""
    if not NAME.fullmatch(name):
        raise ValueError(f"{name!r} is no plain function name")
    spark, view = table.spark, f"__shards_of_{name}"
    spark.read.schema(RAW_TABLE_SCHEMA).parquet(table.path).createOrReplaceTempView(view)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_TABLE_SCHEMA)

    def bound(day: str) -> str:
        return (f"CASE WHEN {name}.{day} IS NULL "
                f"THEN raise_error('a raw read needs a first and a last day') ELSE {name}.{day} END")

    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(first_day DATE, last_day DATE)
        RETURNS TABLE ({columns})
        RETURN SELECT {', '.join(f'`{c}`' for c in RAW_TABLE_SCHEMA.fieldNames())} FROM {view}
        WHERE {RAW_PARTITION_COLUMN} BETWEEN {bound('first_day')} AND {bound('last_day')}""")
