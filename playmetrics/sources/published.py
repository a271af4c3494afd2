"""Tables that change all at once: immutable part folders, and a version that says which count.

A build writes new parts beside the old ones, ``<table>/v=<token>/...``, and then one
small version file that names, for every table, the folder of each of its parts (a
day, a user bucket, or the whole table). The version file is written under another
name and renamed, so readers see the old version of every table or the new one of
every table, whenever a build stops. Parts that a version does not change are named
again, not copied.

Older versions stay readable until ``vacuum``; what a stopped build left is never named
and goes with it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from playmetrics.sources.files import file_names, folders, read_text, remove, write_text

WHOLE = ""
VERSIONS = "_versions"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class Published:
    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        """The newest version under ``root``, or a given older one."""
        self.spark, self.root = spark, root.rstrip("/")
        known = self.versions()
        self.version = (max(known, default=0) if version is None else version)
        self.tables: dict[str, dict[str, str]] = {}
        self.notes: dict[str, str] = {}
        if self.version:
            content = json.loads(read_text(spark, f"{self.root}/{VERSIONS}/{self.version}.json"))
            self.tables, self.notes = content["tables"], content["notes"]

    def versions(self) -> list[int]:
        names = file_names(self.spark, f"{self.root}/{VERSIONS}")
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json"))

    def parts(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}))

    def read(self, table: str, schema: T.StructType, parts: list[str] | None = None) -> DataFrame:
        """Rows of a table, or of some of its parts; other parts are not listed nor opened.

        ``schema`` names the columns wanted; a part's key is one of them if it is a column.
        """
        named = self.tables.get(table, {})
        wanted = [f"{self.root}/{named[x]}" for x in (named if parts is None else parts)
                  if x in named]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        rows = (self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
                .parquet(*sorted(wanted)))
        return rows.select(*schema.fieldNames())

    # ------------------------------------------------------------------ writing

    def new_folder(self, table: str) -> str:
        """Where a build writes the parts of its next version, relative to the root."""
        return f"{table}/v={uuid.uuid4().hex[:12]}"

    def written(self, folder: str, column: str | None) -> dict[str, str]:
        """The parts under a new folder: its ``column=`` folders, or the folder itself."""
        if column is None:
            return {WHOLE: folder}
        mark = f"{column}="
        return {x.removeprefix(mark): f"{folder}/{x}"
                for x in folders(self.spark, f"{self.root}/{folder}") if x.startswith(mark)}

    def publish(self, tables: dict[str, dict[str, str]], notes: dict[str, str]) -> Published:
        """The next version: the given tables have the given parts, others stay."""
        tables = {**self.tables, **tables}
        number = max(self.versions(), default=0) + 1
        text = json.dumps({"tables": tables, "notes": {**self.notes, **notes}})
        write_text(self.spark, f"{self.root}/{VERSIONS}/{number}.json", text)
        return Published(self.spark, self.root)

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the newest versions, and the parts that none of those names."""
        known = self.versions()
        for number in known[:-keep]:
            remove(self.spark, f"{self.root}/{VERSIONS}/{number}.json")
        named = {folder for number in known[-keep:]
                 for parts in Published(self.spark, self.root, number).tables.values()
                 for folder in parts.values()}
        for table in self.tables:
            for version in folders(self.spark, f"{self.root}/{table}"):
                folder = f"{table}/{version}"
                inner = folders(self.spark, f"{self.root}/{folder}")
                if not any(x == folder or x.startswith(f"{folder}/") for x in named):
                    remove(self.spark, f"{self.root}/{folder}")
                    continue
                for part in inner:
                    if "=" in part and f"{folder}/{part}" not in named and folder not in named:
                        remove(self.spark, f"{self.root}/{folder}/{part}")
