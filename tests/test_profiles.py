"""Profiles of loads and the changes between them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from raw_events import BASE, raw_event

from playmetrics.operators.profile import PROFILE_SCHEMA, changes, leaf_columns, profile
from playmetrics.schema import RAW_SCHEMA
from playmetrics.sources.ledger import Ledger
from playmetrics.sources.profiles import ProfileLog
from playmetrics.sources.raw_table import RawTable, frame_shards, load_pending, reload_day

D = dt.timedelta(days=1)
DAY = BASE.date()


def _of(spark, rows):
    """Profile rows (day offset, name, kind, num_values, num_rows) of params."""
    return spark.createDataFrame([(DAY + d * D, "event_params", name, kind, n, of)
                                  for d, name, kind, n, of in rows], PROFILE_SCHEMA)


def _found(frame):
    return {((r.shard_date - DAY).days, r.name, r.change, r.kinds_before, r.kinds_after)
            for r in frame.collect()}


def test_leaves_go_through_structs_only():
    paths = {".".join(p): kind for p, kind in leaf_columns(RAW_SCHEMA)}
    assert paths["device.web_info.hostname"] == "string"
    assert paths["event_params"].startswith("array<struct<key:string")
    assert "device" not in paths and "geo" not in paths


def test_profile_counts_columns_keys_and_slots(spark, make_raw):
    rows = [raw_event(params={"level": ("int_value", 3), "none": ("int_value", None)}),
            raw_event(params={"level": ("double_value", 2.0)}, country=None),
            raw_event(params=None, user_props={"grant": ("string_value", "5")})]
    got = {(r.scope, r.name, r.kind): (r.num_values, r.num_rows) for r in profile(
        make_raw(rows).withColumn("shard_date", F.lit(DAY))).collect()}
    assert got["event_params", "level", "int_value"] == (1, 3)
    assert got["event_params", "level", "double_value"] == (1, 3)
    assert got["event_params", "none", "empty"] == (1, 3)
    assert got["user_properties", "grant", "string_value"] == (1, 3)
    assert got["column", "geo.country", "string"] == (2, 3)
    assert ("column", "user_id", "string") not in got  # no value at all
    assert ("column", "shard_date", "date") not in got


def test_an_entry_without_key_and_a_row_without_params(spark, make_raw):
    raw = make_raw([raw_event(params={"a": ("int_value", 1)})]).withColumn("shard_date", F.lit(DAY))
    null_key = raw.withColumn("event_params", F.transform(
        "event_params", lambda p: p.withField("key", F.lit(None).cast("string"))))
    bare = raw.withColumn("event_params", F.lit(None).cast(raw.schema["event_params"].dataType))
    names = profile(null_key.unionByName(bare)).where("scope = 'event_params'")
    assert names.count() == 0
    assert profile(raw.limit(0)).count() == 0


def test_changes_of_each_kind(spark):
    rows = [
        (0, "stays", "int_value", 10, 10), (1, "stays", "int_value", 10, 10),
        (2, "stays", "int_value", 10, 10), (3, "stays", "int_value", 10, 10),
        (1, "comes", "int_value", 1, 10), (2, "comes", "int_value", 1, 10),
        (3, "comes", "int_value", 1, 10),
        (0, "goes", "string_value", 5, 10), (1, "goes", "string_value", 5, 10),
        (0, "returns", "string_value", 5, 10), (2, "returns", "string_value", 5, 10),
        (3, "returns", "string_value", 5, 10),
        (0, "turns", "int_value", 5, 10), (1, "turns", "double_value", 5, 10),
        (2, "turns", "double_value", 3, 10), (2, "turns", "int_value", 2, 10),
        (3, "turns", "double_value", 5, 10),
        (0, "fades", "int_value", 9, 10), (1, "fades", "int_value", 3, 10),
        (2, "fades", "int_value", 3, 10), (3, "fades", "int_value", 3, 10)]
    got = _found(changes(_of(spark, rows)))
    assert got == {
        (1, "comes", "new", None, "int_value"),
        (2, "goes", "vanished", "string_value", None),
        (1, "returns", "vanished", "string_value", None),
        (2, "returns", "new", None, "string_value"),
        (1, "turns", "retyped", "int_value", "double_value"),
        (2, "turns", "retyped", "double_value", "double_value,int_value"),
        (3, "turns", "retyped", "double_value,int_value", "double_value"),
        (1, "fades", "share", "int_value", "int_value")}


def test_a_gap_between_loads_is_no_change_and_shares_move_by_more_than_the_limit(spark):
    rows = [(0, "a", "int_value", 10, 100), (5, "a", "int_value", 15, 100),
            (9, "a", "int_value", 21, 100)]
    assert _found(changes(_of(spark, rows), 500)) == {(9, "a", "share", "int_value", "int_value")}
    assert changes(_of(spark, rows[:1])).count() == 0
    assert changes(_of(spark, rows).limit(0)).count() == 0


def test_a_reloaded_day_is_profiled_again(spark, make_raw, tmp_dir):
    def shards(second):
        return frame_shards(make_raw([
            raw_event(user="u1", params={"a": ("int_value", 1)}),
            raw_event(user="u2", at=BASE + D, params=second)]))

    table, ledger = RawTable(spark, f"{tmp_dir}/raw"), Ledger(spark, f"{tmp_dir}/ledger")
    log = ProfileLog(spark, f"{tmp_dir}/profiles")
    assert log.record_loads(table, ledger) == []
    ledger.begin(DAY)
    broken, mended = shards({"a": ("string_value", "1")}), shards({"a": ("int_value", 1)})
    load_pending(table, broken, ledger, None)
    assert log.record_loads(table, ledger) == [DAY, DAY + D]
    assert log.record_loads(table, ledger) == []
    assert _found(log.changes()) == {(1, "a", "retyped", "int_value", "string_value")}
    reload_day(table, mended, ledger, DAY + D)
    assert log.record_loads(table, ledger) == [DAY + D]
    assert _found(log.changes()) == set()


@pytest.mark.parametrize("days", [[1], [0, 1]])
def test_only_new_days_are_read(spark, make_raw, tmp_dir, days):
    rows = [raw_event(at=BASE + d * D) for d in days]
    table, ledger = RawTable(spark, f"{tmp_dir}/raw"), Ledger(spark, f"{tmp_dir}/ledger")
    ledger.begin(DAY)
    load_pending(table, frame_shards(make_raw(rows)), ledger, 1)
    log = ProfileLog(spark, f"{tmp_dir}/profiles")
    log.record_loads(table, ledger)
    load_pending(table, frame_shards(make_raw(rows)), ledger, None)
    assert log.record_loads(table, ledger) == [DAY + d * D for d in days[1:]]
