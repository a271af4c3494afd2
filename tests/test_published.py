"""One version names all tables: publishing, stopping halfway, cleaning up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from raw_events import BASE, raw_event

from playmetrics.operators.user_state import added_up, day_totals, user_bucket, user_day_state
from playmetrics.plans import build as module
from playmetrics.plans.build import BEFORE, build, read_mart, scheduled_run
from playmetrics.plans.models import Models
from playmetrics.schema import MART_CONTRACTS, TOTALS_SCHEMA
from playmetrics.sources import published as files_of
from playmetrics.sources.ledger import Ledger
from playmetrics.sources.published import Published
from playmetrics.sources.raw_table import RawTable, frame_shards

D = dt.timedelta(days=1)


def put(spark, old, table, values, column=None):
    folder = old.new_folder(table)
    rows = spark.createDataFrame(values, "n long, day string")
    writer = rows.write.partitionBy(column) if column else rows.write
    writer.parquet(f"{old.root}/{folder}")
    return old.written(folder, column)


def rows_of(published, table):
    schema = published.spark.createDataFrame([], "n long, day string").schema
    return sorted(map(tuple, published.read(table, schema).collect()))


def test_versions_replace_parts_and_old_ones_go(spark, tmp_dir):
    one = Published(spark, tmp_dir)
    assert one.version == 0 and rows_of(one, "t") == []
    one = one.publish({"t": put(spark, one, "t", [(1, "a"), (2, "b")], "day"),
                       "u": put(spark, one, "u", [(5, "x")])}, {"k": "1"})
    new = put(spark, one, "t", [(3, "b"), (4, "c")], "day")
    two = one.publish({"t": {**one.tables["t"], **new}}, {"k": "2"})
    assert rows_of(two, "t") == [(1, "a"), (3, "b"), (4, "c")] and rows_of(two, "u") == [(5, "x")]
    assert rows_of(Published(spark, tmp_dir, 1), "t") == [(1, "a"), (2, "b")]
    put(spark, two, "t", [(9, "z")], "day")  # what a stopped build leaves
    two.vacuum(keep=1)
    assert two.versions() == [2]
    left = Published(spark, tmp_dir)
    assert rows_of(left, "t") == [(1, "a"), (3, "b"), (4, "c")] and left.notes == {"k": "2"}
    text = left.read("t", spark.createDataFrame([], "n long, day string").schema, ["b"])
    assert all("day=b" in x for x in text.inputFiles())


def test_a_version_number_is_taken_once(spark, tmp_dir):
    files_of.write_text(spark, f"{tmp_dir}/_versions/1.json", "{}")
    with pytest.raises(FileExistsError):
        files_of.write_text(spark, f"{tmp_dir}/_versions/1.json", "other")
    assert files_of.read_text(spark, f"{tmp_dir}/_versions/1.json") == "{}"


def days_of(make_raw, users_by_day):
    rows = []
    for day, users in users_by_day.items():
        rows += [raw_event(user=u, at=BASE + day * D + dt.timedelta(minutes=m), name=n)
                 for u in users for m, n in ((0, "first_open" if day == 0 else "screen_view"),
                                             (7, "user_engagement"))]
    return frame_shards(make_raw(rows))


BAND = {"volume_band": (0, 10_000)}


def test_a_build_that_stops_before_its_version_changes_no_mart(spark, make_raw, tmp_dir, monkeypatch):
    shards = days_of(make_raw, {0: "ab", 1: "ac", 2: "b"})
    days, out = shards.days(), f"{tmp_dir}/m"
    build(spark, shards.read(days[:2]), out, days[0], days[1], **BAND)
    before = {name: sorted(map(str, read_mart(spark, out, name).collect()))
              for name in MART_CONTRACTS}

    def stop(*args):
        raise OSError("the driver is gone")  # all parts are written, no version names them

    with monkeypatch.context() as patch:
        patch.setattr(files_of, "write_text", stop)
        with pytest.raises(OSError):
            build(spark, shards.read(days), out, days[0], days[2], **BAND)
    assert before == {name: sorted(map(str, read_mart(spark, out, name).collect()))
                      for name in MART_CONTRACTS}
    build(spark, shards.read(days), out, days[0], days[2], **BAND)
    assert read_mart(spark, out, "daily_active_users").count() == 3


def test_daily_builds_read_only_buckets_of_active_users(spark, make_raw, tmp_dir, monkeypatch):
    everyone = [f"user{i}" for i in range(40)]
    shards = days_of(make_raw, {0: everyone, 1: ["user1"], 2: ["user1"], 3: ["user1"],
                                4: ["user1", "new"]})
    table, ledger = RawTable(spark, f"{tmp_dir}/raw"), Ledger(spark, f"{tmp_dir}/ledger")
    days, out = shards.days(), f"{tmp_dir}/m"
    ledger.begin(days[0])
    scheduled_run(spark, shards, table, ledger, out, 3, **BAND)
    scheduled_run(spark, shards, table, ledger, out, 1, **BAND)
    old, asked = Published(spark, out), []
    read = Published.read

    def watched(self, name, schema, parts=None):
        if name == BEFORE and parts is not None:
            asked.append(set(parts))
        return read(self, name, schema, parts)

    monkeypatch.setattr(module.Published, "read", watched)
    scheduled_run(spark, shards, table, ledger, out, 1, **BAND)
    active = {str(r[0]) for r in spark.createDataFrame(
        [("user1",), ("new",)], "user_pseudo_id string").select(user_bucket(16)).collect()}
    assert asked[0] == active
    new = Published(spark, out)
    for part, folder in old.tables["dim_users"].items():  # idle users' rows are not written again
        assert (new.tables["dim_users"][part] == folder) == (part not in active)
    full = build(spark, table.read(days[0], days[-1]), f"{tmp_dir}/full", days[0], days[-1], **BAND)
    for name in MART_CONTRACTS:
        a, b = read_mart(spark, out, name), full.read(spark, name)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_totals_add_up_in_any_split(spark, make_raw):
    shards = days_of(make_raw, {0: "abc", 1: "b", 63: "ab", 64: "c", 130: "ad"})
    state = user_day_state(Models(shards.read(shards.days())).sessionized).cache()
    rows = day_totals(state)
    whole = added_up(rows).select(*TOTALS_SCHEMA.fieldNames())
    cut = F.col("first_seen_date") <= F.lit(BASE.date() + 40 * D)
    parts = added_up(added_up(rows.where(cut)).unionByName(rows.where(~cut))).select(whole.columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    from playmetrics.operators.user_state import active_between, active_on
    there = {(r[0], r[1]) for r in state.select("user_pseudo_id", "event_date").collect()}
    first = BASE.date()
    for r in whole.select("user_pseudo_id", *[
            active_on(F.col("days"), F.lit(first + n * D)).alias(f"d{n}")
            for n in (0, 1, 2, 63, 64, 130)], *[
            active_between(F.col("days"), F.lit(first + a * D), F.lit(first + b * D))
            .alias(f"r{a}_{b}") for a, b in ((1, 62), (2, 63), (64, 129), (64, 64), (131, 300),
                                             (5, 4))]).collect():
        mine = {(d - first).days for u, d in there if u == r.user_pseudo_id}
        for name, value in r.asDict().items():
            if name[0] == "d":
                assert value == (int(name[1:]) in mine), (r.user_pseudo_id, name)
            elif name[0] == "r":
                a, b = map(int, name[1:].split("_"))
                assert value == any(a <= n <= b for n in mine), (r.user_pseudo_id, name)
