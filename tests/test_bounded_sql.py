"""The raw table in SQL, and params as VARIANT objects."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from raw_events import BASE, raw_event

from playmetrics.functions.params import MODES, extract_param, param_map
from playmetrics.functions.variants import param_variant, variant_param
from playmetrics.sources import bounded_sql
from playmetrics.sources.raw_table import RawTable, frame_shards

D = dt.timedelta(days=1)
DAY = BASE.date()


@pytest.fixture()
def table(spark, make_raw, tmp_dir):
    rows = [raw_event(user=f"u{i}", at=BASE + (i % 3) * D) for i in range(9)]
    out = RawTable(spark, f"{tmp_dir}/raw")
    out.replace(frame_shards(make_raw(rows)), [DAY + i * D for i in range(3)])
    bounded_sql.register(out)
    return out


def test_days_are_arguments_and_prune_the_scan(spark, table):
    got = spark.sql(f"SELECT user_pseudo_id, shard_date FROM raw_events(DATE '{DAY}', DATE '{DAY}' + 1)")
    assert {r.shard_date for r in got.collect()} == {DAY, DAY + D} and got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"(shard_date#" in plan and f">= {DAY})" in plan and f"<= {DAY + D})" in plan
    assert "PartitionFilters: [isnotnull(shard_date" in plan
    assert "ReadSchema: struct<user_pseudo_id:string>" in plan


@pytest.mark.parametrize("call", ["raw_events", "raw_events()", "raw_events(DATE '2024-03-10')"])
def test_an_unbounded_read_does_not_resolve(spark, table, call):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND|WRONG_NUM_ARGS|REQUIRED_PARAMETER"):
        spark.sql(f"SELECT count(*) FROM {call}")


def test_a_null_day_is_an_error(spark, table):
    with pytest.raises(Exception, match="first and a last day"):
        spark.sql(f"SELECT count(*) FROM raw_events(NULL, DATE '{DAY}')").collect()


def test_columns_and_older_days_follow_the_superset_schema(spark, table):
    got = spark.sql(f"SELECT * FROM raw_events(DATE '{DAY}', DATE '{DAY}')")
    assert got.columns == table.read(DAY, DAY).columns
    with pytest.raises(ValueError, match="plain function name"):
        bounded_sql.register(table, "raw events")


PARAMS = {"s": ("string_value", "x"), "i": ("int_value", 1 << 40), "f": ("float_value", 2.5),
          "d": ("double_value", -0.125), "none": ("int_value", None), "it's": ("int_value", 7),
          "a.b": ("string_value", "dotted")}


def test_variant_modes_equal_map_modes(spark, make_raw, tmp_dir):
    raw = make_raw([raw_event(params=PARAMS), raw_event(params=None)])
    raw = raw.unionByName(raw.withColumn("event_params", F.lit(None).cast(
        raw.schema["event_params"].dataType)))
    keys = [*PARAMS, "absent"]
    cases = [(k, m) for k in keys for m in MODES]
    both = raw.select(param_map("event_params", keys).alias("m"), param_variant("event_params").alias("v"))
    both.select("v").write.parquet(f"{tmp_dir}/variants")
    want = both.select(*[extract_param(F.col("m"), k, m) for k, m in cases]).collect()
    got = both.select(*[variant_param(F.col("v"), k, m) for k, m in cases]).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    stored = spark.read.parquet(f"{tmp_dir}/variants").select(
        *[variant_param(F.col("v"), k, m) for k, m in cases]).collect()
    assert sorted(map(repr, map(tuple, stored))) == sorted(map(repr, map(tuple, want)))


def test_a_repeated_key_fails_and_a_missing_key_is_left_out(spark, make_raw):
    raw = make_raw([raw_event(params={"a": ("int_value", 1)})])
    twice = raw.withColumn("event_params", F.concat("event_params", "event_params"))
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        twice.select(param_variant("event_params").cast("string")).collect()
    keyless = raw.select(F.transform("event_params", lambda p: p.withField(
        "key", F.lit(None).cast("string"))).alias("p"))
    assert keyless.select(param_variant("p").cast("string").alias("v")).first().v == "{}"
    with pytest.raises(ValueError, match="extraction mode"):
        variant_param(F.col("v"), "a", "text")
    with pytest.raises(ValueError, match="both kinds of quotes"):
        variant_param(F.col("v"), "a'\"b")


def test_a_read_of_some_keys_scans_only_those(spark, make_raw, tmp_dir):
    raw = make_raw([raw_event(params=PARAMS) for _ in range(20)])
    raw.select(param_variant("event_params").alias("v")).write.parquet(f"{tmp_dir}/shredded")
    read = spark.read.parquet(f"{tmp_dir}/shredded").select(variant_param(F.col("v"), "i", "int"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<v:struct<0:bigint>>" in plan
