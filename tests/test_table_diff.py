"""Table diff by digests."""

import re

import pytest
from pyspark.sql import functions as F

from playmetrics.operators.table_diff import changed_keys, diff_report, differing, digests

SCHEMA = "day string, id long, a string, b double, c array<int>"
ROWS = [("d1", 1, "x", 1.0, [1]), ("d1", 2, None, 2.0, None), ("d2", 3, "y", None, []),
        ("d2", 4, "", 4.0, [1, 2]), (None, 5, "z", 5.0, [5])]


def _diff(spark, before, after, buckets=8):
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (before, after))
    marks = [digests(x, "day", "id", buckets) for x in (a, b)]
    return {(r.day, r.change, r.column_name): r.num_rows
            for r in diff_report(a, b, *marks, "id", buckets).collect()}


def test_equal_versions_in_another_order_with_repeats(spark):
    assert _diff(spark, ROWS + ROWS[:1], ROWS[:1] + ROWS[::-1]) == {}
    assert _diff(spark, [], []) == {}


def test_removed_added_and_changed(spark):
    after = [ROWS[0], ("d1", 2, "", 2.0, None), ("d2", 4, "", 4.5, [2, 1]), (None, 5, "z", 5.0, [5]),
             ("d3", 6, "n", 0.0, None)]
    assert _diff(spark, ROWS, after) == {
        ("d1", "changed", None): 1, ("d1", "changed", "a"): 1,
        ("d2", "removed", None): 1,
        ("d2", "changed", None): 1, ("d2", "changed", "b"): 1, ("d2", "changed", "c"): 1,
        ("d3", "added", None): 1}


def test_a_null_partition_and_a_row_that_moves(spark):
    after = [*ROWS[1:4], ("d2", 1, "x", 1.0, [1]), (None, 5, "q", 5.0, [5])]
    assert _diff(spark, ROWS, after) == {
        ("d1", "removed", None): 1, ("d2", "added", None): 1,
        (None, "changed", None): 1, (None, "changed", "a"): 1}


def test_values_that_change_places_and_nulls_are_seen(spark):
    before = [("d", 1, None, 1.0, [1, None]), ("d", 2, "p", None, [])]
    after = [("d", 1, "", 1.0, [None, 1]), ("d", 2, "p", 0.0, None)]
    assert _diff(spark, before, after) == {
        ("d", "changed", None): 2, ("d", "changed", "a"): 1, ("d", "changed", "b"): 1,
        ("d", "changed", "c"): 2}


def test_repeated_keys_count_their_rows(spark):
    before = [("d", 1, "x", 1.0, None)] * 3 + [("d", 1, "y", 1.0, None)]
    after = [("d", 1, "x", 1.0, None)] + [("d", 1, "w", 1.0, None)]
    assert _diff(spark, before, after) == {("d", "removed", None): 3, ("d", "added", None): 1}


def test_versions_with_other_columns_are_refused(spark):
    a = spark.createDataFrame(ROWS, SCHEMA)
    marks = digests(a, "day", "id")
    with pytest.raises(ValueError, match="differ in columns"):
        diff_report(a, a.withColumn("more", F.lit(1)), marks, marks, "id")


def test_only_differing_partitions_are_scanned(spark, tmp_dir):
    paths = [f"{tmp_dir}/v{i}" for i in (1, 2)]
    for path, last in zip(paths, ("x", "changed"), strict=True):
        rows = [(f"d{i % 5}", i, last if i == 7 else "x", 1.0, None) for i in range(50)]
        spark.createDataFrame(rows, SCHEMA).write.partitionBy("day").parquet(path)
    a, b = (spark.read.parquet(p) for p in paths)
    apart = differing(*(digests(x, "day", "id") for x in (a, b)))
    assert [r.day for r in apart.collect()] == ["d2"]
    keys = changed_keys(a, b, apart, "id")
    assert [(r.id, r.changed_columns) for r in keys.collect()] == [(7, ["a"])]
    # the plan's other scans are the digests', which are stored tables in use
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*\(day#\d+ = d2\)", plan)) >= 2
