"""The fixture adapter's rows are dealt over tasks, whatever the file's layout."""

import datetime as dt

from pyspark.sql import functions as F

from playmetrics.session import configure
from playmetrics.sources.fixture_events import read_fixture_raw


def _one_row_group(spark, path, rows):
    events = [(None if i % 50 == 0 else i // 2, dt.datetime(2024, 1, 1 + i % 20, 3), i % 7, "view",
               1.0, '{"k": %d}' % (i % 100)) for i in range(rows)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, "
                                  "value double, props string").coalesce(1).write.parquet(
        f"{path}/events.parquet")


def test_rows_of_one_row_group_are_dealt_over_tasks(spark, tmp_dir):
    _one_row_group(spark, tmp_dir, 400)
    raw = read_fixture_raw(spark, tmp_dir)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in raw.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 400
    assert len(sizes) > 1 and max(sizes) < 400 / 2
    # null and repeated identifiers come through as often as they are there
    assert raw.where("event_bundle_sequence_id is null").count() == 8
    assert raw.where("event_bundle_sequence_id = 1").count() == 2


def test_methods_too_long_for_the_jit_are_not_made(spark):
    configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
