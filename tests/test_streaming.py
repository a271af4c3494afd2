import datetime as dt

from raw_events import BASE, raw_event

from playmetrics.sources.raw_table import RawTable
from playmetrics.streaming.shard_stream import load_landed_shards

D = dt.timedelta(days=1)


def _land(make_raw, landing, day_index, names):
    day = BASE + day_index * D
    rows = [raw_event(user=n, at=day, name=n) for n in names]
    make_raw(rows).coalesce(1).write.mode("append").parquet(f"{landing}/events_{day:%Y%m%d}")


def _counts(spark, path):
    df = RawTable(spark, path).read(BASE.date(), BASE.date() + 5 * D)
    return {(r.shard_date - BASE.date()).days: r["count"]
            for r in df.groupBy("shard_date").count().collect()}


def test_every_file_of_a_day_counts_whenever_it_lands(spark, make_raw, tmp_dir):
    landing, raw, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/ckpt"
    _land(make_raw, landing, 0, "abc")
    _land(make_raw, landing, 0, "de")
    _land(make_raw, landing, 1, "abcd")
    load_landed_shards(spark, landing, raw, ckpt)
    assert _counts(spark, raw) == {0: 5, 1: 4}
    # nothing new: the checkpoint prevents a reload
    load_landed_shards(spark, landing, raw, ckpt)
    assert _counts(spark, raw) == {0: 5, 1: 4}
    # a new day, and a late file of a day that is already loaded
    _land(make_raw, landing, 2, "ab")
    _land(make_raw, landing, 0, "fgh")
    load_landed_shards(spark, landing, raw, ckpt)
    assert _counts(spark, raw) == {0: 8, 1: 4, 2: 2}


def test_a_day_spread_over_many_batches(spark, make_raw, tmp_dir):
    landing, raw = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    for names in ("abc", "de", "f"):
        _land(make_raw, landing, 0, names)
    load_landed_shards(spark, landing, raw, f"{tmp_dir}/ckpt", files_per_batch=1)
    assert _counts(spark, raw) == {0: 6}
