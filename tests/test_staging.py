import datetime as dt

import pytest
from raw_events import BASE, raw_event
from pyspark.sql import functions as F

from playmetrics.functions.params import extract_param, param_map
from playmetrics.operators.staging import stage_events


def test_redelivery_differing_only_in_dropped_metadata_collapses(spark, make_raw):
    rows = [raw_event(offset=0), raw_event(offset=999)]
    assert stage_events(make_raw(rows)).count() == 1


def test_events_one_microsecond_apart_or_null_vs_value_stay_distinct(spark, make_raw):
    rows = [raw_event(at=BASE), raw_event(at=BASE + dt.timedelta(microseconds=1)),
            raw_event(at=BASE, country=None), raw_event(at=BASE, country="")]
    stg = stage_events(make_raw(rows))
    assert stg.count() == 4
    assert stg.select("event_pk").distinct().count() == 4


def test_param_modes_and_wrong_slots(spark, make_raw):
    rows = [raw_event(params={"level": ("int_value", 4), "board": ("string_value", "S")}),
            raw_event(name="b", params={"level": ("float_value", 2.0)}),
            raw_event(name="c", params={"level": ("double_value", 7.0)})]
    df = make_raw(rows).select("event_name", param_map("event_params", ["level", "board"]).alias("m"))
    out = {r.event_name: r for r in df.select(
        "event_name",
        extract_param(F.col("m"), "level", "int").alias("i"),
        extract_param(F.col("m"), "level", "float").alias("f"),
        extract_param(F.col("m"), "level", "numeric").alias("n"),
        extract_param(F.col("m"), "level", "string").alias("s"),
        extract_param(F.col("m"), "board", "int").alias("bi"),
        extract_param(F.col("m"), "missing", "string").alias("miss"),
    ).collect()}
    assert (out["screen_view"].i, out["screen_view"].f, out["screen_view"].n) == (4, None, 4.0)
    assert (out["b"].i, out["b"].f, out["b"].n) == (None, 2.0, 2.0)
    assert (out["c"].f, out["c"].n) == (7.0, 7.0)
    assert out["screen_view"].s is None and out["screen_view"].bi is None
    assert out["screen_view"].miss is None


def test_duplicate_wanted_param_key_raises(spark, make_raw):
    row = raw_event()
    params = [("level", ("x", None, None, None)), ("level", ("y", None, None, None))]
    row = row[:3] + (params,) + row[4:]
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|Duplicate map key"):
        stage_events(make_raw([row])).collect()


def test_duplicate_unrelated_key_is_harmless(spark, make_raw):
    row = raw_event()
    params = [("other", ("x", None, None, None)), ("other", ("y", None, None, None)),
              (None, ("z", None, None, None))]
    row = row[:3] + (params,) + row[4:]
    assert stage_events(make_raw([row])).count() == 1


def test_level_rounds_half_away_from_zero(spark, make_raw):
    rows = [raw_event(name="a", params={"level": ("double_value", 2.5)}),
            raw_event(name="b", params={"level": ("double_value", -2.5)})]
    out = {r.event_name: r.level_number for r in stage_events(make_raw(rows)).collect()}
    assert out == {"a": 3, "b": -3}


@pytest.mark.parametrize("text,expected", [("abc", None), ("", None), ("5.0", None),
                                           (" 5 ", 5), ("10", 10)])
def test_grant_safe_cast(spark, make_raw, text, expected):
    rows = [raw_event(user_props={"initial_extra_steps": ("string_value", text)})]
    assert stage_events(make_raw(rows)).collect()[0].initial_extra_steps == expected


def test_bad_event_date_text_raises(spark, make_raw):
    with pytest.raises(Exception):
        stage_events(make_raw([raw_event(event_date="2024-13-99")])).collect()
