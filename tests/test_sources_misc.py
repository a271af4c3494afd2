from plain_forms import spark_checks

from playmetrics.operators.diff import key_diff, keys_only_in
from playmetrics.plans.suite import Decl, suite_report


def test_violation_frames_and_report_agree(spark, make_raw):
    users = spark.createDataFrame(
        [("a", 1, "ANDROID"), ("a", 2, "IOS"), ("b", None, "WEB"), (None, 3, None)],
        "user_pseudo_id string, n int, platform string")
    decls = [Decl("t", "unique", "user_pseudo_id"), Decl("t", "not_null", "n"),
             Decl("t", "accepted_values", "platform"), Decl("t", "expression", "n > 1"),
             Decl("t", "not_null", "platform", "warn")]
    frames = {"t": users}
    by_frames = {c.name: c.violations.count() for c in spark_checks(frames, decls)}
    report = {r.check: r for r in suite_report(spark, frames, decls).collect()}
    assert {k: r.failures for k, r in report.items()} == by_frames
    assert by_frames == {"unique:t:user_pseudo_id": 1, "not_null:t:n": 1,
                         "accepted_values:t:platform": 1, "expression:t:n > 1": 1,
                         "not_null:t:platform": 1}
    assert report["not_null:t:platform"].status == "warn"
    assert report["unique:t:user_pseudo_id"].status == "fail"


def test_key_diff_and_keys_only_in(spark):
    a = spark.createDataFrame([("k1",), ("k2",), ("k2",), (None,)], "k string")
    b = spark.createDataFrame([("k2",), ("k3",), (None,)], "k string")
    (d,) = key_diff(a, b, "k").collect()
    assert (d.a_rows, d.b_rows, d.only_in_a, d.only_in_b, d.in_both) == (4, 3, 1, 1, 2)
    assert sorted(r.k for r in keys_only_in(a, b, "k").collect()) == ["k1"]


def test_table_diff_does_not_depend_on_the_session_time_zone(spark):
    from playmetrics.plans.queries import all_queries
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    (d,) = all_queries()["table_diff"](spark, "/root/testdata/sf0.001").collect()
    assert d.a_rows == d.b_rows == d.in_both + d.only_in_a and 0 < d.only_in_a == d.only_in_b
    assert d.in_both > 0.9 * d.a_rows
