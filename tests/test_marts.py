import datetime as dt

from raw_events import BASE, raw_event

from playmetrics.operators.economy import extra_steps_economy_daily
from playmetrics.operators.funnels import level_funnel_daily
from playmetrics.plans.models import Models

D = dt.timedelta(days=1)
H = dt.timedelta(hours=1)


def test_latest_grant_and_first_non_null_country(spark, make_raw):
    g = "initial_extra_steps"
    rows = [raw_event(at=BASE, country=None, user_props={g: ("string_value", "3")}),
            raw_event(at=BASE + H, country="Brelland", user_props={g: ("string_value", "10")}),
            raw_event(at=BASE + 2 * H, country="Corvania")]
    u = Models(make_raw(rows)).dim_users.collect()[0]
    assert u.initial_extra_steps == 10
    assert u.first_country == "Brelland"
    assert u.num_events == 3 and u.num_days_active == 1 and u.num_sessions == 3


def _retention_rows():
    # u1: first_open day 0, active day 1 and 7. u2: first_open day 0, active 6 and 8.
    # u3: no first_open. last loaded day = day 8.
    r = [raw_event(user="u1", at=BASE, name="first_open"),
         raw_event(user="u1", at=BASE + D, name="x"),
         raw_event(user="u1", at=BASE + 7 * D, name="x"),
         raw_event(user="u2", at=BASE, name="first_open"),
         raw_event(user="u2", at=BASE + 6 * D, name="x"),
         raw_event(user="u2", at=BASE + 8 * D, name="x"),
         raw_event(user="u3", at=BASE + 2 * D, name="x"),
         # u4: cohort on the last day -> D1 not observable
         raw_event(user="u4", at=BASE + 8 * D, name="first_open")]
    return r


def test_retention_cohorts(spark, make_raw):
    m = Models(make_raw(_retention_rows()))
    rows = {r.cohort_date: r for r in m.retention_cohorts.collect()}
    c0 = rows[BASE.date()]
    assert (c0.cohort_size, c0.retained_d1, c0.retained_d7, c0.retained_d30) == (2, 1, 1, 0)
    assert (c0.retention_d1, c0.retention_d7, c0.retention_d30) == (0.5, 0.5, None)
    c8 = rows[(BASE + 8 * D).date()]
    assert (c8.cohort_size, c8.retained_d1, c8.retention_d1) == (1, 0, None)
    assert "u3" in {u.user_pseudo_id for u in m.dim_users.collect()}


def test_retention_by_grant_denominators(spark, make_raw):
    m = Models(make_raw(_retention_rows()))
    (b,) = m.retention_by_extra_steps_grant.collect()
    assert b.grant_bucket == "unassigned" and b.cohort_users == 3
    assert (b.d1_denominator, b.d7_denominator, b.d30_denominator) == (2, 2, 0)
    assert (b.retention_d1, b.retention_d7, b.retention_d30) == (0.5, 0.5, None)


def test_observable_cohort_without_returns_has_zero_rate(spark, make_raw):
    rows = [raw_event(user="u1", at=BASE, name="first_open"),
            raw_event(user="u2", at=BASE + 3 * D, name="x")]
    (c,) = Models(make_raw(rows)).retention_cohorts.collect()
    assert c.retained_d1 == 0 and c.retention_d1 == 0.0


def test_funnel_like_wildcard_and_retry_only_board(spark, make_raw):
    b = {"board": ("string_value", "L")}
    rows = [raw_event(name="level_retry_quickplay", params=b),
            raw_event(name="quickplay", params=b),
            raw_event(name="levelXquickplay", params=b),
            raw_event(name="level_start_quickplay")]          # no board: ignored
    (r,) = level_funnel_daily(Models(make_raw(rows)).staging).collect()
    assert (r.board, r.starts, r.retries, r.users_starting) == ("L", 0, 1, 0)
    assert r.completion_rate is None


def test_economy_null_value_and_days_without_events(spark, make_raw):
    rows = [raw_event(name="spend_virtual_currency", params={"value": ("int_value", 4)}),
            raw_event(at=BASE + H, name="spend_virtual_currency"),
            raw_event(at=BASE + D, name="screen_view")]
    out = extra_steps_economy_daily(Models(make_raw(rows)).staging).collect()
    assert len(out) == 1
    assert (out[0].spend_events, out[0].steps_spent, out[0].spenders) == (2, 4.0, 1)


def test_daily_active_users_new_vs_returning(spark, make_raw):
    rows = [raw_event(user="u1", at=BASE), raw_event(user="u1", at=BASE + D),
            raw_event(user="u2", at=BASE + D)]
    out = {r.activity_date: r for r in Models(make_raw(rows)).daily_active_users.collect()}
    d1 = out[(BASE + D).date()]
    assert (d1.dau, d1.new_users, d1.returning_users) == (2, 1, 1)


def test_events_without_user_or_day_follow_the_join_semantics(spark, make_raw):
    rows = [raw_event(user="u1", at=BASE, name="first_open"),
            raw_event(user="u1", at=BASE + D, name="x"),
            raw_event(user=None, at=BASE, name="first_open"),
            raw_event(user=None, at=BASE + D, name="x")]
    m = Models(make_raw(rows))
    assert [r.user_pseudo_id for r in m.int_user_days.select("user_pseudo_id").distinct()
            .collect()] == ["u1"]
    assert [r.user_pseudo_id for r in m.dim_users.collect()] == ["u1"]
    (c,) = m.retention_cohorts.collect()
    assert (c.cohort_size, c.retained_d1) == (1, 1)
    dau = {r.activity_date: r.dau for r in m.daily_active_users.collect()}
    assert dau == {BASE.date(): 1, (BASE + D).date(): 1}
    # the sessions themselves keep the user-less events, one partition of their own
    assert m.sessionized.where("user_pseudo_id IS NULL").count() == 2


def test_day_30_retention_has_a_rate_once_it_is_observable(spark, make_raw):
    rows = []
    for user, comes_back in (("kept", 30), ("lost", 29), ("early", None)):
        rows.append(raw_event(user=user, at=BASE, name="first_open"))
        if comes_back:
            rows.append(raw_event(user=user, at=BASE + comes_back * D, name="x"))
    rows += [raw_event(user="late", at=BASE + 20 * D, name="first_open"),
             raw_event(user="late", at=BASE + 40 * D, name="x")]
    m = Models(make_raw(rows))
    by_day = {r.cohort_date: r for r in m.retention_cohorts.collect()}
    c = by_day[BASE.date()]
    assert (c.cohort_size, c.retained_d30, c.retention_d30) == (3, 1, 0.3333)
    late = by_day[(BASE + 20 * D).date()]
    assert (late.retained_d30, late.retention_d30) == (0, None)
    (b,) = m.retention_by_extra_steps_grant.collect()
    assert (b.cohort_users, b.d30_denominator, b.retained_d30, b.retention_d30) == (4, 3, 1, 0.3333)


def test_economy_sums_do_not_depend_on_the_order(spark, make_raw):
    rows = [raw_event(user=f"u{i}", at=BASE + dt.timedelta(seconds=i), name="ad_reward",
                      params={"value": ("double_value", v)}) for i, v in enumerate([0.1] * 3 + [0.05] * 7)]
    (r,) = extra_steps_economy_daily(Models(make_raw(rows)).staging).collect()
    assert r.steps_granted_by_ads == 0.7  # 0.65, rounded up as decimals are
