"""Independent DuckDB SQL for every registered query.

The oracle shares no code path with the Spark side. It rebuilds the flattened
staging rows straight from the ``events`` view with the fixture rules (no
nested arrays, no param maps); only the rule *values* are shared. The models
are then stated by what they mean, another way than Spark computes them:

* events are numbered per user and paired with the one before; those that come
  too late after it open a session, and every event belongs to the last opening
  at or before it (an as-of join);
* user days and users are one grouping of those events each;
* retention looks a day up in the list of days on which a user was active;
* repeated columns (retention days, funnel steps, economy events) are generated.
"""

from __future__ import annotations

from playmetrics.functions.params import SURROGATE_NULL_MARKER
from playmetrics.operators.engagement import RETENTION_DAYS
from playmetrics.schema import FCT_EVENTS
from playmetrics.sources.fixture_events import (
    BOARDS,
    COUNTRIES,
    ECONOMY_EVENTS,
    LANGUAGES,
    MEDIUMS,
    PROGRESSIVE_LEVEL_EVENTS,
    SOURCES,
    event_name_sql,
    pick_sql,
)


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def skey(*cols: str) -> str:
    """Surrogate key: md5 of '-'-joined text with the NULL marker."""
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{SURROGATE_NULL_MARKER}')" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


ECON = _in(ECONOMY_EVENTS)
PROGRESSIVE = _in(["level_start", "level_end", "level_complete", "level_fail",
                   "level_retry", "level_reset", "level_up"])

def n(condition: str) -> str:
    """How many rows meet a condition."""
    return f"count(*) FILTER (WHERE {condition})"


def users(condition: str) -> str:
    return f"count(DISTINCT user_pseudo_id) FILTER (WHERE {condition})"


def per_day(template: str) -> str:
    """A select list with one entry for each retention day {d}."""
    return ",\n    ".join(template.format(d=d) for d in RETENTION_DAYS)


def amount(event: str) -> str:
    total = f"sum(CAST(event_value AS DECIMAL(18, 6))) FILTER (WHERE event_name = '{event}')"
    return f"CAST(round(coalesce({total}, 0), 1) AS DOUBLE)"


SESSION_GAP_SECONDS = 1800
FUNNEL_STEPS = {"starts": "start", "ends": "end", "completes": "complete", "fails": "fail",
                "retries": "retry", "resets": "reset"}

BASE_CTES = f"""
ev AS (
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
),
named AS (
    SELECT *, {event_name_sql()} AS event_name FROM ev
),
stg AS (
    SELECT
        CAST(ts AS DATE) AS event_date,
        ts AS event_at,
        event_name,
        CAST(user_id AS VARCHAR) AS user_pseudo_id,
        TIMESTAMP '2023-12-01 00:00:00' + to_hours(user_id) AS first_touch_at,
        CASE WHEN user_id % 2 = 0 THEN 'ANDROID' ELSE 'IOS' END AS platform,
        CASE WHEN user_id % 4 = 3 THEN 'tablet' ELSE 'mobile' END AS device_category,
        CASE WHEN user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS device_os,
        {pick_sql(LANGUAGES, 'user_id % 3')} AS device_language,
        CASE WHEN event_id % 7 <> 0 THEN {pick_sql(COUNTRIES, 'event_id % 5')} END AS country,
        '1.' || CAST(user_id % 3 AS VARCHAR) AS app_version,
        'campaign-' || CAST(user_id % 3 AS VARCHAR) AS acquisition_campaign,
        CASE WHEN event_id % 4 <> 0 THEN {pick_sql(MEDIUMS, 'user_id % 3')} END
            AS acquisition_medium,
        {pick_sql(SOURCES, 'user_id % 3')} AS acquisition_source,
        CASE WHEN event_name = 'user_engagement' THEN 1000 * (k + 1) END
            AS engagement_time_msec,
        CASE WHEN event_name LIKE '%_quickplay' THEN {pick_sql(BOARDS, 'event_id % 3')} END
            AS board,
        CASE WHEN starts_with(event_name, 'level_') THEN CAST(1 + k % 30 AS BIGINT) END
            AS level_number,
        CASE WHEN event_name IN {_in(PROGRESSIVE_LEVEL_EVENTS)}
            THEN 'level-' || CAST(1 + k % 30 AS VARCHAR) END AS level_name,
        CASE WHEN event_name = 'post_score' THEN value END AS score,
        CASE WHEN event_name IN {ECON} THEN CAST(1 + k % 20 AS DOUBLE) END AS event_value,
        CASE WHEN event_name IN {ECON} THEN 'steps' END AS virtual_currency_name,
        CASE WHEN event_name IN {ECON} THEN CAST(1 + k % 30 AS VARCHAR) END AS item_name,
        CASE WHEN event_name IN ('screen_view', 'user_engagement')
            THEN 'Screen' || CAST(k % 4 AS VARCHAR) END AS screen_class,
        CASE WHEN event_name = 'screen_view' AND k % 2 = 0 THEN 'main' END AS screen_name,
        CAST(CASE user_id % 5 WHEN 0 THEN 3 WHEN 1 THEN 5 WHEN 2 THEN 10 WHEN 3 THEN 20 END
            AS BIGINT) AS initial_extra_steps,
        event_id, k,
        -- stand-in row key: uniqueness facts match, hash text differs by engine
        md5(CAST(event_id AS VARCHAR)) AS event_pk
    FROM named
),
nth_events AS (
    SELECT *, row_number() OVER (PARTITION BY user_pseudo_id ORDER BY event_at) AS nth FROM stg
),
ev_gaps AS (
    SELECT e.*, (epoch_us(e.event_at) - epoch_us(b.event_at)) // 1000000
        AS seconds_since_previous_event
    FROM nth_events e LEFT JOIN nth_events b
        ON b.user_pseudo_id = e.user_pseudo_id AND b.nth + 1 = e.nth
),
openings AS (
    SELECT user_pseudo_id AS who, nth AS opened_at,
        row_number() OVER (PARTITION BY user_pseudo_id ORDER BY nth) AS session_number
    FROM ev_gaps
    WHERE nth = 1 OR seconds_since_previous_event > {SESSION_GAP_SECONDS}
),
sess AS (
    SELECT e.*, o.session_number, o.opened_at = e.nth AS is_session_first_event,
        {skey('e.user_pseudo_id', 'o.session_number')} AS session_id
    FROM ev_gaps e ASOF JOIN openings o ON o.who = e.user_pseudo_id AND e.nth >= o.opened_at
),
user_days AS (
    SELECT {skey('user_pseudo_id', 'event_date')} AS user_day_pk, user_pseudo_id, event_date,
        count(*) AS num_events, count(DISTINCT session_number) AS num_sessions,
        bool_or(event_name = 'first_open') AS has_first_open,
        bool_or(ends_with(event_name, '_quickplay')) AS has_played_quickplay,
        bool_or(event_name IN {PROGRESSIVE}) AS has_played_progressive,
        bool_or(event_name = 'spend_virtual_currency') AS has_spent_steps,
        round(sum(engagement_time_msec) / 60000, 2) AS engagement_minutes
    FROM sess GROUP BY ALL
),
dim_users AS (
    SELECT user_pseudo_id,
        min(event_at) FILTER (WHERE event_name = 'first_open') AS first_open_at,
        bool_or(event_name = 'first_open') AS has_observed_first_open,
        min(first_touch_at) AS first_touch_at,
        min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
        count(DISTINCT event_date) AS num_days_active, max(session_number) AS num_sessions,
        count(*) AS num_events, min(platform) AS platform,
        (list(country ORDER BY nth) FILTER (WHERE country IS NOT NULL))[1] AS first_country,
        (list(acquisition_medium ORDER BY nth) FILTER (WHERE acquisition_medium IS NOT NULL))[1]
            AS acquisition_medium,
        (list(acquisition_source ORDER BY nth) FILTER (WHERE acquisition_source IS NOT NULL))[1]
            AS acquisition_source,
        (list(initial_extra_steps ORDER BY nth) FILTER (WHERE initial_extra_steps IS NOT NULL))[-1]
            AS initial_extra_steps,
        {n("event_name = 'spend_virtual_currency'")} AS num_spend_events,
        bool_or(event_name = 'app_remove') AS has_uninstalled
    FROM sess GROUP BY user_pseudo_id
),
dated_user_days AS (
    SELECT *, event_date = min(event_date) OVER (PARTITION BY user_pseudo_id) AS is_first_day
    FROM user_days
),
daily_active_users AS (
    SELECT event_date AS activity_date, count(*) AS dau, {n("is_first_day")} AS new_users,
        {n("NOT is_first_day")} AS returning_users,
        CAST(sum(num_sessions) AS BIGINT) AS num_sessions,
        CAST(sum(num_events) AS BIGINT) AS num_events,
        CAST(round(sum(CAST(engagement_minutes AS DECIMAL(38, 2))), 1) AS DOUBLE)
            AS engagement_minutes,
        {n("has_played_quickplay")} AS quickplay_users,
        {n("has_played_progressive")} AS progressive_users
    FROM dated_user_days GROUP BY event_date
),
openers AS (
    SELECT CAST(first_open_at AS DATE) AS cohort_date,
        coalesce(CAST(initial_extra_steps AS VARCHAR), 'unassigned') AS grant_bucket,
        (SELECT list(event_date) FROM user_days d WHERE d.user_pseudo_id = u.user_pseudo_id) AS days,
        (SELECT max(event_date) FROM user_days) AS last_date
    FROM dim_users u WHERE first_open_at IS NOT NULL
),
retention_cohorts AS (
    SELECT cohort_date, count(*) AS cohort_size,
    {per_day(n("list_contains(days, cohort_date + {d})") + " AS retained_d{d}")},
    {per_day("CASE WHEN cohort_date + {d} <= any_value(last_date) "
             "THEN round(retained_d{d} / cohort_size, 4) END AS retention_d{d}")}
    FROM openers GROUP BY cohort_date
),
retention_by_grant AS (
    SELECT grant_bucket, count(*) AS cohort_users,
    {per_day(n("cohort_date + {d} <= last_date") + " AS d{d}_denominator")},
    {per_day(n("list_contains(days, cohort_date + {d})") + " AS retained_d{d}")},
    {per_day("CASE WHEN d{d}_denominator > 0 "
             "THEN round(retained_d{d} / d{d}_denominator, 4) END AS retention_d{d}")}
    FROM openers GROUP BY grant_bucket
),
fct_events AS (
    SELECT {", ".join(FCT_EVENTS.fieldNames())} FROM sess
),
level_funnel_daily AS (
    SELECT {skey('event_date', 'board')} AS funnel_day_pk, event_date, board,
        {", ".join(n(f"event_name = 'level_{step}_quickplay'") + f" AS {column}"
                   for column, step in FUNNEL_STEPS.items())},
        {users("event_name = 'level_start_quickplay'")} AS users_starting,
        CASE WHEN starts > 0 THEN round(completes / starts, 4) END AS completion_rate
    FROM stg
    WHERE starts_with(event_name, 'level') AND ends_with(event_name, '_quickplay')
        AND board IS NOT NULL
    GROUP BY event_date, board
),
economy_daily AS (
    SELECT event_date,
        {n("event_name = 'spend_virtual_currency'")} AS spend_events,
        {amount("spend_virtual_currency")} AS steps_spent,
        {users("event_name = 'spend_virtual_currency'")} AS spenders,
        {n("event_name = 'use_extra_steps'")} AS use_events,
        {amount("use_extra_steps")} AS steps_used,
        {n("event_name = 'no_more_extra_steps'")} AS exhaustion_events,
        {users("event_name = 'no_more_extra_steps'")} AS exhausted_users,
        {n("event_name = 'ad_reward'")} AS ad_rewards,
        {amount("ad_reward")} AS steps_granted_by_ads
    FROM stg WHERE event_name IN {ECON} GROUP BY event_date
)"""


def with_models(final_select: str) -> str:
    """The shared model CTEs followed by one final SELECT."""
    return bigint_counts("WITH" + BASE_CTES + "\n" + final_select.strip() + "\n")


def bigint_counts(sql: str) -> str:
    """Rewrite ``count_if(p)`` as ``count(*) FILTER (WHERE p)``: the same count,
    typed BIGINT like Spark's (DuckDB's count_if is HUGEINT)."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = bigint_counts(sql[j + len(token):k - 1])
        out.append(sql[i:j] + f"count(*) FILTER (WHERE {inner})")
        i = k
