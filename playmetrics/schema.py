"""Raw event schema and the column contracts of every mart.

The raw schema is the superset of all export days: older days lack some
late-added fields, and reading them with this explicit schema fills those
fields with NULL, so nothing is inferred at run time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types have to match the export and the declared marts.
_S = T.StringType()
_L = T.LongType()
_D = T.DoubleType()


def _kv_array(with_set_timestamp: bool) -> T.ArrayType:
    value_fields = [
        T.StructField("string_value", _S),
        T.StructField("int_value", _L),
        T.StructField("float_value", _D),
        T.StructField("double_value", _D),
    ]
    if with_set_timestamp:
        value_fields.append(T.StructField("set_timestamp_micros", _L))
    entry = T.StructType([
        T.StructField("key", _S),
        T.StructField("value", T.StructType(value_fields)),
    ])
    return T.ArrayType(entry, containsNull=True)


EVENT_PARAMS_TYPE = _kv_array(with_set_timestamp=False)
USER_PROPERTIES_TYPE = _kv_array(with_set_timestamp=True)

DEVICE_TYPE = T.StructType([
    T.StructField(name, _S) for name in (
        "category", "mobile_brand_name", "mobile_model_name", "mobile_marketing_name",
        "mobile_os_hardware_model", "operating_system", "operating_system_version",
        "vendor_id", "advertising_id", "language", "is_limited_ad_tracking",
    )
] + [
    T.StructField("time_zone_offset_seconds", _L),
    T.StructField("browser", _S),
    T.StructField("browser_version", _S),
    T.StructField("web_info", T.StructType([
        T.StructField("browser", _S),
        T.StructField("browser_version", _S),
        T.StructField("hostname", _S),
    ])),
])

GEO_TYPE = T.StructType([T.StructField(n, _S) for n in (
    "continent", "country", "region", "city", "sub_continent", "metro")])
APP_INFO_TYPE = T.StructType([T.StructField(n, _S) for n in (
    "id", "version", "install_store", "firebase_app_id", "install_source")])
TRAFFIC_SOURCE_TYPE = T.StructType([T.StructField(n, _S) for n in ("name", "medium", "source")])

RAW_SCHEMA = T.StructType([
    T.StructField("event_date", _S),
    T.StructField("event_timestamp", _L),
    T.StructField("event_name", _S),
    T.StructField("event_params", EVENT_PARAMS_TYPE),
    T.StructField("event_previous_timestamp", _L),
    T.StructField("event_value_in_usd", _D),
    T.StructField("event_bundle_sequence_id", _L),
    T.StructField("event_server_timestamp_offset", _L),
    T.StructField("user_id", _S),
    T.StructField("user_pseudo_id", _S),
    T.StructField("user_properties", USER_PROPERTIES_TYPE),
    T.StructField("user_first_touch_timestamp", _L),
    T.StructField("user_ltv", T.StructType([
        T.StructField("revenue", _D), T.StructField("currency", _S)])),
    T.StructField("device", DEVICE_TYPE),
    T.StructField("geo", GEO_TYPE),
    T.StructField("app_info", APP_INFO_TYPE),
    T.StructField("traffic_source", TRAFFIC_SOURCE_TYPE),
    T.StructField("stream_id", _S),
    T.StructField("platform", _S),
    T.StructField("event_dimensions", T.StructType([T.StructField("hostname", _S)])),
])

# Partition column of the loaded raw table (one directory per export day).
RAW_PARTITION_COLUMN = "shard_date"

def _contract(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


_DATE = T.DateType()
_TS = T.TimestampType()
_BOOL = T.BooleanType()

FCT_EVENTS = _contract(
    ("event_pk", _S), ("event_date", _DATE), ("event_at", _TS), ("event_name", _S),
    ("user_pseudo_id", _S), ("session_id", _S), ("platform", _S), ("device_category", _S),
    ("device_os", _S), ("country", _S), ("app_version", _S), ("board", _S),
    ("level_number", _L), ("level_name", _S), ("score", _D), ("event_value", _D),
    ("virtual_currency_name", _S), ("item_name", _S), ("screen_class", _S),
    ("engagement_time_msec", _L), ("initial_extra_steps", _L),
)

DIM_USERS = _contract(
    ("user_pseudo_id", _S), ("first_open_at", _TS), ("has_observed_first_open", _BOOL),
    ("first_touch_at", _TS), ("first_seen_date", _DATE), ("last_seen_date", _DATE),
    ("num_days_active", _L), ("num_sessions", _L), ("num_events", _L), ("platform", _S),
    ("first_country", _S), ("acquisition_medium", _S), ("acquisition_source", _S),
    ("initial_extra_steps", _L), ("num_spend_events", _L), ("has_uninstalled", _BOOL),
)

DAILY_ACTIVE_USERS = _contract(
    ("activity_date", _DATE), ("dau", _L), ("new_users", _L), ("returning_users", _L),
    ("num_sessions", _L), ("num_events", _L), ("engagement_minutes", _D),
    ("quickplay_users", _L), ("progressive_users", _L),
)

RETENTION_COHORTS = _contract(
    ("cohort_date", _DATE), ("cohort_size", _L), ("retained_d1", _L), ("retained_d7", _L),
    ("retained_d30", _L), ("retention_d1", _D), ("retention_d7", _D), ("retention_d30", _D),
)

RETENTION_BY_GRANT = _contract(
    ("grant_bucket", _S), ("cohort_users", _L), ("d1_denominator", _L),
    ("d7_denominator", _L), ("d30_denominator", _L), ("retained_d1", _L),
    ("retained_d7", _L), ("retained_d30", _L), ("retention_d1", _D),
    ("retention_d7", _D), ("retention_d30", _D),
)

LEVEL_FUNNEL_DAILY = _contract(
    ("funnel_day_pk", _S), ("event_date", _DATE), ("board", _S), ("starts", _L),
    ("ends", _L), ("completes", _L), ("fails", _L), ("retries", _L), ("resets", _L),
    ("users_starting", _L), ("completion_rate", _D),
)

ECONOMY_DAILY = _contract(
    ("event_date", _DATE), ("spend_events", _L), ("steps_spent", _D), ("spenders", _L),
    ("use_events", _L), ("steps_used", _D), ("exhaustion_events", _L),
    ("exhausted_users", _L), ("ad_rewards", _L), ("steps_granted_by_ads", _D),
)

MART_CONTRACTS: dict[str, T.StructType] = {
    "fct_events": FCT_EVENTS,
    "dim_users": DIM_USERS,
    "daily_active_users": DAILY_ACTIVE_USERS,
    "retention_cohorts": RETENTION_COHORTS,
    "retention_by_extra_steps_grant": RETENTION_BY_GRANT,
    "level_funnel_daily": LEVEL_FUNNEL_DAILY,
    "extra_steps_economy_daily": ECONOMY_DAILY,
}

# Tables that builds start from: what a user did on a day, and a user's days added up.
_LATEST = {name: T.StructType([T.StructField("event_at", _TS), T.StructField("event_pk", _S),
                               T.StructField("v", kind)])
           for name, kind in (("first_country", _S), ("acquisition_medium", _S),
                              ("acquisition_source", _S), ("initial_extra_steps", _L))}
STATE_SCHEMA = _contract(
    ("user_pseudo_id", _S), ("event_date", _DATE), ("num_events", _L), ("num_sessions", _L),
    ("has_first_open", _BOOL), ("has_played_quickplay", _BOOL), ("has_played_progressive", _BOOL),
    ("has_spent_steps", _BOOL), ("engagement_minutes", _D), ("first_open_at", _TS),
    ("first_touch_at", _TS), ("platform", _S), *_LATEST.items(), ("num_spend_events", _L),
    ("num_uninstalls", _L), ("last_at", _TS), ("sessions_through", _L),
)
TOTALS_SCHEMA = _contract(
    ("user_pseudo_id", _S), ("first_open_at", _TS), ("first_touch_at", _TS),
    ("first_seen_date", _DATE), ("last_seen_date", _DATE), ("num_days_active", _L),
    ("num_sessions", _L), ("num_events", _L), ("platform", _S), *_LATEST.items(),
    ("num_spend_events", _L), ("num_uninstalls", _L), ("last_at", _TS),
    ("days", T.ArrayType(T.StructType([T.StructField("block", T.IntegerType()),
                                       T.StructField("bits", _L)]))),
)
