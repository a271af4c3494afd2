"""Adapter from the driver's flat ``events`` table to the raw nested schema.

The rules are deterministic and integer-only so that the DuckDB oracle can
repeat them as a flat CTE (see ``playmetrics.plans.oracle``). Each rule is
stated once here as data and rendered both as a Spark ``Column`` and as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.functions.cache import per_jvm
from playmetrics.schema import EVENT_PARAMS_TYPE, RAW_SCHEMA, USER_PROPERTIES_TYPE
from playmetrics.session import configure

# Fixed values of the fixture mapping. ``k`` is the integer in ``props``.
# event_type -> list of (highest k inclusive, event_name), in k order.
EVENT_NAME_RULES: dict[str, list[tuple[int, str]]] = {
    "signup": [(9, "first_open"), (19, "app_remove"), (59, "session_start"),
               (99, "screen_view")],
    "view": [(49, "screen_view"), (99, "user_engagement")],
    "click": [(44, "level_start_quickplay"), (64, "level_end_quickplay"),
              (79, "level_complete_quickplay"), (87, "level_fail_quickplay"),
              (93, "level_retry_quickplay"), (99, "level_reset_quickplay")],
    "purchase": [(49, "spend_virtual_currency"), (69, "use_extra_steps"),
                 (84, "ad_reward"), (99, "no_more_extra_steps")],
    "error": [(59, "level_start"), (79, "level_fail"), (89, "post_score"),
              (99, "app_exception")],
}
COUNTRIES = ["Arvenia", "Brelland", "Corvania", "Dunmarch", "Estoria"]
BOARDS = ["S", "M", "L"]
GRANTS = ["3", "5", "10", "20"]          # user_id % 5 == 4 -> no grant property
LANGUAGES = ["en-us", "pt-br", "ja-jp"]
MEDIUMS = ["organic", "cpc", "referral"]
SOURCES = ["google-play", "app-store", "ad-network"]
ECONOMY_EVENTS = ["spend_virtual_currency", "use_extra_steps", "ad_reward",
                  "no_more_extra_steps"]
PROGRESSIVE_LEVEL_EVENTS = ["level_start", "level_fail"]
FIRST_TOUCH_BASE = "2023-12-01 00:00:00"   # plus user_id hours
HOUR_US = 3_600_000_000


def event_name_sql(event_type: str = "event_type", k: str = "k") -> str:
    """CASE expression mapping (event_type, k) to an event name; valid in Spark and DuckDB."""
    parts = ["CASE"]
    for etype, rules in EVENT_NAME_RULES.items():
        for upper, name in rules:
            parts.append(f" WHEN {event_type} = '{etype}' AND {k} <= {upper} THEN '{name}'")
    parts.append(" END")
    return "".join(parts)


def pick_sql(values: list[str], index_expr: str) -> str:
    """CASE choosing ``values[index_expr]``; valid in Spark and DuckDB."""
    whens = "".join(f" WHEN {index_expr} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE{whens} END"


def _kv(key: str, string_value: Column | None = None, int_value: Column | None = None,
        double_value: Column | None = None, cond: Column | None = None) -> Column:
    null_s, null_l, null_d = (F.lit(None).cast(t) for t in ("string", "bigint", "double"))
    value = F.struct(
        (string_value if string_value is not None else null_s).alias("string_value"),
        (int_value if int_value is not None else null_l).alias("int_value"),
        null_d.alias("float_value"),
        (double_value if double_value is not None else null_d).alias("double_value"),
    )
    entry = F.array(F.struct(F.lit(key).alias("key"), value.alias("value")))
    return F.when(cond, entry).otherwise(F.array().cast(EVENT_PARAMS_TYPE))


def _present(*optional: Column) -> Column:
    """Concatenate zero-or-one-element arrays (no lambda, stays in codegen)."""
    return F.flatten(F.array(*optional))


def adapt_events(events: DataFrame) -> DataFrame:
    """Map the flat ``events`` table onto RAW_SCHEMA (one raw row per event)."""
    parsed, named, nested, typed = _adapter_columns()
    return events.select(*parsed).select(*named).select(*nested).select(*typed)


@per_jvm
def _adapter_columns() -> tuple[list[Column], ...]:
    parsed = [
        "event_id", "user_id", "value",
        F.col("ts").cast("timestamp").alias("_ts"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("event_type"),
    ]
    named = ["event_id", "user_id", "value", "_ts", "k",
             F.expr(event_name_sql()).alias("_name")]

    name, k, eid, uid = F.col("_name"), F.col("k"), F.col("event_id"), F.col("user_id")
    even_id = (eid % 2) == 0
    level = 1 + k % 30
    value = 1 + k % 20
    is_economy = name.isin(ECONOMY_EVENTS)

    params = _present(
        _kv("firebase_screen_class", string_value=F.concat(F.lit("Screen"), (k % 4).cast("string")),
            cond=name.isin("screen_view", "user_engagement")),
        _kv("firebase_screen", string_value=F.lit("main"),
            cond=(name == "screen_view") & ((k % 2) == 0)),
        _kv("engagement_time_msec", int_value=1000 * (k + 1), cond=name == "user_engagement"),
        _kv("board", string_value=F.expr(pick_sql(BOARDS, "event_id % 3")),
            cond=name.like("%_quickplay")),
        _kv("level", int_value=F.when(even_id, level),
            double_value=F.when(~even_id, level.cast("double")), cond=name.startswith("level_")),
        _kv("level_name", string_value=F.concat(F.lit("level-"), level.cast("string")),
            cond=name.isin(PROGRESSIVE_LEVEL_EVENTS)),
        _kv("score", double_value=F.col("value"), cond=name == "post_score"),
        _kv("value", int_value=F.when(even_id, value),
            double_value=F.when(~even_id, value.cast("double")), cond=is_economy),
        _kv("virtual_currency_name", string_value=F.lit("steps"), cond=is_economy),
        _kv("item_name", string_value=level.cast("string"), cond=is_economy),
    )

    first_touch_us = F.unix_micros(F.lit(FIRST_TOUCH_BASE).cast("timestamp")) + uid * HOUR_US
    grant = F.expr(pick_sql(GRANTS, "user_id % 5"))
    user_props = F.when(grant.isNotNull(), F.array(F.struct(
        F.lit("initial_extra_steps").alias("key"),
        F.struct(grant.alias("string_value"), F.lit(None).cast("bigint").alias("int_value"),
                 F.lit(None).cast("double").alias("float_value"),
                 F.lit(None).cast("double").alias("double_value"),
                 first_touch_us.alias("set_timestamp_micros")).alias("value")),
    )).otherwise(F.array().cast(USER_PROPERTIES_TYPE))

    android = (uid % 2) == 0
    platform = F.when(android, "ANDROID").otherwise("IOS")
    device = F.struct(
        F.when((uid % 4) == 3, "tablet").otherwise("mobile").alias("category"),
        F.lit(None).cast("string").alias("mobile_brand_name"),
        F.lit(None).cast("string").alias("mobile_model_name"),
        F.lit(None).cast("string").alias("mobile_marketing_name"),
        F.lit(None).cast("string").alias("mobile_os_hardware_model"),
        F.when(android, "Android").otherwise("iOS").alias("operating_system"),
        F.lit(None).cast("string").alias("operating_system_version"),
        F.lit(None).cast("string").alias("vendor_id"),
        F.lit(None).cast("string").alias("advertising_id"),
        F.expr(pick_sql(LANGUAGES, "user_id % 3")).alias("language"),
        F.lit("No").alias("is_limited_ad_tracking"),
        F.lit(0).cast("bigint").alias("time_zone_offset_seconds"),
        F.lit(None).cast("string").alias("browser"),
        F.lit(None).cast("string").alias("browser_version"),
        F.lit(None).cast("struct<browser:string,browser_version:string,hostname:string>")
        .alias("web_info"),
    )
    geo = F.struct(
        F.lit("Imagined").alias("continent"),
        F.when((eid % 7) != 0, F.expr(pick_sql(COUNTRIES, "event_id % 5"))).alias("country"),
        *[F.lit(None).cast("string").alias(n) for n in ("region", "city", "sub_continent", "metro")],
    )
    app_info = F.struct(
        F.lit("com.example.puzzlegame").alias("id"),
        F.concat(F.lit("1."), (uid % 3).cast("string")).alias("version"),
        F.lit("store").alias("install_store"),
        F.lit(None).cast("string").alias("firebase_app_id"),
        F.lit(None).cast("string").alias("install_source"),
    )
    traffic = F.struct(
        F.concat(F.lit("campaign-"), (uid % 3).cast("string")).alias("name"),
        F.when((eid % 4) != 0, F.expr(pick_sql(MEDIUMS, "user_id % 3"))).alias("medium"),
        F.expr(pick_sql(SOURCES, "user_id % 3")).alias("source"),
    )
    nested = [
        F.date_format("_ts", "yyyyMMdd").alias("event_date"),
        F.unix_micros("_ts").alias("event_timestamp"),
        name.alias("event_name"),
        params.alias("event_params"),
        F.lit(None).cast("bigint").alias("event_previous_timestamp"),
        F.when(is_economy, F.col("value")).alias("event_value_in_usd"),
        eid.alias("event_bundle_sequence_id"),
        F.lit(0).cast("bigint").alias("event_server_timestamp_offset"),
        F.lit(None).cast("string").alias("user_id"),
        uid.cast("string").alias("user_pseudo_id"),
        user_props.alias("user_properties"),
        first_touch_us.alias("user_first_touch_timestamp"),
        F.lit(None).cast("struct<revenue:double,currency:string>").alias("user_ltv"),
        device.alias("device"),
        geo.alias("geo"),
        app_info.alias("app_info"),
        traffic.alias("traffic_source"),
        F.when(android, "100").otherwise("200").alias("stream_id"),
        platform.alias("platform"),
        F.lit(None).cast("struct<hostname:string>").alias("event_dimensions"),
    ]
    # casts (not DataFrame.to) relax nested nullability without a lambda
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]
    return parsed, named, nested, typed


def read_fixture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events derived from ``{sf_dir}/events.parquet``.

    A task reads whole row groups, and a file may hold few large ones. The flat
    rows are dealt over all tasks before they are nested, staged and hashed,
    which is by far the larger work.
    """
    configure(spark)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return adapt_events(events.hint("rebalance"))
