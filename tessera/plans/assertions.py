"""Declarative and singular data tests.

Each test returns its failing rows (empty = pass) as a DataFrame, so a test
run is an ordinary Spark job whose output can be logged or gated on.

* ``unique`` / ``accepted_values`` return the offending values with counts
  (one hash aggregate per tested column; NULLs excluded as in the source).
* ``not_null`` / ``accepted_range`` fold every tested column of a model into
  one aggregate pass and return one row per column with its failure count.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import ts_lit


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def unique(df: DataFrame, model: str, column: str, expr: Column | None = None) -> DataFrame:
    value = (expr if expr is not None else F.col(column)).cast("string")
    return (df.select(value.alias("value")).where(F.col("value").isNotNull())
            .groupBy("value").agg(F.count("*").alias("n_records"))
            .where(F.col("n_records") > 1)
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    "value", "n_records"))


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return (counts.select(F.expr(f"stack({len(columns)}, {pairs}) as (column_name, failures)"))
            .select(F.lit(model).alias("model"), "column_name",
                    F.col("failures").cast("long").alias("failures")))


def accepted_values(df: DataFrame, model: str, column: str, values: Sequence) -> DataFrame:
    c = F.col(column)
    return (df.where(c.isNotNull() & ~c.isin(list(values)))
            .groupBy(c.cast("string").alias("value")).agg(F.count("*").alias("n_records"))
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    "value", "n_records"))


def accepted_range(df: DataFrame, model: str, bounds: dict[str, tuple]) -> DataFrame:
    """``bounds``: column -> (min or None, max or None), both inclusive."""
    aggs = []
    for col, (lo, hi) in bounds.items():
        c = F.col(col)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < lo)
        if hi is not None:
            bad = bad | (c > hi)
        aggs.append(F.count_if(F.coalesce(bad, F.lit(False))).alias(col))
    counts = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}`" for c in bounds)
    return (counts.select(F.expr(f"stack({len(bounds)}, {pairs}) as (column_name, failures)"))
            .select(F.lit(model).alias("model"), "column_name",
                    F.col("failures").cast("long").alias("failures")))


def no_future_events(stg_events: DataFrame, as_of: _dt.datetime,
                     tolerance_hours: int = 1) -> DataFrame:
    """Events stamped more than ``tolerance_hours`` after ``as_of``."""
    limit = F.timestamp_add("HOUR", F.lit(tolerance_hours), ts_lit(as_of))
    return (stg_events.where(F.col("occurred_at") > limit)
            .select("event_id", "user_id", "occurred_at", ts_lit(as_of).alias("tested_at")))


def funnel_order(funnel: DataFrame) -> DataFrame:
    """Stage timestamps out of order, one row per violation.

    One scan: each row carries the array of violated rules, exploded."""
    s, lg, act, cv = (F.col(c) for c in ("signed_up_at", "first_login_at", "activated_at",
                                         "converted_at"))
    rules = F.array(
        F.when(lg < s, F.lit("login_before_signup")),
        F.when(act.isNotNull() & lg.isNotNull() & (act < lg), F.lit("activation_before_login")),
        F.when(cv.isNotNull() & act.isNotNull() & (cv < act),
               F.lit("conversion_before_activation")))
    return (funnel.select("user_id", "signed_up_at", "first_login_at", "activated_at",
                          "converted_at", F.explode(F.array_compact(rules)).alias("violation_type")))


def source_freshness(sources: dict[str, DataFrame], as_of: _dt.datetime,
                     loaded_at: str = "_loaded_at", warn_hours: int = 6,
                     error_hours: int = 24) -> DataFrame:
    """Age of the newest load per source: pass / warn / error."""
    now = ts_lit(as_of)
    rows = []
    for name, df in sources.items():
        rows.append(df.agg(F.max(loaded_at).alias("max_loaded_at"))
                    .select(F.lit(name).alias("source_name"), "max_loaded_at"))
    u = _union(rows)
    secs = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    age = secs / 3600.0
    return u.select(
        "source_name", "max_loaded_at",
        F.round(secs.cast("decimal(20,0)") / 3600, 2).cast("double").alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(age > error_hours, "error").when(age > warn_hours, "warn").otherwise("pass")
         .alias("status"))


# ── the project's declared tests ─────────────────────────────────────────
# Accepted value lists from the source and model declarations.
RAW_EVENT_TYPES = ["page_view", "feature_used", "session_start", "session_end", "signup",
                   "login", "upgrade", "downgrade", "cancellation"]
STG_EVENT_TYPES = ["PAGE_VIEW", "FEATURE_USED", "SESSION_START", "SESSION_END", "SIGNUP",
                   "LOGIN", "UPGRADE", "DOWNGRADE", "CANCELLATION"]
PLANS = ["free", "starter", "growth", "enterprise"]
TIERS = ["power", "engaged", "casual", "passive"]
FUNNEL_STAGE_VALUES = [1, 2, 3, 4]
SUBSCRIPTION_EVENTS = ["created", "upgraded", "downgraded", "cancelled", "reactivated"]


def declared_unique(m: dict[str, DataFrame]) -> DataFrame:
    return _union([
        unique(m["raw_events"], "events", "event_id"),
        unique(m["raw_users"], "users", "user_id"),
        unique(m["raw_users"], "users", "email"),
        unique(m["raw_sessions"], "sessions", "session_id"),
        unique(m["raw_subscriptions"], "subscriptions", "subscription_id"),
        unique(m["stg_events"], "stg_events", "event_id"),
        unique(m["stg_users"], "stg_users", "user_id"),
        unique(m["stg_users"], "stg_users", "email"),
        unique(m["stg_sessions"], "stg_sessions", "session_id"),
        unique(m["user_activity"], "mart_user_activity", "user_id_activity_date",
               F.concat(F.col("user_id"), F.lit("-"), F.col("activity_date").cast("string"))),
        unique(m["funnel"], "mart_funnel_analysis", "user_id"),
    ])


def declared_not_null(m: dict[str, DataFrame]) -> DataFrame:
    return _union([
        not_null(m["raw_events"], "events", ["event_id", "user_id", "event_type", "occurred_at"]),
        not_null(m["raw_users"], "users", ["user_id", "email"]),
        not_null(m["raw_sessions"], "sessions", ["session_id", "user_id"]),
        not_null(m["raw_subscriptions"], "subscriptions", ["subscription_id", "user_id"]),
        not_null(m["stg_events"], "stg_events",
                 ["event_id", "user_id", "event_type", "occurred_at", "event_date"]),
        not_null(m["stg_users"], "stg_users", ["user_id", "email", "plan_name", "signup_date"]),
        not_null(m["stg_sessions"], "stg_sessions",
                 ["session_id", "user_id", "session_duration_seconds"]),
        not_null(m["user_activity"], "mart_user_activity", ["user_id", "activity_date"]),
        not_null(m["dau_wau_mau"], "mart_dau_wau_mau", ["activity_date", "dau"]),
        not_null(m["funnel"], "mart_funnel_analysis", ["user_id", "max_stage_reached"]),
    ])


def declared_accepted_values(m: dict[str, DataFrame]) -> DataFrame:
    return _union([
        accepted_values(m["raw_events"], "events", "event_type", RAW_EVENT_TYPES),
        accepted_values(m["raw_users"], "users", "plan_name", PLANS),
        accepted_values(m["raw_subscriptions"], "subscriptions", "event_type", SUBSCRIPTION_EVENTS),
        accepted_values(m["stg_events"], "stg_events", "event_type", STG_EVENT_TYPES),
        accepted_values(m["stg_users"], "stg_users", "plan_name", PLANS),
        accepted_values(m["user_activity"], "mart_user_activity", "engagement_tier", TIERS),
        accepted_values(m["funnel"], "mart_funnel_analysis", "max_stage_reached",
                        FUNNEL_STAGE_VALUES),
    ])


def declared_accepted_range(m: dict[str, DataFrame]) -> DataFrame:
    return _union([
        accepted_range(m["stg_sessions"], "stg_sessions", {"session_duration_seconds": (0, 14400)}),
        accepted_range(m["user_activity"], "mart_user_activity", {"total_events": (1, None)}),
        accepted_range(m["dau_wau_mau"], "mart_dau_wau_mau",
                       {"dau": (0, None), "dau_mau_stickiness": (0, 1)}),
        accepted_range(m["funnel"], "mart_funnel_analysis", {"hours_to_activation": (0, None)}),
    ])
