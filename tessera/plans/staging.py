"""Staging transforms (P1-P3): typed, cleaned views of the raw product
sources.  All are narrow projections + filters (no shuffle) except the user
dedup, which keeps the latest row per user with one hash aggregate."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import diff_boundaries, least_strict, to_utc, ts_lit
from tessera.operators.dedup import latest_per_key

SESSION_CAP_SECONDS = 14400


def _norm_upper(c: str):
    return F.upper(F.trim(F.col(c)))


def _norm_lower(c: str):
    return F.lower(F.trim(F.col(c)))


def stg_events(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    occurred = to_utc("occurred_at", source_tz)
    return (raw.where(F.col("event_id").isNotNull() & F.col("occurred_at").isNotNull())
            .select(
                F.col("event_id").cast("string").alias("event_id"),
                F.col("user_id").cast("string").alias("user_id"),
                F.col("session_id").cast("string").alias("session_id"),
                _norm_upper("event_type").alias("event_type"),
                F.col("page_url"),
                F.col("feature_name"),
                _norm_upper("platform").alias("platform"),
                _norm_upper("device_type").alias("device_type"),
                F.col("country_code"),
                _norm_upper("utm_source").alias("utm_source"),
                _norm_upper("utm_medium").alias("utm_medium"),
                _norm_upper("utm_campaign").alias("utm_campaign"),
                occurred.alias("occurred_at"),
                # Truncate the converted value (ruling R18).
                F.to_date(occurred).alias("event_date"),
                F.date_trunc("hour", occurred).cast("timestamp_ntz").alias("event_hour"),
                F.col("_loaded_at"),
                F.col("_source_file"),
            ))


def stg_users(raw: DataFrame, as_of: _dt.datetime, source_tz: str = "UTC") -> DataFrame:
    created = to_utc("created_at", source_tz)
    typed = (raw.where(F.col("user_id").isNotNull())
             .select(
                 F.col("user_id").cast("string").alias("user_id"),
                 _norm_lower("email").alias("email"),
                 F.trim("first_name").alias("first_name"),
                 F.trim("last_name").alias("last_name"),
                 _norm_lower("plan_name").alias("plan_name"),
                 _norm_lower("account_status").alias("account_status"),
                 _norm_lower("signup_source").alias("signup_source"),
                 _norm_upper("country_code").alias("country_code"),
                 created.alias("created_at"),
                 F.to_date(created).alias("signup_date"),
                 to_utc("updated_at", source_tz).alias("updated_at"),
                 F.datediff(F.lit(as_of.date()), F.to_date(created)).alias("days_since_signup"),
                 F.col("_loaded_at"),
             ))
    return latest_per_key(typed, ["user_id"], ["updated_at"], descending=True)


def stg_sessions(raw: DataFrame, as_of: _dt.datetime, source_tz: str = "UTC") -> DataFrame:
    started = to_utc("started_at", source_tz)
    ended = to_utc("ended_at", source_tz)
    # LEAST in the source dialect is NULL when an input is NULL (ruling R6):
    # an open session has no duration.
    duration = least_strict(diff_boundaries("second", started, ended),
                            F.lit(SESSION_CAP_SECONDS))
    now = ts_lit(as_of)
    return (raw.where(F.col("session_id").isNotNull() & F.col("started_at").isNotNull()
                      & (F.col("started_at") <= F.coalesce(F.col("ended_at"), now)))
            .select(
                F.col("session_id").cast("string").alias("session_id"),
                F.col("user_id").cast("string").alias("user_id"),
                started.alias("started_at"),
                ended.alias("ended_at"),
                F.to_date(started).alias("session_date"),
                duration.cast("long").alias("session_duration_seconds"),
                _norm_upper("platform").alias("platform"),
                _norm_upper("device_type").alias("device_type"),
                F.col("country_code"),
                F.col("page_views").cast("int").alias("page_views"),
                F.col("events_count").cast("int").alias("events_count"),
                F.col("_loaded_at"),
            ))
