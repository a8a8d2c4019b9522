"""Product analytics marts (M12-M14): daily user activity (full and
incremental), DAU/WAU/MAU with stickiness, and the conversion funnel."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import avg_int_round, diff_boundaries, ratio, ts_lit
from tessera.operators.merge import upsert
from tessera.operators.rolling import rolling_distinct

ACTIVITY_KEYS = ["user_id", "activity_date"]


def engagement_tier(active_minutes, feature_events, total_events):
    return (F.when((active_minutes >= 30) & (feature_events >= 5), "power")
            .when((active_minutes >= 10) | (feature_events >= 2), "engaged")
            .when(total_events >= 1, "casual")
            .otherwise("passive"))


# ── M12: daily user activity ──────────────────────────────────────────────
def daily_events(stg_events: DataFrame, from_date=None) -> DataFrame:
    ev = stg_events
    if from_date is not None:
        ev = ev.where(F.col("event_date") >= from_date)
    return ev.groupBy("user_id", F.col("event_date").alias("activity_date")).agg(
        F.count("*").alias("total_events"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("event_type").alias("distinct_event_types"),
        F.count_if(F.col("event_type") == "FEATURE_USED").alias("feature_events"),
        F.count_if(F.col("event_type") == "PAGE_VIEW").alias("page_views"),
        F.min("occurred_at").alias("first_event_at"),
        F.max("occurred_at").alias("last_event_at"),
    )


def user_activity(stg_events: DataFrame, stg_users: DataFrame, as_of: _dt.datetime,
                  from_date=None) -> DataFrame:
    da = daily_events(stg_events, from_date)
    u = stg_users.select("user_id", "plan_name", "signup_date", "country_code", "signup_source")
    j = da.join(u, "user_id", "left")
    active = diff_boundaries("minute", "first_event_at", "last_event_at")
    return j.select(
        "user_id", "activity_date", "plan_name", "signup_date", "country_code", "signup_source",
        F.datediff("activity_date", "signup_date").alias("days_since_signup"),
        F.date_trunc("week", "signup_date").cast("date").alias("signup_cohort_week"),
        "total_events", "sessions", "distinct_event_types", "feature_events", "page_views",
        active.alias("active_minutes"),
        "first_event_at", "last_event_at",
        engagement_tier(active, F.col("feature_events"), F.col("total_events"))
        .alias("engagement_tier"),
        ts_lit(as_of).alias("_updated_at"),
    )


def user_activity_incremental(stg_events: DataFrame, stg_users: DataFrame,
                              target: DataFrame | None, as_of: _dt.datetime,
                              lookback_days: int = 3) -> DataFrame:
    """Incremental merge on (user_id, activity_date) with a late-data lookback.

    First run (no target) processes all history.  Later runs recompute event
    dates >= max(activity_date) - lookback and merge them: matched keys are
    replaced, new keys inserted, untouched keys kept (merge semantics, so a
    vanished key is not deleted).
    """
    if target is None:
        return user_activity(stg_events, stg_users, as_of)
    # One scalar from the target: the cut-off date.
    max_date = target.agg(F.max("activity_date")).first()[0]
    if max_date is None:
        return user_activity(stg_events, stg_users, as_of)
    cutoff = max_date - _dt.timedelta(days=lookback_days)
    fresh = user_activity(stg_events, stg_users, as_of, from_date=F.lit(cutoff))
    return upsert(target, fresh, ACTIVITY_KEYS, allow_schema_sync=True)


# ── M13: DAU / WAU / MAU ──────────────────────────────────────────────────
def dau_wau_mau(user_activity_df: DataFrame, as_of: _dt.datetime) -> DataFrame:
    groups = ["activity_date", "plan_name", "country_code"]
    # The activity mart has one row per (user, day), so COUNT(DISTINCT user)
    # per day equals COUNT(user) and needs no distinct-aggregate shuffle.
    daily = user_activity_df.groupBy(*groups).agg(
        F.count("user_id").alias("dau"),
        F.sum("total_events").alias("daily_events"),
        F.sum("feature_events").alias("daily_feature_events"),
        avg_int_round("active_minutes").alias("avg_active_minutes"),
        F.count_if(F.col("engagement_tier") == "power").alias("power_users"),
        F.count_if(F.col("engagement_tier") == "engaged").alias("engaged_users"),
    )
    rolling = rolling_distinct(user_activity_df, "activity_date", ["plan_name", "country_code"],
                               "user_id", {"wau": 7, "mau": 28})
    j = daily.join(rolling, groups, "left")
    wau = F.coalesce(F.col("wau"), F.lit(0)).alias("wau")
    mau = F.coalesce(F.col("mau"), F.lit(0)).alias("mau")
    j = j.select(*groups, "dau", wau, mau, "daily_events", "daily_feature_events",
                 "avg_active_minutes", "power_users", "engaged_users")
    return j.select(
        "*",
        ratio("dau", "wau").alias("dau_wau_stickiness"),
        ratio("dau", "mau").alias("dau_mau_stickiness"),
        ratio("wau", "mau").alias("wau_mau_stickiness"),
        ratio("daily_feature_events", "daily_events").alias("feature_adoption_rate"),
        ts_lit(as_of).alias("_updated_at"),
    )


# ── M14: funnel ───────────────────────────────────────────────────────────
# Ordered funnel stages (event type, stage number, stage name).
FUNNEL_STAGES = [
    ("SIGNUP", 1, "Signup"),
    ("LOGIN", 2, "First Login"),
    ("FEATURE_USED", 3, "Feature Activated"),
    ("UPGRADE", 4, "Converted to Paid"),
]


def _stage_number(event_type):
    expr = None
    for et, n, _ in FUNNEL_STAGES:
        expr = (F.when(event_type == et, F.lit(n)) if expr is None
                else expr.when(event_type == et, F.lit(n)))
    return expr


def _stage_name(stage):
    expr = None
    for _, n, name in FUNNEL_STAGES:
        expr = (F.when(stage == n, F.lit(name)) if expr is None
                else expr.when(stage == n, F.lit(name)))
    return expr


def funnel(stg_events: DataFrame, stg_users: DataFrame, as_of: _dt.datetime,
           max_days: int | None = None) -> DataFrame:
    """One row per user: first time at each stage, furthest stage, gaps.

    The first-hit-per-stage aggregate and the pivot collapse into one
    aggregate per user: MIN over the stage's events is its first hit.
    ``max_days`` (ruling R8, off by default) keeps only events within that
    many days of signup.
    """
    types = [et for et, _, _ in FUNNEL_STAGES]
    ev = stg_events.where(F.col("event_type").isin(types)).select(
        "user_id", "occurred_at", _stage_number(F.col("event_type")).alias("funnel_stage"))
    users = stg_users.select("user_id", "signup_date", "plan_name", "country_code",
                             "signup_source")
    if max_days is not None:
        ev = (ev.join(users.select("user_id", "signup_date"), "user_id")
              .where(F.datediff(F.to_date("occurred_at"), F.col("signup_date")) <= max_days)
              .drop("signup_date"))
    stage_ts = {n: F.min(F.when(F.col("funnel_stage") == n, F.col("occurred_at")))
                for _, n, _ in FUNNEL_STAGES}
    per_user = ev.groupBy("user_id").agg(
        stage_ts[1].alias("signed_up_at"), stage_ts[2].alias("first_login_at"),
        stage_ts[3].alias("activated_at"), stage_ts[4].alias("converted_at"),
        F.max("funnel_stage").alias("max_stage_reached"))
    j = users.join(per_user, "user_id", "left")
    s, lg, act, cv = (F.col(c) for c in ("signed_up_at", "first_login_at", "activated_at",
                                         "converted_at"))
    return j.select(
        "user_id", "signup_date", "plan_name", "country_code", "signup_source",
        F.date_trunc("week", "signup_date").cast("date").alias("signup_cohort_week"),
        "signed_up_at", "first_login_at", "activated_at", "converted_at",
        "max_stage_reached",
        _stage_name(F.col("max_stage_reached")).alias("furthest_stage_name"),
        diff_boundaries("hour", s, lg).alias("hours_to_first_login"),
        diff_boundaries("hour", s, act).alias("hours_to_activation"),
        diff_boundaries("hour", s, cv).alias("hours_to_conversion"),
        s.isNotNull().alias("did_signup"),
        lg.isNotNull().alias("did_first_login"),
        act.isNotNull().alias("did_activate"),
        cv.isNotNull().alias("did_convert"),
        F.coalesce(act.isNotNull() & (diff_boundaries("day", s, act) <= 7), F.lit(False))
        .alias("activated_within_7d"),
        ts_lit(as_of).alias("_updated_at"),
    )


# ── X2: weekly cohort retention ──────────────────────────────────────────
def cohort_retention(user_activity_df: DataFrame) -> DataFrame:
    """Cohort = week of a user's first activity; retention = share of the
    cohort active in each later week."""
    ua = user_activity_df.select("user_id", F.date_trunc("week", "activity_date").cast("date")
                                 .alias("activity_week"))
    first = ua.groupBy("user_id").agg(F.min("activity_week").alias("cohort_week"))
    active = (ua.join(first, "user_id")
              .select("cohort_week", "user_id",
                      (F.datediff("activity_week", "cohort_week") / 7).cast("int")
                      .alias("week_offset"))
              .distinct())
    sizes = first.groupBy("cohort_week").agg(F.count("*").alias("cohort_size"))
    counts = active.groupBy("cohort_week", "week_offset").agg(F.count("*").alias("active_users"))
    return (counts.join(sizes, "cohort_week")
            .select("cohort_week", "week_offset", "cohort_size", "active_users",
                    ratio("active_users", "cohort_size").alias("retention_rate")))


def cohort_retention_monthly(user_activity_df: DataFrame) -> DataFrame:
    """Cohort = month of a user's first activity; per later month its active
    users, their share of the cohort, and that share over the month before's."""
    ua = user_activity_df.select("user_id", F.trunc("activity_date", "month").alias("activity_month")).distinct()
    first = ua.groupBy("user_id").agg(F.min("activity_month").alias("cohort_month"))
    sizes = first.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    offset = F.months_between("activity_month", "cohort_month").cast("int")
    counts = (ua.join(first, "user_id").groupBy("cohort_month", offset.alias("month_offset"))
              .agg(F.count(F.lit(1)).alias("active_users")))
    before = counts.select("cohort_month", (F.col("month_offset") + 1).alias("month_offset"),
                           F.col("active_users").alias("before"))
    return (counts.join(sizes, "cohort_month").join(before, ["cohort_month", "month_offset"], "left")
            .select("cohort_month", "month_offset", "cohort_size", "active_users",
                    ratio("active_users", "cohort_size").alias("retention_rate"),
                    ratio("active_users", "before").alias("month_over_month_rate")))


# ── X12: time-to-convert percentiles ─────────────────────────────────────
def time_to_convert(funnel_df: DataFrame) -> DataFrame:
    """Exact P25 / P50 / P75 (linear interpolation) of hours from signup to
    each later stage.  ``percentile`` keeps a value -> count map per group,
    so memory follows the number of distinct hour values, not of users."""
    stages = [("first_login", "hours_to_first_login"), ("activation", "hours_to_activation"),
              ("conversion", "hours_to_conversion")]
    pairs = ", ".join(f"'{s}', `{c}`" for s, c in stages)
    long = (funnel_df.select(F.expr(f"stack({len(stages)}, {pairs}) as (stage, hours)"))
            .where(F.col("hours").isNotNull()))
    q = F.percentile(F.col("hours"), [0.25, 0.5, 0.75])
    return (long.groupBy("stage").agg(F.count("*").alias("users"), q.alias("_q"))
            .select("stage", "users", F.col("_q")[0].alias("p25_hours"),
                    F.col("_q")[1].alias("p50_hours"), F.col("_q")[2].alias("p75_hours")))


# ── X13: rolling 7-day DAU average ───────────────────────────────────────
def dau_rolling_avg(dau_df: DataFrame, days: int = 7) -> DataFrame:
    """Mean DAU over the trailing ``days`` calendar days per plan/country."""
    w = (Window.partitionBy("plan_name", "country_code")
         .orderBy(F.datediff("activity_date", F.lit("1970-01-01").cast("date")))
         .rangeBetween(-(days - 1), 0))
    return dau_df.select(
        "activity_date", "plan_name", "country_code", "dau",
        F.round(F.sum("dau").over(w).cast("decimal(20,0)") / F.count("dau").over(w), 4)
        .cast("double").alias("dau_7d_avg"))


# ── X9: approximate distinct counts and quantiles ────────────────────────
def approx_activity_stats(user_activity_df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Per plan: HLL distinct users and approximate active-minute quartiles,
    both with bounded per-group state."""
    return user_activity_df.groupBy("plan_name").agg(
        F.approx_count_distinct("user_id", rsd).alias("approx_users"),
        F.percentile_approx("active_minutes", [0.25, 0.5, 0.75], 10000).alias("minutes_quartiles"),
        F.count("*").alias("user_days"))


def refresh_user_activity(table, stg_events: DataFrame, stg_users: DataFrame,
                          as_of: _dt.datetime, lookback_days: int = 3) -> int:
    """S11 against a ``sinks.PartitionedTable`` partitioned by activity date:
    the first run writes everything; later runs recompute event dates from
    max(activity_date) - lookback and rewrite only those date partitions.
    The max date aggregates the partition column only (no data columns are
    read).  Returns the number of partitions rewritten."""
    from tessera.operators.merge import upsert_partitions
    if not table.exists():
        table.create(user_activity(stg_events, stg_users, as_of))
        return -1
    max_date = table.read().agg(F.max("activity_date")).first()[0]
    cutoff = max_date - _dt.timedelta(days=lookback_days)
    fresh = user_activity(stg_events, stg_users, as_of, from_date=F.lit(cutoff))
    return upsert_partitions(table, fresh, ACTIVITY_KEYS, allow_schema_sync=True)
