"""Named queries: (spark, data_dir) -> DataFrame, one per inventory item.

Parameters that the source took from the wall clock are fixed here so runs
are repeatable; each is chosen inside the fixture's date range.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import calendar, exprs
from tessera.operators import incremental, merge, quantiles, sinks, vault
from tessera.plans import (assertions, clinical, load_runs, loads, nested_claims, population,
                           product, quality, staging)
from tessera.plans.product import ACTIVITY_KEYS
from tessera.session import scratch_path
from tessera.sources import bindings as b
from tessera.sources import fhir, ingest
from tessera.sources import scenarios as sc
from tessera.sources.tables import Tables
from tessera.streaming import activity as activity_stream
from tessera.streaming import aggregates as agg_stream
from tessera.streaming import claims as claims_stream

# Fixed run parameters (the source used CURRENT_DATE / CURRENT_TIMESTAMP).
CLINICAL_YEAR = 1998
COST_REPORT_MIN_ENCOUNTERS = 30

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


# ── clinical (M1-M7) ──────────────────────────────────────────────────────
@register("readmission_30d")
def q_readmission_30d(spark, root):
    return clinical.readmission_30d(b.fact_encounter(Tables(spark, root)))


@register("provider_scorecard")
def q_provider_scorecard(spark, root):
    t = Tables(spark, root)
    return clinical.provider_scorecard(b.fact_encounter(t), b.dim_provider(t), CLINICAL_YEAR)


@register("chronic_progression")
def q_chronic_progression(spark, root):
    t = Tables(spark, root)
    return clinical.chronic_progression(b.fact_encounter(t), b.bridge_encounter_diagnosis(t),
                                        b.dim_diagnosis(t))


@register("revenue_trend")
def q_revenue_trend(spark, root):
    return clinical.revenue_trend(b.fact_claim(Tables(spark, root)))


@register("provider_avg_charges")
def q_provider_avg_charges(spark, root):
    return clinical.provider_avg_charges(b.fact_encounter(Tables(spark, root)))


@register("readmitted_patients")
def q_readmitted_patients(spark, root):
    t = Tables(spark, root)
    return clinical.readmitted_patients(b.dim_patient(t), b.fact_encounter(t))


@register("provider_cost_report")
def q_provider_cost_report(spark, root):
    t = Tables(spark, root)
    return clinical.provider_cost_report(b.fact_encounter(t), b.dim_provider(t), CLINICAL_YEAR,
                                         COST_REPORT_MIN_ENCOUNTERS)


# ── product staging and marts (M11-M14, S11) ─────────────────────────────
PRODUCT_AS_OF = _dt.datetime(2024, 1, 30, 0, 0, 0)
INCREMENTAL_FIRST_RUN_THROUGH = _dt.date(2024, 1, 20)


def _stg_events(t: Tables) -> DataFrame:
    return staging.stg_events(b.raw_events(t))


def _stg_users(t: Tables) -> DataFrame:
    return staging.stg_users(b.raw_users(t), PRODUCT_AS_OF)


def _user_activity(t: Tables) -> DataFrame:
    return product.user_activity(_stg_events(t), _stg_users(t), PRODUCT_AS_OF)


@register("stg_events")
def q_stg_events(spark, root):
    return _stg_events(Tables(spark, root))


@register("stg_users_dedup")
def q_stg_users(spark, root):
    return _stg_users(Tables(spark, root))


@register("stg_sessions")
def q_stg_sessions(spark, root):
    return staging.stg_sessions(b.raw_sessions(Tables(spark, root)), PRODUCT_AS_OF)


@register("user_activity")
def q_user_activity(spark, root):
    return _user_activity(Tables(spark, root))


@register("user_activity_incremental")
def q_user_activity_incremental(spark, root):
    """First run on events through a cut-off day, then an incremental run
    with the 3-day lookback over the full stream, rewriting only the
    recomputed date partitions; must equal a rebuild."""
    t = Tables(spark, root)
    ev, users = _stg_events(t), _stg_users(t)
    mart = sinks.partitioned_table(spark, "mart_user_activity", ["activity_date"])
    product.refresh_user_activity(
        mart, ev.where(F.col("event_date") <= F.lit(INCREMENTAL_FIRST_RUN_THROUGH)), users,
        PRODUCT_AS_OF)
    product.refresh_user_activity(mart, ev, users, PRODUCT_AS_OF)
    return mart.read().drop("_updated_at")


@register("dau_wau_mau")
def q_dau_wau_mau(spark, root):
    return product.dau_wau_mau(_user_activity(Tables(spark, root)), PRODUCT_AS_OF)


@register("funnel")
def q_funnel(spark, root):
    t = Tables(spark, root)
    return product.funnel(_stg_events(t), _stg_users(t), PRODUCT_AS_OF)


# ── data quality (Q1-Q12) ─────────────────────────────────────────────────
DQ_AS_OF = _dt.datetime(1998, 6, 30, 6, 0, 0)
DQ_HISTORY_DAYS = 9


def _suite_runner(t: Tables, stored: bool = False):
    """The suite reads warehouse tables; with ``stored`` the bound tables are
    written once to the shared scratch space first, as a loaded warehouse
    would hold them, so repeated runs scan Parquet instead of re-deriving."""
    dims = (b.dim_patient(t), b.dim_diagnosis(t), b.dim_provider(t), b.fact_encounter(t),
            b.fact_claim(t))
    if stored:
        names = ("dim_patient", "dim_diagnosis", "dim_provider", "fact_encounter", "fact_claim")
        dims = tuple(sinks.materialize(d, n) for d, n in zip(dims, names))

    def run(run_id, at):
        return quality.run_suite(*dims, run_id=run_id, as_of=at)
    return run


def _dq_history(t: Tables) -> DataFrame:
    return quality.suite_history(_suite_runner(t, stored=True), DQ_AS_OF, DQ_HISTORY_DAYS,
                                 log_path=scratch_path(t.spark, "dq_results_log"))


@register("dq_results")
def q_dq_results(spark, root):
    run = _suite_runner(Tables(spark, root))
    return run(f"run-{DQ_AS_OF:%Y%m%d}", DQ_AS_OF).drop("check_id")


@register("dq_latest_status")
def q_dq_latest_status(spark, root):
    return quality.latest_status(_dq_history(Tables(spark, root)))


@register("dq_failure_trend")
def q_dq_failure_trend(spark, root):
    return quality.failure_trend(_dq_history(Tables(spark, root)))


@register("dq_run_status")
def q_dq_run_status(spark, root):
    run_id = f"run-{DQ_AS_OF:%Y%m%d}"
    results = _suite_runner(Tables(spark, root))(run_id, DQ_AS_OF)
    return quality.run_status_counts(results, run_id)


# ── declarative tests (G1-G8) ─────────────────────────────────────────────
FRESHNESS_AS_OF = _dt.datetime(2024, 1, 31, 3, 0, 0)


def _models(t: Tables) -> dict[str, DataFrame]:
    ev, users = _stg_events(t), _stg_users(t)
    ua = product.user_activity(ev, users, PRODUCT_AS_OF)
    return {
        "raw_events": b.raw_events(t), "raw_users": b.raw_users(t),
        "raw_sessions": b.raw_sessions(t), "raw_subscriptions": b.raw_subscriptions(t),
        "stg_events": ev, "stg_users": users,
        "stg_sessions": staging.stg_sessions(b.raw_sessions(t), PRODUCT_AS_OF),
        "user_activity": ua, "dau_wau_mau": product.dau_wau_mau(ua, PRODUCT_AS_OF),
        "funnel": product.funnel(ev, users, PRODUCT_AS_OF),
    }


@register("test_unique")
def q_test_unique(spark, root):
    return assertions.declared_unique(_models(Tables(spark, root)))


@register("test_not_null")
def q_test_not_null(spark, root):
    return assertions.declared_not_null(_models(Tables(spark, root)))


@register("test_accepted_values")
def q_test_accepted_values(spark, root):
    return assertions.declared_accepted_values(_models(Tables(spark, root)))


@register("test_accepted_range")
def q_test_accepted_range(spark, root):
    return assertions.declared_accepted_range(_models(Tables(spark, root)))


@register("test_no_future_events")
def q_test_no_future_events(spark, root):
    return assertions.no_future_events(_stg_events(Tables(spark, root)), PRODUCT_AS_OF)


@register("test_funnel_order")
def q_test_funnel_order(spark, root):
    t = Tables(spark, root)
    return assertions.funnel_order(product.funnel(_stg_events(t), _stg_users(t), PRODUCT_AS_OF))


@register("source_freshness")
def q_source_freshness(spark, root):
    t = Tables(spark, root)
    return assertions.source_freshness(
        {"events": b.raw_events(t), "users": b.raw_users(t), "sessions": b.raw_sessions(t)},
        FRESHNESS_AS_OF)


# ── loads: SCD2, claims upsert, encounter append (M8-M10, S7-S10) ────────
SCD2_OUTPUT = ["patient_id", "first_name", "last_name", "date_of_birth", "gender", "zip_code",
               "state_code", "payer_type", "effective_date", "expiration_date",
               "is_current_record", "row_hash", "updated_at"]


def _scd2(t: Tables, stats: dict | None = None) -> DataFrame:
    return loads.load_dim_patient(sc.scd2_target(t), sc.scd2_staging(t), sc.SCD2_EFFECTIVE,
                                  sc.SCD2_NOW, stats=stats)


@register("scd2_final_state")
def q_scd2_final_state(spark, root):
    return _scd2(Tables(spark, root)).select(*SCD2_OUTPUT)


@register("scd2_run_log")
def q_scd2_run_log(spark, root):
    stats: dict = {}
    _scd2(Tables(spark, root), stats)
    # Appended to the run log (S19), which is read back.
    log = scratch_path(spark, "etl_run_log")
    sinks.append_log(loads.etl_run_log_row(spark, "sp_load_dim_patient", stats, sc.SCD2_NOW), log)
    return spark.read.parquet(log)


@register("claim_merge_final_state")
def q_claim_merge_final_state(spark, root):
    t = Tables(spark, root)
    return loads.merge_claims(sc.claim_target(sc.claims(t)), sc.landed_claims(t))


@register("encounter_append_final_state")
def q_encounter_append_final_state(spark, root):
    t = Tables(spark, root)
    target = sc.encounter_target(t)
    appended = loads.append_encounters(sc.encounters_raw(t), b.dim_patient(t), b.dim_provider(t),
                                       b.dim_diagnosis(t), target, sc.ENCOUNTER_LOAD_AT)
    # Commit the new rows to the partitioned, clustered layout (S14), then
    # read the table back.
    path = scratch_path(spark, "fact_encounter")
    layout = ["admit_year", "admit_month"]
    cluster = ["encounter_type", "attending_provider_key", "primary_diagnosis_key"]
    for rows in (target, appended):
        sinks.write_clustered(rows.withColumn("admit_year", F.year("admit_date"))
                              .withColumn("admit_month", F.month("admit_date")),
                              path, layout, cluster)
    table = spark.read.parquet(path)
    return table.select(*ENCOUNTER_OUTPUT)


ENCOUNTER_OUTPUT = ["encounter_id", "patient_key", "attending_provider_key", "admit_date",
                    "discharge_date", "admit_date_key", "discharge_date_key",
                    "primary_diagnosis_key", "encounter_type", "length_of_stay_days",
                    "total_charges", "total_payments", "readmission_30d_flag", "mortality_flag"]

ENCOUNTER_VIEW_AS_OF = _dt.date(2001, 6, 30)


@register("encounters_last_365d")
def q_encounters_last_365d(spark, root):
    fe = b.fact_encounter(Tables(spark, root))
    return loads.encounters_last_n_days(fe, ENCOUNTER_VIEW_AS_OF, 365).select(
        "encounter_id", "patient_key", "admit_date", "encounter_type", "total_charges")


# ── streaming claims load (T1-T5) and JSON projection (S1-S4) ─────────────
def _claim_dims(t: Tables) -> dict[str, DataFrame]:
    """Stored, as a warehouse holds them: every batch joins them anew."""
    fe = b.fact_encounter(t).select("encounter_id", "encounter_key")
    patients = b.dim_patient(t).select("patient_id", "patient_key", "is_current_record")
    return {"dim_patient": sinks.store(patients, scratch_path(t.spark, "dim_patient")),
            "dim_provider": b.dim_provider(t), "dim_procedure": b.dim_procedure(t), "dim_diagnosis": b.dim_diagnosis(t),
            "fact_encounter": sinks.store(fe, scratch_path(t.spark, "fact_encounter"))}


@register("claims_stream_final_state")
def q_claims_stream_final_state(spark, root):
    """Target + landed batch files -> file stream -> foreachBatch merge;
    the final table must equal the batch MERGE."""
    t = Tables(spark, root)
    landing = scratch_path(spark, "claims_landing")
    sinks.land_text(sc.claim_payloads(sc.landed_claims(t), t).select("claim_json"), landing)
    dims = _claim_dims(t)
    # The fact is partitioned by service month; each micro-batch rewrites
    # only the months it touches.
    parts = ["service_year", "service_month"]
    target = sinks.partitioned_table(spark, "fact_claim", parts)
    target.create(loads.with_service_partitions(sc.stored_claims(t), parts))
    q = claims_stream.run_claims_stream(
        spark, landing, scratch_path(spark, "claims_ckpt"), target, dims,
        max_files_per_trigger=None,
        rejects_path=scratch_path(spark, "claims_rejects"),
        ledger_path=scratch_path(spark, "claims_ledger"))
    q.awaitTermination()
    return target.read().select(*sc.CLAIM_COLUMNS)


@register("claim_json_projection")
def q_claim_json_projection(spark, root):
    """All claim lines -> JSON landing payload -> VARIANT -> 16 typed columns
    (a projection: no key dedup needed)."""
    t = Tables(spark, root)
    # By claim: the table is one row group, and JSON is the work here.
    payloads = sc.claim_payloads(sc.claim_lines_with_patient(t).repartition("claim_id"), t)
    landing = payloads.select(F.parse_json("claim_json").alias("claim_json"))
    return ingest.project_claims(landing).drop("_bad_fields")


# ── calendar, keys, hashes, column values, partition pruning ──────────────
@register("date_dimension")
def q_date_dimension(spark, root):
    """S12 over the span the facts cover (first order .. last shipment)."""
    t = Tables(spark, root)
    lo = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("min_date"))
    hi = t.lineitem.agg(F.max(F.to_date("l_shipdate")).alias("max_date"))
    bounds = (lo.unionByName(hi, allowMissingColumns=True)
              .agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date")))
    return calendar.date_dimension_for(bounds)


@register("date_spine")
def q_date_spine(spark, root):
    """S13 from the first event day to the run date, however long."""
    ev = Tables(spark, root).events
    bounds = ev.agg(F.min(F.to_date("ts")).alias("start_date")).select(
        "start_date", F.lit(PRODUCT_AS_OF.date()).alias("end_date"))
    return calendar.date_spine_for(bounds, max_days=None)


@register("surrogate_key_md5")
def q_surrogate_key_md5(spark, root):
    ua = _user_activity(Tables(spark, root))
    return ua.select("user_id", "activity_date", "plan_name",
                     exprs.surrogate_key(["user_id", "activity_date", "plan_name"])
                     .alias("surrogate_key"))


@register("patient_row_hash")
def q_patient_row_hash(spark, root):
    stg = sc.scd2_staging(Tables(spark, root))
    return stg.select("patient_id", exprs.patient_row_hash(
        *[F.col(c) for c in loads.PATIENT_TRACKED]).alias("row_hash"))


COLUMN_VALUES_LIMIT = 50


@register("column_values")
def q_column_values(spark, root):
    """All distinct non-NULL plan names, sorted."""
    return (_stg_users(Tables(spark, root)).select("plan_name")
            .where(F.col("plan_name").isNotNull()).distinct()
            .orderBy("plan_name"))


@register("plan_pivot")
def q_plan_pivot(spark, root):
    """Dynamic pivot fed by A18: daily events per plan.  The value list is
    one small driver-side read (<= 50 values) that fixes the output columns."""
    t = Tables(spark, root)
    plans = [r[0] for r in q_column_values(spark, root).limit(COLUMN_VALUES_LIMIT + 1).collect()]
    if len(plans) > COLUMN_VALUES_LIMIT:
        raise ValueError(f"over {COLUMN_VALUES_LIMIT} values: the pivot would lose columns")
    ua = _user_activity(t)
    return (ua.groupBy("activity_date").pivot("plan_name", plans)
            .agg(F.sum("total_events")))


CLAIM_YEAR = 1998


@register("claims_by_year_pruned")
def q_claims_by_year_pruned(spark, root):
    """Claims stored partitioned by service year; a year predicate is
    a partition filter, so only that year's directory is listed and read."""
    path = scratch_path(spark, "fact_claim_by_year")
    c = b.fact_claim(Tables(spark, root)).withColumn("service_year", F.year("service_date"))
    sinks.write_clustered(c, path, ["service_year"], ["claim_status", "service_date"],
                          mode="errorifexists")
    stored = spark.read.parquet(path)
    return (stored.where(F.col("service_year") == CLAIM_YEAR)
            .select("claim_id", "claim_line_number", "service_date", "billed_amount",
                    "paid_amount", "claim_status", "service_year"))


# ── README-documented capabilities (X1-X13) ──────────────────────────────
@register("encounter_journey")
def q_encounter_journey(spark, root):
    return population.encounter_journey(b.fact_encounter(Tables(spark, root)))


@register("lace_scores")
def q_lace_scores(spark, root):
    t = Tables(spark, root)
    return population.lace_scores(b.fact_encounter(t), b.bridge_encounter_diagnosis(t),
                                  b.dim_diagnosis(t))


CENSUS_AS_OF = _dt.date(2001, 12, 31)


@register("encounter_sequence")
def q_encounter_sequence(spark, root):
    return population.encounter_sequence(b.fact_encounter(Tables(spark, root)))


@register("facility_census")
def q_facility_census(spark, root):
    t = Tables(spark, root)
    # Every fiftieth stay is still open.
    stays = b.fact_encounter(t).withColumn("discharge_date", F.when(F.col("encounter_key") % 50 != 0,
                                                                    F.col("discharge_date")))
    return population.facility_census(stays, b.dim_provider(t), CENSUS_AS_OF)


@register("provider_charge_rank")
def q_provider_charge_rank(spark, root):
    t = Tables(spark, root)
    return population.provider_charge_rank(b.fact_encounter(t), b.dim_provider(t))


@register("cohort_retention")
def q_cohort_retention(spark, root):
    return product.cohort_retention(_user_activity(Tables(spark, root)))


@register("cohort_retention_monthly")
def q_cohort_retention_monthly(spark, root):
    return product.cohort_retention_monthly(_user_activity(Tables(spark, root)))


@register("time_to_convert")
def q_time_to_convert(spark, root):
    t = Tables(spark, root)
    return product.time_to_convert(product.funnel(_stg_events(t), _stg_users(t), PRODUCT_AS_OF))


@register("dau_rolling_avg")
def q_dau_rolling_avg(spark, root):
    ua = _user_activity(Tables(spark, root))
    return product.dau_rolling_avg(product.dau_wau_mau(ua, PRODUCT_AS_OF))


@register("approx_activity_stats")
def q_approx_activity_stats(spark, root):
    return product.approx_activity_stats(_user_activity(Tables(spark, root)))


# ── approximate answers with their error (A22, A6, X9) ─────────────────────
QUANTILE_SHARES = (0.01, 0.25, 0.5, 0.75, 0.9, 0.99)


@register("value_quantile_sketches")
def q_value_quantile_sketches(spark, root):
    """Stored daily sketches of event values, merged for the whole period and
    for its second half: is each quantile's rank within the sketch's error?"""
    ev = Tables(spark, root).events.select("event_type", F.to_date("ts").alias("day"), "value").where("day IS NOT NULL")
    daily = sinks.materialize(quantiles.daily_sketches(ev, ["event_type"], "day", "value"), "daily_sketches")
    out = None
    for name, where in (("all", F.lit(True)), ("late", F.dayofmonth("day") > 15)):
        found = quantiles.quantiles(quantiles.period_sketches(daily.where(where), ["event_type"]), ["event_type"], QUANTILE_SHARES)
        checked = quantiles.rank_bounds(ev.where(where), found, ["event_type"], "value")
        error = quantiles.rank_error()
        rows = checked.select(F.lit(name).alias("period"), "event_type", "share", "n",
                              ((F.col("share_below") <= F.col("share") + error)
                               & (F.col("share_upto") >= F.col("share") - error)).alias("within_error"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("rolling_distinct_error")
def q_rolling_distinct_error(spark, root):
    """Sketched weekly and monthly users against the exact ones, per day, plan
    and country: is the error within 5 % or two users?"""
    from tessera.operators.rolling import rolling_distinct_approx
    ua = _user_activity(Tables(spark, root))
    keys = ["activity_date", "plan_name", "country_code"]
    approx = rolling_distinct_approx(ua, "activity_date", keys[1:], "user_id", {"wau_approx": 7, "mau_approx": 28})
    exact = product.dau_wau_mau(ua, PRODUCT_AS_OF).select(*keys, "wau", "mau")

    def close(a: str, e: str):
        return F.abs(F.col(a) - F.col(e)) <= F.greatest(0.05 * F.col(e), F.lit(2.0))

    both = exact.where("plan_name IS NOT NULL AND country_code IS NOT NULL").join(approx, keys)
    return both.select(*keys, "wau", "mau", close("wau_approx", "wau").alias("wau_close"), close("mau_approx", "mau").alias("mau_close"))


# ── nested claims (X9) ──────────────────────────────────────────────────────
def _nested_claims(spark, root):
    path = scratch_path(spark, "nested_claims")
    nested_claims.store(b.fact_claim(Tables(spark, root)), path)
    return nested_claims.read(spark, path)


@register("nested_claim_totals")
def q_nested_claim_totals(spark, root):
    return nested_claims.claim_totals(_nested_claims(spark, root))


@register("nested_status_mix")
def q_nested_status_mix(spark, root):
    return nested_claims.status_mix(_nested_claims(spark, root))


VAULT_LOAD_1 = _dt.date(2023, 12, 31)
VAULT_LOAD_2 = _dt.date(2024, 1, 1)
VAULT_ATTRS = ["first_name", "last_name", "date_of_birth", "gender", "zip_code", "state_code",
               "payer_type"]


def _vault(t: Tables):
    first = sc.scd2_target(t)
    second = sc.scd2_staging(t)
    hub1 = vault.load_hub(None, first, "patient_id", "hk_patient", VAULT_LOAD_1, "crm")
    sat1 = vault.load_satellite(None, first, "patient_id", "hk_patient", VAULT_ATTRS,
                                VAULT_LOAD_1, "crm")
    hub2 = vault.load_hub(hub1, second, "patient_id", "hk_patient", VAULT_LOAD_2, "crm")
    sat2 = vault.load_satellite(sat1, second, "patient_id", "hk_patient", VAULT_ATTRS,
                                VAULT_LOAD_2, "crm")
    return hub1.unionByName(hub2), sat1.unionByName(sat2)


@register("vault_satellite")
def q_vault_satellite(spark, root):
    hub, sat = _vault(Tables(spark, root))
    return sat.select("hk_patient", "load_date", "hash_diff", "payer_type")


@register("vault_pit")
def q_vault_pit(spark, root):
    hub, sat = _vault(Tables(spark, root))
    return vault.point_in_time(sat, "hk_patient", VAULT_LOAD_1, VAULT_LOAD_2 + _dt.timedelta(days=1))


# Three extracts; demographics and coverage arrive in satellites of their own.
VAULT_LOADS = (_dt.date(2023, 12, 29), _dt.date(2024, 1, 1), _dt.date(2024, 1, 3))
VAULT_SATELLITES = {"demographics": ["first_name", "last_name", "gender", "zip_code"], "coverage": ["payer_type", "state_code"]}


def _vault_extracts(t: Tables) -> list[DataFrame]:
    """The first: patients known, coverage missing for every fourth; the
    second: all, every third moved; the third: every fifth changed payer."""
    people = b.patient_attributes(t.customer)
    k = F.col("patient_key")
    known = people.join(sc.scd2_target(t).select("patient_key"), "patient_key", "left_semi")
    moved = people.withColumn("zip_code", F.when(k % 3 == 0, F.lit("00000")).otherwise(F.col("zip_code")))
    paid = moved.withColumn("payer_type", F.when(k % 5 == 0, F.lit("SELF")).otherwise(F.col("payer_type")))
    return [known, moved, paid]


def _patient_vault(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Hub and satellites after the three loads, each load written before the next."""
    hub, sats = None, dict.fromkeys(VAULT_SATELLITES)
    for n, (day, rows) in enumerate(zip(VAULT_LOADS, _vault_extracts(t))):
        new = vault.load_hub(hub, rows, "patient_id", "hk_patient", day, "crm")
        hub = sinks.materialize(new if hub is None else hub.unionByName(new), "vault_hub")
        for name, attributes in VAULT_SATELLITES.items():
            part = rows.where(F.col("patient_key") % 4 != 0) if (n, name) == (0, "coverage") else rows
            new = vault.load_satellite(sats[name], part, "patient_id", "hk_patient", attributes, day, "crm")
            sats[name] = sinks.materialize(new if sats[name] is None else sats[name].unionByName(new), f"vault_{name}")
    return hub, sats


@register("vault_pit_satellites")
def q_vault_pit_satellites(spark, root):
    """Daily snapshots over both satellites of the patient hub, with an
    attribute of each as it was."""
    hub, sats = _patient_vault(Tables(spark, root))
    pit = vault.point_in_time_all(sats, "hk_patient", VAULT_LOADS[0] - _dt.timedelta(days=1), VAULT_LOADS[-1] + _dt.timedelta(days=1))
    out = vault.as_of_snapshot(pit, {"demographics": (sats["demographics"], ["zip_code"]),
                                     "coverage": (sats["coverage"], ["payer_type"])}, "hk_patient")
    return out.join(hub.select("hk_patient", "patient_id"), "hk_patient").drop("hk_patient")


@register("vault_link")
def q_vault_link(spark, root):
    """Patient-provider link in two loads (encounters before a date, then all)
    with an effectivity satellite: last seen, rows only where it changed."""
    t = Tables(spark, root)
    fe = b.fact_encounter(t).select(
        F.concat(F.lit("P"), F.col("patient_key").cast("string")).alias("patient_id"),
        b.npi_for(F.col("attending_provider_key")).alias("npi"), "admit_date")
    link = sat = None
    for day in (_dt.date(2000, 1, 1), _dt.date(2002, 1, 1)):
        seen = sinks.materialize(fe.where(F.col("admit_date") < F.lit(day)).groupBy("patient_id", "npi")
                                 .agg(F.max("admit_date").alias("last_seen")), "vault_seen")
        new = vault.load_link(link, seen, ["patient_id", "npi"], "hk_link", day, "emr")
        link = sinks.materialize(new if link is None else link.unionByName(new), "vault_link")
        new = vault.load_satellite(sat, seen, ["patient_id", "npi"], "hk_link", ["last_seen"], day, "emr")
        sat = sinks.materialize(new if sat is None else sat.unionByName(new), "vault_link_sat")
    return link.select("hk_link", "hk_patient_id", "hk_npi", F.col("load_date").alias("linked_on")).join(
        sat.select("hk_link", F.col("load_date").alias("sat_load_date"), "last_seen"), "hk_link")


@register("events_continuous_agg")
def q_events_continuous_agg(spark, root):
    """Streaming aggregate over the event files, added up per micro-batch."""
    partials = scratch_path(spark, "event_counts")
    q = agg_stream.run_event_counts(spark, root, scratch_path(spark, "event_counts_ckpt"), partials,
                                    file_glob="events.parquet")
    q.awaitTermination()
    return agg_stream.read_event_counts(spark, partials)


@register("events_late_files")
def q_events_late_files(spark, root):
    """The events land in three parts, the earliest days last and events
    without a time with them; the stream drains each part as it lands."""
    ev = Tables(spark, root).events
    landing = scratch_path(spark, "event_landing")
    day = F.dayofmonth("ts")
    partials, ckpt = scratch_path(spark, "event_counts"), scratch_path(spark, "event_counts_ckpt")
    for part in (day.between(11, 20), day > 20, (day < 11) | F.col("ts").isNull()):
        ev.where(part).write.mode("append").parquet(landing)
        agg_stream.run_event_counts(spark, landing, ckpt, partials, fold_every=2).awaitTermination()
    return agg_stream.read_event_counts(spark, partials)


# ── incremental models (S21) ────────────────────────────────────────────────
FIRST_RUN_UPTO = _dt.date(2024, 1, 15)


def _activity_model(t: Tables, upto=None, without=()):
    ev, users = _stg_events(t), _stg_users(t)
    if upto is not None:
        ev = ev.where(F.col("event_date") <= F.lit(upto))
    return lambda since: product.user_activity(ev, users, PRODUCT_AS_OF, None if since is None else F.lit(since)).drop(*without)


def _dau_model(activity: DataFrame):
    """Days from the start on, from the activity of the 28 days that they look back on."""
    def model(since):
        if since is None:
            return product.dau_wau_mau(activity, PRODUCT_AS_OF)
        seen = activity.where(F.col("activity_date") > F.lit(since - _dt.timedelta(days=28)))
        return product.dau_wau_mau(seen, PRODUCT_AS_OF).where(F.col("activity_date") >= F.lit(since))
    return model


@register("incremental_activity_model")
def q_incremental_activity_model(spark, root):
    """Two runs into a table partitioned by day; the second brings a column
    that older days then have as null."""
    t = Tables(spark, root)
    table = sinks.partitioned_table(spark, "mart_activity", ["activity_date"])
    spec = incremental.Incremental(ACTIVITY_KEYS, "activity_date", _dt.timedelta(days=3), on_schema_change="append_new_columns")
    incremental.refresh(table, _activity_model(t, FIRST_RUN_UPTO, ["engagement_tier"]), spec)
    incremental.refresh(table, _activity_model(t), spec)
    return table.read().drop("_updated_at")


@register("incremental_dau_model")
def q_incremental_dau_model(spark, root):
    """Two runs into a versioned table, the window replaced; groups without a
    plan or country are kept once."""
    t = Tables(spark, root)
    table = sinks.versioned_table(spark, "mart_dau")
    spec = incremental.Incremental(["activity_date", "plan_name", "country_code"], "activity_date", _dt.timedelta(days=3))
    for upto in (FIRST_RUN_UPTO, None):
        activity = sinks.materialize(_activity_model(t, upto)(None), "activity")
        incremental.refresh(table, _dau_model(activity), spec)
    return table.read().drop("_updated_at")


# ── calendar roles, time zones, report order, keys and macros ───────────────
@register("encounter_calendar")
def q_encounter_calendar(spark, root):
    """The date dimension in two roles, admission and discharge."""
    t = Tables(spark, root)
    fe = b.fact_encounter(t)
    days = fe.agg(F.least(F.min("admit_date"), F.min("discharge_date")).alias("min_date"),
                  F.greatest(F.max("admit_date"), F.max("discharge_date")).alias("max_date"))
    dates = sinks.materialize(calendar.date_dimension_for(days), "dim_date")
    return clinical.by_calendar(fe, dates)


SOURCE_ZONE = "America/New_York"


@register("events_to_utc")
def q_events_to_utc(spark, root):
    """SC10: wall-clock times of a zone with daylight saving, in UTC (spread
    over a year, the hours of both changes among them)."""
    ev = Tables(spark, root).events.where("ts IS NOT NULL")
    local = F.timestamp_add("HOUR", (F.col("event_id") * 7 % 8784).cast("int"), F.col("ts"))
    return ev.select("event_id", local.alias("local_ts")).withColumn("utc_ts", exprs.to_utc("local_ts", SOURCE_ZONE))


@register("report_heads")
def q_report_heads(spark, root):
    """O1: the first rows of both patient reports in their stated order, with
    their place in it."""
    t = Tables(spark, root)
    fe = b.fact_encounter(t)
    out = None
    for name, rows, order in (
            ("readmissions", clinical.readmission_30d(fe), clinical.READMISSION_ORDER),
            ("progression", clinical.chronic_progression(fe, b.bridge_encounter_diagnosis(t), b.dim_diagnosis(t)),
             clinical.PROGRESSION_ORDER)):
        # Equal rows in the order's columns are ordered by the others shown.
        head = clinical.in_order(rows, order).limit(200)
        part = head.groupBy().agg(F.collect_list(F.struct(*order)).alias("rows")).select(F.posexplode("rows").alias("place", "row"))
        shown = [F.col(f"row.{c}").cast("string").alias(k) for k, c in zip(("a", "b", "c"), [*order, *order][:3])]
        part = part.select(F.lit(name).alias("report"), "place", *shown)
        out = part if out is None else out.unionByName(part)
    return out


@register("fingerprint_keys")
def q_fingerprint_keys(spark, root):
    """S24 / SC8, SC9: keys by fingerprint are unique and the same on every
    run, run ids are unique and of the right form (values differ by engine)."""
    ids = b.fact_encounter(Tables(spark, root)).select("encounter_id")
    keyed = ids.select("encounter_id", exprs.fingerprint_key("encounter_id").alias("k"), F.expr("uuid()").alias("u"))
    again = ids.select(F.col("encounter_id").alias("other"), exprs.fingerprint_key("encounter_id").alias("k2"))
    x = keyed.join(again, F.col("encounter_id") == F.col("other"))
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return x.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("k").alias("n_keys"), F.countDistinct("u").alias("n_ids"),
                 F.bool_and(F.col("k") == F.col("k2")).alias("same_again"), F.bool_and(F.col("u").rlike(form)).alias("well_formed"))


@register("macro_values")
def q_macro_values(spark, root):
    """P14, P15, SC25, UD7: both divisions and cents to dollars, per line."""
    li = Tables(spark, root).lineitem
    tax, off = (F.col(c).cast("decimal(4,2)") * 100 for c in ("l_tax", "l_discount"))
    cents = (F.col("l_extendedprice").cast("decimal(14,2)") * 100).cast("long")
    x = li.select("l_orderkey", "l_linenumber", "l_shipdate", tax.cast("int").alias("tax"), off.cast("int").alias("off"), cents.alias("cents"))
    return x.select("l_orderkey", "l_linenumber", "cents", F.round(exprs.safe_divide("tax", "off"), 6).alias("zero_if_zero"),
                    F.round(exprs.null_divide("tax", "off"), 6).alias("null_if_zero"),
                    exprs.cents_to_dollars("cents").cast("decimal(18,2)").alias("dollars"),
                    exprs.cents_to_dollars("cents", 1).cast("decimal(18,1)").alias("tens_of_cents"))


@register("schema_synced_claims")
def q_schema_synced_claims(spark, root):
    """The stored table has a column that the batch lost, the batch one
    that the table lacks."""
    c = sc.claims(Tables(spark, root)).select("claim_id", "claim_line_number", "claim_status", "paid_amount", "service_date")
    target = c.where(F.col("service_date") < F.lit(sc.CLAIM_TARGET_BEFORE)).drop("service_date").withColumn("legacy", F.lit("x"))
    batch = (c.where(F.col("service_date") >= F.lit(sc.CLAIM_BATCH_FROM)).drop("service_date")
             .withColumn("channel", F.lit("web")))
    return merge.upsert(target, batch, ["claim_id", "claim_line_number"], allow_schema_sync=True)


@register("claims_array_landing")
def q_claims_array_landing(spark, root):
    """SC36: every landed line is an array of a claim's lines."""
    t = Tables(spark, root)
    rows = sc.claim_payloads(sc.landed_claims(t), t)
    claim = F.get_json_object("claim_json", "$.claim_id")
    arrays = rows.groupBy(claim.alias("c")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("claim_json")), F.lit("]")).alias("value"))
    path = scratch_path(spark, "array_landing")
    sinks.land_text(arrays.select("value"), path)
    landing, _ = ingest.read_stage(spark, path)
    return ingest.project_claims(landing).where("_bad_fields = 0").select("claim_id", "claim_line_number", "paid_amount", "claim_status")


@register("dq_logged_check")
def q_dq_logged_check(spark, root):
    """UD4: a check that was computed elsewhere, logged as a result row."""
    n, bad = Tables(spark, root).lineitem.agg(F.count(F.lit(1)), F.count_if(F.col("l_discount") > 0.09)).first()
    return quality.log_row(spark, "run-x", "discount_cap", "validity", "edw.fact_claim", "discount", n, bad, 15.0, None,
                           DQ_AS_OF).drop("check_id")


# ── message bundles (X11) ───────────────────────────────────────────────────
def _bundles(spark, root) -> fhir.Bundles:
    """Bundles landed as text files, read with their file name."""
    landing = scratch_path(spark, "bundle_landing")
    sinks.land_text(sc.bundle_lines(Tables(spark, root)), landing)
    lines = spark.read.text(landing).select("value", F.col("_metadata.file_name").alias("file_name"))
    return fhir.Bundles.load(lines)


@register("fhir_patients")
def q_fhir_patients(spark, root):
    return fhir.patients(_bundles(spark, root))


@register("fhir_encounters")
def q_fhir_encounters(spark, root):
    return _bundles(spark, root).table("Encounter")


@register("fhir_claims")
def q_fhir_claims(spark, root):
    return _bundles(spark, root).table("Claim")


@register("fhir_claim_lines")
def q_fhir_claim_lines(spark, root):
    return _bundles(spark, root).claim_lines().drop("item_pos")


@register("fhir_rejects")
def q_fhir_rejects(spark, root):
    """Rejected entries with their place in the bundle, rejected claim lines
    with their claim."""
    found = _bundles(spark, root)
    entries = found.rejects().select("bundle_id", "pos", F.lit(None).cast("string").alias("claim_id"), "reason")
    return entries.unionByName(found.rejected_lines().select("bundle_id", F.lit(None).cast("int").alias("pos"), "claim_id", "reason"))


# ── claims load run (M16) ───────────────────────────────────────────────────
PIPELINE_RUN_AT = _dt.datetime(1999, 1, 2, 2, 0, 0)


@register("claims_run_ledger")
def q_claims_run_ledger(spark, root):
    """Land the claim batch, run stage -> merge -> quality gate, return the
    run's ledger row (wall-clock columns left out)."""
    t = Tables(spark, root)
    landing = scratch_path(spark, "pipeline_landing")
    sinks.land_text(sc.claim_payloads(sc.landed_claims(t), t).select("claim_json"), landing)
    dims = _claim_dims(t)
    fact = sinks.versioned_table(spark, "fact_claim")
    fact.commit(sc.stored_claims(t))
    run_id = f"claims-{PIPELINE_RUN_AT:%Y%m%d}"
    ledger = load_runs.run_claims_load(
        spark, landing, fact, dims, run_id, PIPELINE_RUN_AT,
        results_path=scratch_path(spark, "dq_results"),
        ledger_path=scratch_path(spark, "pipeline_runs"))
    return ledger.drop("started_at", "finished_at", "duration_sec")


@register("claims_run_rejects")
def q_claims_run_rejects(spark, root):
    """A landing in which fourth lines are cut off, fifth lines have a text
    for an amount, sixth lines are arrays of numbers, and every seventh
    provider has no dimension row: rejects per reason and what was merged
    into an empty table."""
    t = Tables(spark, root)
    landing = scratch_path(spark, "pipeline_landing")
    rows = sc.claim_payloads(sc.landed_claims(t), t)
    line = F.get_json_object("claim_json", "$.claim_line_number").cast("int")
    text = (F.when(line == 4, F.substring("claim_json", 1, 30))
            .when(line == 5, F.regexp_replace("claim_json", '"billed_amount":[0-9.]+', '"billed_amount":"n/a"'))
            .when(line == 6, F.lit("[1, 2]")).otherwise(F.col("claim_json")))
    sinks.land_text(rows.select(text.alias("value")), landing)
    dims = {"dim_patient": b.dim_patient(t),
            "dim_provider": b.dim_provider(t).where(F.col("provider_key") % 7 != 0),
            "dim_procedure": b.dim_procedure(t), "dim_diagnosis": b.dim_diagnosis(t),
            "fact_encounter": b.fact_encounter(t)}
    fact, path = sinks.versioned_table(spark, "fact_claim"), scratch_path(spark, "claims_rejects")
    load_runs.run_claims_load(spark, landing, fact, dims, "run", PIPELINE_RUN_AT, rejects_path=path)
    merged = fact.read().select(F.lit("merged").alias("reason"))
    return (spark.read.parquet(path).select("reason").unionByName(merged)
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def _encounter_runs(spark, root):
    """Two runs over one fact and patient dimension: every tenth landed stay
    ends before it begins, so the first is stopped by its checks; the second
    lands the corrected rows.  Ledgers, and the state after each run."""
    t = Tables(spark, root)
    fact, dim, rejects = (sinks.versioned_table(spark, n) for n in ("fact_encounter", "dim_patient", "encounter_rejects"))
    dim.commit(sc.scd2_target(t))
    fact.commit(sc.sound_encounters(sc.encounter_target(t)).join(dim.read().select("patient_key"), "patient_key", "left_semi"))
    raw = sinks.materialize(sc.sound_encounters(sc.encounters_raw(t)), "encounters_raw")
    tenth = F.substring("encounter_id", 2, 20).cast("long") % 10 == 0
    flawed = raw.withColumn("discharge_date", F.when(tenth, F.date_sub("admit_date", 1)).otherwise(F.col("discharge_date")))
    dims = {"dim_provider": b.dim_provider(t), "dim_diagnosis": b.dim_diagnosis(t)}
    ledgers, states = None, None
    for n, rows in enumerate((flawed, raw)):
        landing = scratch_path(spark, "encounter_landing")
        sinks.land_text(sc.encounter_lines(rows), landing)
        ledger = load_runs.run_encounters_load(spark, landing, sc.scd2_staging(t), fact, dim, dims, f"encounters-{n}",
                                               sc.ENCOUNTER_RUN_AT, rejects, scratch_path(spark, "dq_results"))
        ledgers = ledger if ledgers is None else ledgers.unionByName(ledger)
        for name, table in (("fact_encounter", fact), ("dim_patient", dim), ("encounter_rejects", rejects)):
            rows_now = table.read()
            if rows_now is not None:
                state = rows_now.agg(F.lit(n).alias("run"), F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
                states = state if states is None else states.unionByName(state)
    return ledgers, states


@register("encounters_run_ledger")
def q_encounters_run_ledger(spark, root):
    return _encounter_runs(spark, root)[0].drop("started_at", "finished_at", "duration_sec")


@register("encounters_run_tables")
def q_encounters_run_tables(spark, root):
    """Rows of the published tables after each run."""
    return _encounter_runs(spark, root)[1]


def _encounter_dims(t, providers=None):
    return {"dim_patient": b.dim_patient(t), "dim_provider": b.dim_provider(t) if providers is None else providers,
            "dim_diagnosis": b.dim_diagnosis(t)}


@register("encounter_append_watermarked")
def q_encounter_append_watermarked(spark, root):
    """Three runs of the watermark-driven load: the first takes all that is
    there (rows older than a day included), the second what was extracted
    since, the third nothing."""
    t = Tables(spark, root)
    dims, raw = _encounter_dims(t), sc.encounters_raw(t)
    fact = sinks.versioned_table(spark, "fact_encounter")
    fact.commit(sc.encounter_target(t))
    mark = sinks.versioned_table(spark, "encounter_watermark")
    at = sc.ENCOUNTER_LOAD_AT - _dt.timedelta(hours=12)
    early = raw.where(F.col("extracted_at") <= exprs.ts_lit(at))
    loads.watermarked_encounter_load(early, dims, fact, mark, at)
    loads.watermarked_encounter_load(raw, dims, fact, mark, sc.ENCOUNTER_LOAD_AT)
    loads.watermarked_encounter_load(raw, dims, fact, mark, sc.ENCOUNTER_LOAD_AT + _dt.timedelta(days=1))
    return fact.read().select(*ENCOUNTER_OUTPUT)


@register("encounter_rejects")
def q_encounter_rejects(spark, root):
    """Every fifth provider has no current dimension row: their encounters go
    to the rejects of the watermarked load, with the lookup that failed."""
    t = Tables(spark, root)
    known = b.dim_provider(t).where(F.col("provider_key") % 5 != 0)
    fact = sinks.versioned_table(spark, "fact_encounter")
    fact.commit(sc.encounter_target(t))
    rejects = sinks.versioned_table(spark, "encounter_rejects")
    loads.watermarked_encounter_load(sc.encounters_raw(t), _encounter_dims(t, known), fact,
                                     sinks.versioned_table(spark, "encounter_watermark"),
                                     sc.ENCOUNTER_LOAD_AT, rejects=rejects)
    return rejects.read().select("encounter_id", "attending_npi", "missing_dimension")


def _watermarked_runs(spark, t, runs):
    """(raw rows, dimensions, time) per run -> the fact and the rejects."""
    fact, rejects, mark = (sinks.versioned_table(spark, n) for n in ("fact_encounter", "encounter_rejects",
                                                                     "encounter_watermark"))
    fact.commit(sc.encounter_target(t))
    for raw, dims, at in runs:
        loads.watermarked_encounter_load(raw, dims, fact, mark, at, rejects=rejects)
    return fact.read(), rejects.read()


@register("encounter_equal_extract_times")
def q_encounter_equal_extract_times(spark, root):
    """All rows carry one extract time and arrive in two runs, odd keys last."""
    t = Tables(spark, root)
    raw = sc.encounters_raw(t).withColumn("extracted_at", exprs.ts_lit(sc.ENCOUNTER_LOAD_AT))
    even = F.substring("encounter_id", 2, 20).cast("long") % 2 == 0
    dims, at = _encounter_dims(t), sc.ENCOUNTER_LOAD_AT
    fact, _ = _watermarked_runs(spark, t, [(raw.where(even), dims, at), (raw, dims, at + _dt.timedelta(hours=1))])
    return fact.select(*ENCOUNTER_OUTPUT, "created_at")


@register("encounter_reject_replay")
def q_encounter_reject_replay(spark, root):
    """Every fifth provider's dimension row arrives after the first run, every
    seventh's never: three runs, and what the reject store still holds."""
    t = Tables(spark, root)
    raw, at, hour = sc.encounters_raw(t), sc.ENCOUNTER_LOAD_AT, _dt.timedelta(hours=1)
    some = b.dim_provider(t).where(F.col("provider_key") % 7 != 0)
    fewer = some.where(F.col("provider_key") % 5 != 0)
    none = raw.limit(0)
    fact, rejects = _watermarked_runs(spark, t, [(raw, _encounter_dims(t, fewer), at), (none, _encounter_dims(t, fewer), at + hour),
                                                 (none, _encounter_dims(t, some), at + 2 * hour)])
    loaded = fact.where(F.col("admit_date") >= F.lit(sc.ENCOUNTER_RAW_FROM)).select(
        "encounter_id", F.lit("loaded").alias("state"), F.col("created_at").alias("at"), F.lit(0).alias("runs"))
    return loaded.unionByName(rejects.select("encounter_id", F.lit("waiting").alias("state"),
                                             F.col("first_rejected_at").alias("at"), "runs"))


# ── partition-scoped claims merge (S7, S23, T4, T5) ───────────────────────
SERVICE_PARTS = ["service_year", "service_month"]


def _claims_by_month(spark, rows, numbered=True):
    table = sinks.partitioned_table(spark, "fact_claim", SERVICE_PARTS)
    rows = loads.with_service_partitions(rows, SERVICE_PARTS)
    keyed = scratch_path(spark, "keyed")
    table.create(merge.assign_keys(rows, "claim_line_key", path=keyed) if numbered else rows)
    sinks.discard(spark, keyed)
    return table


@register("claims_partition_moves")
def q_claims_partition_moves(spark, root):
    """A batch whose first lines name a later month than the stored line and
    whose third lines have no service date: each key stays one row, the null
    partition keeps its rows over two merges."""
    t = Tables(spark, root)
    table = _claims_by_month(spark, sc.claim_target(sc.claims(t)))
    line = F.col("claim_line_number")
    batch = sc.landed_claims(t).withColumn("service_date", F.when(line == 1, F.date_add("service_date", 20))
                                         .when(line != 3, F.col("service_date")))
    batch = sinks.materialize(batch, "claim_batch_moved")
    loads.merge_claims_partitions(table, batch.where(line % 2 == 1))
    loads.merge_claims_partitions(table, batch)
    return table.read().select(*sc.CLAIM_COLUMNS)


@register("claims_first_load")
def q_claims_first_load(spark, root):
    """First load into an empty table, every line twice: the later version
    stays, lines are numbered 1 to n, no load column is left."""
    batch = sinks.materialize(sc.landed_claims(Tables(spark, root)), "claim_batch")
    batch = batch.withColumn("loaded_at", exprs.ts_lit(sc.ENCOUNTER_LOAD_AT))
    later = batch.withColumn("loaded_at", F.col("loaded_at") + F.expr("INTERVAL 1 HOUR")).withColumn(
        "billed_amount", (F.col("billed_amount") + 1).cast("decimal(14,2)"))
    table = sinks.partitioned_table(spark, "fact_claim", SERVICE_PARTS)
    loads.merge_claims_partitions(table, batch.unionByName(later))
    rows = table.read()
    n = rows.agg(F.countDistinct("claim_line_key").alias("n_keys"), F.min("claim_line_key").alias("low_key"),
                 F.max("claim_line_key").alias("high_key"))
    return rows.drop("claim_line_key", *SERVICE_PARTS).join(F.broadcast(n), F.lit(True))  # one row


@register("claims_stream_batches")
def q_claims_stream_batches(spark, root):
    """Three landings, the stream drains each: the batch, late adjustments of
    its second lines, later ones of its first lines."""
    t = Tables(spark, root)
    landing = scratch_path(spark, "claims_landing")
    batch = sinks.store(sc.landed_claims(t), scratch_path(spark, "claim_batch"))
    dims, ckpt = _claim_dims(t), scratch_path(spark, "claims_ckpt")
    target = _claims_by_month(spark, sc.stored_claims(t))
    for step in sc.claim_adjustments(batch):
        sinks.land_text(sc.claim_payloads(step, t).select("claim_json"), landing, "append")
        claims_stream.run_claims_stream(spark, landing, ckpt, target, dims).awaitTermination()
    return target.read().select(*sc.CLAIM_COLUMNS)


@register("user_activity_stream")
def q_user_activity_stream(spark, root):
    """Event files -> stream -> per batch: history append, touched dates
    recomputed, merged into the date-partitioned mart (T6, S16)."""
    t = Tables(spark, root)
    mart = sinks.partitioned_table(spark, "mart_user_activity", ["activity_date"])
    q = activity_stream.run_activity_stream(
        spark, root, "events.parquet", scratch_path(spark, "activity_ckpt"),
        scratch_path(spark, "stg_events_history"), mart, _stg_users(t), PRODUCT_AS_OF,
        b.raw_events_from)
    q.awaitTermination()
    return mart.read()


@register("encounter_readmit_flag")
def q_encounter_readmit_flag(spark, root):
    fe = b.fact_encounter(Tables(spark, root))
    return (clinical.with_readmit_flag(fe, clinical.readmission_30d(fe))
            .select("encounter_id", "encounter_type", "admit_date", "is_30day_readmit"))


@register("facility_dimension")
def q_facility_dimension(spark, root):
    from tessera.operators.merge import assign_keys
    dim = clinical.facility_dimension(b.dim_provider(Tables(spark, root)))
    keyed = assign_keys(dim, "facility_key")
    # Keys are dense and unique but their order follows partitioning, so the
    # compared output carries the key range instead of individual keys (the
    # window runs over the facility dimension: one row per facility).
    return keyed.select("facility_name", "facility_type", "address_city", "address_state",
                        "provider_count",
                        (F.count("*").over(Window.partitionBy()) ==
                         F.max("facility_key").over(Window.partitionBy())).alias("keys_dense"))


@register("dau_wau_mau_approx")
def q_dau_wau_mau_approx(spark, root):
    """HLL-sketch WAU/MAU per plan and country (approximate: no oracle)."""
    from tessera.operators.rolling import rolling_distinct_approx
    ua = _user_activity(Tables(spark, root))
    return rolling_distinct_approx(ua, "activity_date", ["plan_name", "country_code"], "user_id",
                                   {"wau_approx": 7, "mau_approx": 28})
