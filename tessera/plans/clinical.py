"""Clinical analytics jobs (M1-M7): window and aggregate reports over the
encounter / claim star schema.

Every job is a pure function DataFrame(s) -> DataFrame with explicit
parameters (year, thresholds) instead of the source's CURRENT_DATE.

Scale notes
* Facts are pre-aggregated before they meet a dimension wherever the report
  is at dimension grain (M2, M5, M7): the join then runs on one row per
  provider, which AQE broadcasts from runtime statistics.
* Windows partition by patient or (patient, code); a window partition is one
  patient's history.  Specialty-level windows (M2) run after aggregation, on
  one row per provider.
* NULL ordering and tie-breaks are explicit, so results are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import avg_dec_round, avg_int_round, pct
from tessera.operators.ranking import ranked
from tessera.operators.sequence import neighbors
from tessera.operators.sinks import materialize


def _year_bounds(year: int):
    return F.lit(_dt.date(year, 1, 1)), F.lit(_dt.date(year, 12, 31))


def _round_double(c, scale: int = 4):
    return F.round(c.cast("double"), scale)


# ── M1: 30-day readmission ────────────────────────────────────────────────
def readmission_30d(fact_encounter: DataFrame) -> DataFrame:
    """Flag each inpatient stay followed by another inpatient admission of
    the same patient within 30 days of discharge (flag sits on the index
    stay).  Ties on admit date are broken by encounter_id.  Stays without an
    admit or discharge date have no row in the date dimension that both dates
    join to, so they leave before the next admission is looked up (J1)."""
    ip = (fact_encounter.where((F.col("encounter_type") == "IP") & F.col("admit_date").isNotNull()
                               & F.col("discharge_date").isNotNull())
          .select("encounter_id", "patient_key", "admit_date", "discharge_date",
                  "encounter_type"))
    nxt = neighbors(ip, "patient_key", ["admit_date", "encounter_id"],
                    ["admit_date", "encounter_type"])
    days = F.datediff(F.col("next_admit_date"), F.col("discharge_date"))
    flag = (F.col("next_admit_date").isNotNull()
            & (F.col("next_encounter_type") == "IP") & (days <= 30))
    return nxt.select(
        "encounter_id", "patient_key", "admit_date", "discharge_date", "next_admit_date",
        F.coalesce(flag, F.lit(False)).alias("is_30d_readmission"),
        days.alias("days_to_readmit"),
    )


# ── report order (O1) ─────────────────────────────────────────────────────
READMISSION_ORDER = ["patient_key", "admit_date"]
PROGRESSION_ORDER = ["patient_key", "icd10_code", "encounter_date"]


def in_order(report: DataFrame, order: list[str]) -> DataFrame:
    """A report in its final order (ascending, nulls last), for whoever reads
    it row by row: a range-partitioned sort, not needed for further joins."""
    return report.orderBy(*[F.col(c).asc_nulls_last() for c in order])


# ── J1: the date dimension in two roles ───────────────────────────────────
def by_calendar(fact_encounter: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Stays per admission year, quarter and day kind, and discharge day kind.
    The dimension has one row per calendar day."""
    days = dim_date.select("date_key", "year_number", "quarter_number", "is_weekday", "is_federal_holiday")
    admit = days.toDF("admit_date_key", "admit_year", "admit_quarter", "admit_weekday", "admit_holiday")
    leave = days.select("date_key", "is_weekday").toDF("discharge_date_key", "discharge_weekday")
    x = (fact_encounter.select("admit_date_key", "discharge_date_key", "length_of_stay_days")
         .join(F.broadcast(admit), "admit_date_key").join(F.broadcast(leave), "discharge_date_key"))
    return x.groupBy("admit_year", "admit_quarter", "admit_weekday", "admit_holiday", "discharge_weekday").agg(
        F.count(F.lit(1)).alias("stays"), avg_int_round("length_of_stay_days").alias("avg_los"))


# ── M2: provider scorecard ────────────────────────────────────────────────
def provider_metrics(fact_encounter: DataFrame, dim_provider: DataFrame, year: int) -> DataFrame:
    lo, hi = _year_bounds(year)
    f = fact_encounter.where(F.col("admit_date").between(lo, hi))
    # Aggregate the fact to provider grain first (map-side partial agg),
    # then attach the provider attributes.
    per_provider = f.groupBy("attending_provider_key").agg(
        F.countDistinct("encounter_key").alias("total_encounters"),
        avg_int_round("length_of_stay_days").alias("avg_los"),
        (F.sum("total_charges") / F.count("total_charges")).alias("avg_charges_raw"),
        avg_dec_round("total_charges").alias("avg_charges"),
        avg_dec_round("total_payments").alias("avg_payments"),
        F.sum(F.col("readmission_30d_flag").cast("int")).alias("readmissions"),
        F.count("*").alias("n_rows"),
        F.sum(F.col("mortality_flag").cast("int")).alias("mortalities"),
    )
    dp = dim_provider.select("provider_key", "npi", "provider_name", "specialty")
    j = per_provider.join(dp, per_provider.attending_provider_key == dp.provider_key)
    return j.select(
        "provider_key", "npi", "provider_name", "specialty", "total_encounters",
        "avg_los", "avg_charges_raw", "avg_charges", "avg_payments",
        "readmissions",
        pct(F.col("readmissions"), F.col("n_rows"), 2).cast("double").alias("readmission_rate_pct"),
        "mortalities",
    )


def provider_scorecard(fact_encounter: DataFrame, dim_provider: DataFrame, year: int) -> DataFrame:
    """Rankings within specialty, from counts per (specialty, value): no task
    sorts the providers of a specialty.  Ties of NTILE and of the running sum
    are in order of the provider key."""
    pm = materialize(provider_metrics(fact_encounter, dim_provider, year), "provider_metrics")
    by_cost = ranked(pm.select("provider_key", "specialty", "avg_charges_raw"), "specialty", "avg_charges_raw", "provider_key",
                     rank="cost_rank", ntile={"cost_quartile": 4})
    by_quality = ranked(pm.select("provider_key", "specialty", "readmission_rate_pct"), "specialty", "readmission_rate_pct",
                        "provider_key", rank="quality_rank", percent_rank="quality_percentile", ntile={"quality_quartile": 4})
    by_volume = ranked(pm.select("provider_key", "specialty", "total_encounters"), "specialty", "total_encounters", "provider_key",
                       descending=True, running_sums={"cumulative_encounters_in_specialty": "total_encounters"})
    places = (by_cost.drop("specialty", "avg_charges_raw").join(by_quality.drop("specialty", "readmission_rate_pct"), "provider_key")
              .join(by_volume.drop("specialty", "total_encounters"), "provider_key"))
    ranked_rows = pm.join(places, "provider_key").select(
        *pm.columns, "cost_rank", "quality_rank", "quality_percentile", "cost_quartile", "quality_quartile",
        "cumulative_encounters_in_specialty")
    tier = F.round((F.col("cost_quartile") + F.col("quality_quartile")) / 2.0, 1)
    return (ranked_rows.drop("avg_charges_raw")
            .withColumn("composite_tier", tier.cast("double"))
            .orderBy("specialty", "composite_tier", F.col("total_encounters").desc()))


# ── M3: chronic condition progression ────────────────────────────────────
def chronic_progression(fact_encounter: DataFrame, bridge: DataFrame,
                        dim_diagnosis: DataFrame, gap_days: int = 365) -> DataFrame:
    chronic = (dim_diagnosis.where(F.col("is_chronic"))
               .select("diagnosis_key", "icd10_code", "icd10_description", "cms_hcc_category"))
    x = (fact_encounter.select("encounter_key", "patient_key",
                               F.col("admit_date").alias("encounter_date"))
         .join(bridge.select("encounter_key", "diagnosis_key"), "encounter_key")
         .join(chronic, "diagnosis_key"))
    entity = ["patient_key", "icd10_code"]
    order = ["encounter_date", "encounter_key", "diagnosis_key"]
    # MIN over the entity is the first row's date (the order starts with it).
    seq = neighbors(x, entity, order, ["encounter_date"], lead=False, lag=True,
                    row_number="diagnosis_occurrence_num", first=["encounter_date"])
    timeline = seq.select(
        "patient_key", "icd10_code", "icd10_description", "cms_hcc_category",
        F.col("first_encounter_date").alias("first_diagnosis_date"), "encounter_date",
        F.col("prev_encounter_date").alias("prev_diagnosis_date"),
        "diagnosis_occurrence_num")
    since_last = F.datediff("encounter_date", "prev_diagnosis_date")
    timeline = timeline.select(
        "patient_key", "icd10_code", "icd10_description", "cms_hcc_category",
        "first_diagnosis_date", "encounter_date", "diagnosis_occurrence_num",
        F.datediff("encounter_date", "first_diagnosis_date").alias("days_since_first_dx"),
        since_last.alias("days_since_last_episode"),
        F.coalesce(since_last > gap_days, F.lit(False)).alias("is_new_episode_after_gap"),
    )
    # Distinct conditions per patient: count first occurrences (aggregate and
    # join back instead of a distinct-count window, which Spark rejects and
    # which would pin a whole patient partition in memory).
    burden = (timeline.where(F.col("diagnosis_occurrence_num") == 1)
              .groupBy("patient_key").agg(F.count("*").alias("total_chronic_conditions")))
    n = F.col("total_chronic_conditions")
    return (timeline.join(burden, "patient_key")
            .withColumn("condition_burden_category",
                        F.when(n >= 5, "Complex").when(n >= 2, "Moderate").otherwise("Low")))


# ── M4: monthly revenue trend ─────────────────────────────────────────────
def monthly_claims(fact_claim: DataFrame) -> DataFrame:
    return (fact_claim
            .groupBy(F.trunc("service_date", "month").alias("month_start"))
            .agg(F.count("*").alias("total_claims"),
                 F.sum("billed_amount").cast("decimal(18,2)").alias("total_billed"),
                 F.sum("paid_amount").cast("decimal(18,2)").alias("total_paid"),
                 F.count_if(F.col("claim_status") == "Denied").alias("denied_claims")))


def revenue_trend(fact_claim: DataFrame) -> DataFrame:
    m = monthly_claims(fact_claim)
    # One row per month after the aggregate: the unpartitioned window below
    # sees a few hundred rows at most.
    w = Window.orderBy("month_start")
    prev = F.lag("total_paid").over(w)
    hundred = F.lit(100).cast("decimal(3,0)")
    growth = F.round((F.col("total_paid") - prev) * hundred / F.nullif(prev, F.lit(0)), 2)
    return m.select(
        "month_start", "total_claims", "total_billed", "total_paid",
        pct(F.col("denied_claims"), F.col("total_claims"), 2).cast("double").alias("denial_rate_pct"),
        F.round(F.avg("total_paid").over(w.rowsBetween(-2, 0)), 2).cast("decimal(18,2)")
         .alias("paid_3mo_moving_avg"),
        F.round(F.avg("total_paid").over(w.rowsBetween(-11, 0)), 2).cast("decimal(18,2)")
         .alias("paid_12mo_moving_avg"),
        growth.cast("double").alias("mom_growth_pct"),
        F.lag("total_paid", 12).over(w).alias("prior_year_paid"),
    ).orderBy("month_start")


# ── M5: provider average beside each encounter ───────────────────────────
def provider_avg_charges(fact_encounter: DataFrame) -> DataFrame:
    """Decorrelated form of the per-row provider average.

    The per-provider aggregate is one row per provider; joining it back lets
    AQE broadcast it, so the fact is never shuffled or sorted, and a provider
    holding a large share of encounters is not pinned to one task."""
    per = (fact_encounter.groupBy("attending_provider_key")
           .agg(avg_dec_round("total_charges").alias("provider_avg_charges")))
    f = fact_encounter.select("encounter_id", "patient_key", "total_charges",
                              "attending_provider_key")
    return (f.join(per, "attending_provider_key", "left")
            .select("encounter_id", "patient_key", "total_charges",
                    "provider_avg_charges"))


# ── M6: patients with a readmission ───────────────────────────────────────
def readmitted_patients(dim_patient: DataFrame, fact_encounter: DataFrame) -> DataFrame:
    flagged = fact_encounter.where(F.col("readmission_30d_flag")).select("patient_key")
    return dim_patient.select("patient_key").join(flagged, "patient_key", "left_semi")


# ── M7: high-volume provider cost report ─────────────────────────────────
def provider_cost_report(fact_encounter: DataFrame, dim_provider: DataFrame,
                         year: int, min_encounters: int = 30) -> DataFrame:
    lo, hi = _year_bounds(year)
    f = fact_encounter.where(F.col("admit_date").between(lo, hi)
                             & (F.col("encounter_type") == "IP"))
    per = f.groupBy("attending_provider_key").agg(
        F.count("*").alias("n"),
        F.sum("length_of_stay_days").alias("los_sum"),
        F.count("length_of_stay_days").alias("los_n"),
        F.sum("total_charges").alias("charges_sum"),
        F.count("total_charges").alias("charges_n"))
    dp = (dim_provider.where(F.col("is_current_record"))
          .select("provider_key", "provider_name", "specialty"))
    j = per.join(dp, per.attending_provider_key == dp.provider_key)
    g = j.groupBy("provider_name", "specialty").agg(
        F.sum("n").alias("encounter_count"),
        (F.sum("los_sum").cast("decimal(20,0)") / F.sum("los_n")).alias("avg_los"),
        (F.sum("charges_sum") / F.sum("charges_n")).alias("avg_charges"))
    return (g.where(F.col("encounter_count") >= min_encounters)
            .select("provider_name", "specialty", "encounter_count",
                    _round_double(F.col("avg_los")).alias("avg_los"),
                    _round_double(F.col("avg_charges")).alias("avg_charges"))
            .orderBy(F.col("avg_charges").desc()))


# ── X15: generated readmission column on the fact ────────────────────────
def with_readmit_flag(fact_encounter: DataFrame, readmissions: DataFrame) -> DataFrame:
    """The fact with ``is_30day_readmit`` derived from the readmission
    detection (M1); non-inpatient stays are FALSE.  Joined on the unique
    encounter id."""
    flags = readmissions.select("encounter_id", F.col("is_30d_readmission").alias("_flag"))
    return (fact_encounter.join(flags, "encounter_id", "left")
            .withColumn("is_30day_readmit", F.coalesce(F.col("_flag"), F.lit(False)))
            .drop("_flag"))


# ── X14: facility dimension ───────────────────────────────────────────────
def facility_dimension(dim_provider: DataFrame) -> DataFrame:
    """One row per facility (from the current provider rows) with its
    provider count; ``operators.merge.assign_keys`` adds surrogate keys."""
    return (dim_provider.where(F.col("is_current_record"))
            .groupBy("facility_name", "facility_type", "address_city", "address_state")
            .agg(F.count("*").alias("provider_count")))
