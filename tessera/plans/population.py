"""Population-health analytics the project documents without SQL (X1, X3,
X4, X5): encounter journeys, LACE readmission risk, facility census and
provider charge ranking.

Ranking over a whole population (LACE percentile) is done on the score
distribution, not with a global window: scores take 20 values, so one
aggregate per score and a window over at most 20 rows give every stay's
exact percent rank, joined back as a bounded broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranking import ranked
from tessera.operators.sequence import neighbors, trailing_sums
from tessera.operators.sinks import materialize


# ── X1: encounter journey ────────────────────────────────────────────────
def encounter_journey(fact_encounter: DataFrame, days: int = 90) -> DataFrame:
    """Per patient: running encounter count, encounters and mean charges in
    the trailing ``days`` calendar days (RANGE frame on the admit day), from
    running sums, so a patient with a huge history is not one task."""
    base = fact_encounter.select("encounter_id", "patient_key", "admit_date", "total_charges")
    t = trailing_sums(base, "patient_key", "admit_date", "encounter_id", ["total_charges"], days, 0)
    return t.select(
        "encounter_id", "patient_key", "admit_date", "total_charges",
        F.col("w_seq").alias("encounter_seq"),
        F.col("w_count").alias("encounters_90d"),
        F.round(F.col("w_total_charges") / F.col("w_count"), 4).cast("double")
        .alias("avg_charges_90d"))


# ── X3: LACE index ───────────────────────────────────────────────────────
# LACE index point tables (length of stay, acuity,
# comorbidity, emergency visits in the previous six months).
LACE_LOS_POINTS = [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (7, 5), (14, 7)]  # (min days, points)
LACE_ACUITY_POINTS = 3
LACE_COMORBIDITY_POINTS = [(0, 0), (1, 1), (2, 2), (3, 3), (4, 5)]  # (min score, points)
LACE_ED_POINTS_CAP = 4
LACE_ED_LOOKBACK_DAYS = 182
EMERGENT_ADMIT_SOURCES = ["1-URGENT", "2-HIGH"]


def _points(value, table):
    expr = F.lit(0)
    for threshold, pts in table:
        expr = F.when(value >= threshold, F.lit(pts)).otherwise(expr)
    return expr


def lace_scores(fact_encounter: DataFrame, bridge: DataFrame, dim_diagnosis: DataFrame) -> DataFrame:
    """LACE score per inpatient stay plus its exact percent rank.

    Comorbidity uses the number of distinct chronic diagnoses coded on the
    stay (the bound data carries no Charlson weights); emergency visits are
    the patient's ED encounters in the 182 days before admission."""
    enc = fact_encounter.select("encounter_key", "encounter_id", "patient_key", "admit_date",
                                "encounter_type", "admit_source", "length_of_stay_days")
    is_ed = F.when(F.col("encounter_type") == "ED", 1).otherwise(0).cast("long")
    ed = (trailing_sums(enc.withColumn("is_ed", is_ed), "patient_key", "admit_date",
                        "encounter_id", ["is_ed"], LACE_ED_LOOKBACK_DAYS, 1, seq=False)
          .withColumnRenamed("w_is_ed", "ed_visits").drop("is_ed", "w_count"))
    chronic = dim_diagnosis.where(F.col("is_chronic")).select("diagnosis_key")
    comorb = (bridge.select("encounter_key", "diagnosis_key").join(chronic, "diagnosis_key")
              .groupBy("encounter_key").agg(F.countDistinct("diagnosis_key").alias("comorbidities")))
    ip = ed.where(F.col("encounter_type") == "IP").join(comorb, "encounter_key", "left")
    l_pts = _points(F.col("length_of_stay_days"), LACE_LOS_POINTS)
    a_pts = F.when(F.col("admit_source").isin(EMERGENT_ADMIT_SOURCES),
                   F.lit(LACE_ACUITY_POINTS)).otherwise(F.lit(0))
    c_pts = _points(F.coalesce(F.col("comorbidities"), F.lit(0)), LACE_COMORBIDITY_POINTS)
    e_pts = F.least(F.coalesce(F.col("ed_visits"), F.lit(0)), F.lit(LACE_ED_POINTS_CAP))
    scored = ip.select("encounter_id", "patient_key", "admit_date",
                       l_pts.alias("l_points"), a_pts.alias("a_points"),
                       c_pts.alias("c_points"), e_pts.cast("int").alias("e_points"))
    scored = scored.withColumn("lace_score", F.col("l_points") + F.col("a_points")
                               + F.col("c_points") + F.col("e_points"))
    dist = scored.groupBy("lace_score").agg(F.count("*").alias("n"))
    below = Window.orderBy("lace_score").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    ranks = dist.select(
        "lace_score",
        (F.coalesce(F.sum("n").over(below), F.lit(0)).cast("double")
         / F.greatest(F.sum("n").over(total) - 1, F.lit(1))).alias("lace_percentile"))
    return scored.join(F.broadcast(ranks), "lace_score").select(
        "encounter_id", "patient_key", "admit_date", "l_points", "a_points", "c_points",
        "e_points", "lace_score", F.round("lace_percentile", 6).alias("lace_percentile"))


# ── X1: encounter sequence ───────────────────────────────────────────────
def encounter_sequence(fact_encounter: DataFrame) -> DataFrame:
    """Per patient in order of admission: previous and next encounter, place
    in the history and charges so far."""
    base = fact_encounter.select("encounter_id", "patient_key", "admit_date", "encounter_type", "total_charges")
    seq = neighbors(base, "patient_key", ["admit_date", "encounter_id"], ["admit_date", "encounter_type"],
                    lag=True, row_number="encounter_seq", running_sums=["total_charges"])
    return seq.select(
        "encounter_id", "patient_key", "admit_date", "encounter_seq", "prev_admit_date", "prev_encounter_type",
        "next_admit_date", "next_encounter_type", F.datediff("admit_date", "prev_admit_date").alias("days_since_last"),
        F.col("cum_total_charges").cast("decimal(18,2)").alias("charges_to_date"))


# ── X4: facility daily census ────────────────────────────────────────────
def facility_census(fact_encounter: DataFrame, dim_provider: DataFrame, as_of) -> DataFrame:
    """Midnight census per facility and day (admit <= day < discharge; a stay
    without a discharge counts up to ``as_of``), over the days from the first
    admission of any facility to ``as_of``, with 7/30-day rolling mean and max
    and the day-over-day change.

    A stay is +1 on its first day and -1 on its last, however long it lasts;
    the census is their running sum over the facility's days."""
    stays = (fact_encounter.where((F.col("encounter_type") == "IP") & (F.col("admit_date") <= F.lit(as_of))
                                  & (F.coalesce(F.col("discharge_date") > F.col("admit_date"), F.lit(True))))
             .select("attending_provider_key", "admit_date", "discharge_date"))
    fac = dim_provider.select(F.col("provider_key").alias("attending_provider_key"),
                              "facility_name")
    change = F.explode(F.array(F.struct(F.col("admit_date").alias("census_date"), F.lit(1).alias("step")),
                               F.struct(F.col("discharge_date").alias("census_date"), F.lit(-1).alias("step"))))
    steps = (stays.join(fac, "attending_provider_key").select("facility_name", change.alias("c"))
             .where("c.census_date IS NOT NULL")
             .groupBy("facility_name", "c.census_date").agg(F.sum("c.step").alias("step")))
    # One row per facility; the first day is the least of all facilities.
    spans = steps.groupBy("facility_name").agg(F.min("census_date").alias("lo"))
    spine = (spans.withColumn("lo", F.min("lo").over(Window.partitionBy()))
             .select("facility_name", F.explode(F.sequence("lo", F.lit(as_of))).alias("census_date")))
    w = Window.partitionBy("facility_name").orderBy("census_date")
    full = (spine.join(steps, ["facility_name", "census_date"], "left")
            .select("facility_name", "census_date", F.coalesce(F.sum("step").over(
                w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("census")))
    w7, w30 = w.rowsBetween(-6, 0), w.rowsBetween(-29, 0)
    return full.select(
        "facility_name", "census_date", "census",
        F.round(F.sum("census").over(w7).cast("decimal(20,0)") / F.count("census").over(w7), 4)
        .cast("double").alias("avg_7d"),
        F.max("census").over(w7).alias("max_7d"),
        F.round(F.sum("census").over(w30).cast("decimal(20,0)") / F.count("census").over(w30), 4)
        .cast("double").alias("avg_30d"),
        F.max("census").over(w30).alias("max_30d"),
        (F.col("census") - F.lag("census").over(w)).alias("dod_delta"))


# ── X5: dense rank and comparison to the specialty mean ─────────────────
def provider_charge_rank(fact_encounter: DataFrame, dim_provider: DataFrame) -> DataFrame:
    """Over all encounters.  The rank comes from counts per (specialty, value),
    the mean from an aggregate: no task holds a specialty's providers."""
    per = fact_encounter.groupBy("attending_provider_key").agg(
        F.sum("total_charges").cast("decimal(18,2)").alias("total_charges"))
    dp = dim_provider.select(F.col("provider_key").alias("attending_provider_key"), "specialty")
    j = materialize(per.join(dp, "attending_provider_key"), "provider_charges")
    mean = j.groupBy(F.col("specialty").alias("_specialty")).agg(
        F.round(F.sum("total_charges") / F.count("total_charges"), 2).alias("_mean"))
    places = ranked(j, "specialty", "total_charges", "attending_provider_key", descending=True, dense_rank="charge_dense_rank")
    return places.join(mean, F.col("specialty").eqNullSafe(F.col("_specialty"))).select(
        F.col("attending_provider_key").alias("provider_key"), "specialty", "total_charges", "charge_dense_rank",
        F.col("_mean").cast("decimal(18,2)").alias("specialty_avg_charges"),
        (F.col("total_charges") - F.col("_mean")).cast("decimal(18,2)").alias("diff_from_specialty_avg"))
