"""Data-quality suite (Q1-Q12): seven checks, the result log, the latest
status / failure-trend views and the load gate.

Each check is one aggregate pass over its table (total and failing counts
in the same ``agg``), plus a bounded sample: the failing rows are ordered by
their natural key and cut to five with ``orderBy().limit()`` (a per-task
top-k), never by collecting a whole group.  All check rows of a run are
one lazy plan, written once.  (Computing samples only for failing checks
needs the counts first, i.e. a second job; measured slower here, where most
checks fail, because the two jobs no longer share the tables' exchanges.)
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.exprs import check_status, failure_rate_pct, ts_lit

SAMPLE_SIZE = 5

# Validity patterns and accepted codes of the checks.
ICD10_PATTERN = r"^[A-Z][0-9]{2}(\..*)?$"
NPI_PATTERN = r"^[0-9]{10}$"
VALID_GENDERS = ["M", "F", "U"]


@dataclass(frozen=True)
class CheckSpec:
    name: str
    category: str
    table: str
    column: str
    threshold_pct: float


# The seven checks (name, category, table, column, threshold %).
CHECKS = {
    "completeness": CheckSpec("patient_completeness_dob_gender", "completeness",
                              "edw.dim_patient", "date_of_birth, gender", 1.0),
    "icd10": CheckSpec("icd10_code_format_validity", "validity", "edw.dim_diagnosis",
                       "icd10_code", 0.0),
    "npi": CheckSpec("npi_format_validity", "validity", "edw.dim_provider", "npi", 0.0),
    "dates": CheckSpec("encounter_discharge_before_admit", "consistency", "edw.fact_encounter",
                       "admit_date_key, discharge_date_key", 0.0),
    "amounts": CheckSpec("claim_paid_exceeds_billed", "consistency", "edw.fact_claim",
                         "paid_amount, billed_amount", 0.1),
    "timeliness": CheckSpec("encounter_daily_volume_timeliness", "timeliness",
                            "edw.fact_encounter", "admit_date_key", 0.0),
    "uniqueness": CheckSpec("encounter_id_uniqueness", "uniqueness", "edw.fact_encounter",
                            "encounter_id", 0.0),
}


def _one_row(*frames: DataFrame) -> DataFrame:
    """Merge single-row aggregate frames with disjoint columns into one row
    (union, then one more global aggregate) without a cartesian product."""
    cols: list[str] = []
    types: dict[str, str] = {}
    for f in frames:
        cols += f.columns
        types.update(dict(f.dtypes))
    padded = [f.select(*[F.col(c) if c in f.columns else F.lit(None).cast(types[c]).alias(c)
                         for c in cols]) for f in frames]
    u = padded[0]
    for p in padded[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.max(c).alias(c) for c in cols])


def _result(spec: CheckSpec, counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Combine a one-row count frame and a one-row sample frame."""
    return _one_row(counts, samples).select(
        F.lit(spec.name).alias("check_name"), F.lit(spec.category).alias("check_category"),
        F.lit(spec.table).alias("target_table"), F.lit(spec.column).alias("target_column"),
        F.col("records_checked").cast("long"), F.col("records_failed").cast("long"),
        F.lit(spec.threshold_pct).cast("decimal(8,4)").alias("threshold_pct"),
        "sample_failures")


# ── the seven checks ──────────────────────────────────────────────────────
def _parts_completeness(dim_patient: DataFrame):
    cur = dim_patient.where(F.col("is_current_record"))
    rule = (F.col("date_of_birth").isNull() | F.col("gender").isNull()
            | ~F.col("gender").isin(VALID_GENDERS))
    rule = F.coalesce(rule, F.lit(True))
    counts = cur.agg(F.count("*").alias("records_checked"),
                     F.count_if(rule).alias("records_failed"))
    missing = (F.when(F.col("date_of_birth").isNull(), "date_of_birth")
               .when(F.col("gender").isNull(), "gender").otherwise("invalid_gender"))
    failing = cur.where(rule).select("patient_id", missing.alias("missing_field"))
    samples = _samples_simple(failing, "patient_id", ["patient_id", "missing_field"])
    return counts, samples


def _samples_simple(failing: DataFrame, key: str, fields: list[str],
                    descending: bool = False) -> DataFrame:
    """One row: JSON array of up to five failing rows ordered by ``key``
    (ties by the other fields); NULL when nothing failed."""
    order = F.col(key).desc() if descending else F.col(key).asc()
    top = failing.orderBy(order, *[F.col(c) for c in fields if c != key]).limit(SAMPLE_SIZE)
    packed = F.struct(F.col(key).alias("_k"), F.struct(*[F.col(c) for c in fields]).alias("_v"))
    arr = F.transform(F.sort_array(F.collect_list(packed), asc=not descending), lambda x: x["_v"])
    return top.agg(F.when(F.size(arr) > 0, F.to_json(arr, {"ignoreNullFields": "false"})).alias("sample_failures"))


def _parts_icd10(dim_diagnosis: DataFrame):
    bad = ~F.col("icd10_code").rlike(ICD10_PATTERN)
    counts = dim_diagnosis.agg(F.count("*").alias("records_checked"),
                               F.count_if(bad).alias("records_failed"))
    failing = dim_diagnosis.where(bad).select("icd10_code")
    return counts, _samples_simple(failing, "icd10_code", ["icd10_code"])


def _parts_npi(dim_provider: DataFrame):
    cur = dim_provider.where(F.col("is_current_record"))
    bad = ~F.col("npi").rlike(NPI_PATTERN)
    counts = cur.agg(F.count("*").alias("records_checked"), F.count_if(bad).alias("records_failed"))
    failing = cur.where(bad).select("npi", "provider_name")
    return counts, _samples_simple(failing, "npi", ["npi", "provider_name"])


def _parts_dates(fact_encounter: DataFrame):
    bad = F.col("discharge_date") < F.col("admit_date")
    counts = fact_encounter.agg(F.count("*").alias("records_checked"),
                                F.count_if(bad).alias("records_failed"))
    failing = fact_encounter.where(bad).select(
        "encounter_id", F.col("admit_date").cast("string").alias("admit_date"),
        F.col("discharge_date").cast("string").alias("discharge_date"))
    return counts, _samples_simple(failing, "encounter_id",
                                   ["encounter_id", "admit_date", "discharge_date"])


def _parts_amounts(fact_claim: DataFrame):
    bad = F.coalesce(F.col("paid_amount") > F.col("billed_amount"), F.lit(False))
    counts = fact_claim.agg(F.count("*").alias("records_checked"),
                            F.count_if(bad).alias("records_failed"))
    failing = fact_claim.where(bad).select(
        "claim_id", F.col("billed_amount").cast("string").alias("billed_amount"),
        F.col("paid_amount").cast("string").alias("paid_amount"))
    return counts, _samples_simple(failing, "claim_id",
                                   ["claim_id", "billed_amount", "paid_amount"])


def _parts_timeliness(fact_encounter: DataFrame, as_of: _dt.date):
    """Yesterday's volume below half the mean daily volume of days -8..-2
    (days without encounters are absent, not zero; no baseline -> pass,
    ruling R16).  Reads only the eight days involved (pushed-down filter)."""
    y = as_of - _dt.timedelta(days=1)
    lo, hi = as_of - _dt.timedelta(days=8), as_of - _dt.timedelta(days=2)
    window = fact_encounter.where(F.col("admit_date").between(F.lit(lo), F.lit(y)))
    daily = window.groupBy("admit_date").agg(F.count("*").alias("n"))
    stats = daily.agg(
        F.coalesce(F.sum(F.when(F.col("admit_date") == F.lit(y), F.col("n"))), F.lit(0))
        .alias("yesterday_count"),
        (F.sum(F.when(F.col("admit_date").between(F.lit(lo), F.lit(hi)), F.col("n")))
         .cast("decimal(20,0)")
         / F.count(F.when(F.col("admit_date").between(F.lit(lo), F.lit(hi)), 1)))
        .cast("decimal(10,2)").alias("avg7"))
    failed = F.when(F.col("yesterday_count") < F.col("avg7") * F.lit(0.5), 1).otherwise(0)
    sample = F.to_json(F.array(F.struct(
        F.lit("encounter_volume_drop").alias("check"),
        F.col("yesterday_count").cast("string").alias("yesterday_count"),
        F.col("avg7").cast("string").alias("7day_avg"))), {"ignoreNullFields": "false"})
    # The sample (the two volumes) is part of the statistics: always shown.
    row = stats.select(F.lit(1).alias("records_checked"), failed.alias("records_failed"),
                       sample.alias("sample_failures"))
    return row, None


def _parts_uniqueness(fact_encounter: DataFrame):
    """Number of duplicated keys (not surplus rows); NULL keys form a group."""
    per_key = fact_encounter.groupBy("encounter_id").agg(F.count("*").alias("cnt"))
    dups = per_key.where(F.col("cnt") > 1)
    counts = _one_row(fact_encounter.agg(F.count("*").alias("records_checked")),
                      dups.agg(F.count("*").alias("records_failed")))
    top = dups.orderBy(F.col("cnt").desc(), F.col("encounter_id").asc_nulls_first()).limit(SAMPLE_SIZE)
    packed = F.struct(F.col("cnt").alias("_k"), F.col("encounter_id").alias("_k2"),
                      F.struct(F.col("encounter_id"),
                               F.col("cnt").cast("string").alias("count")).alias("_v"))
    arr = F.array_sort(F.collect_list(packed), lambda a, b: F.when(a["_k"] > b["_k"], -1)
                       .when(a["_k"] < b["_k"], 1)
                       .when(a["_k2"] < b["_k2"], -1).when(a["_k2"] > b["_k2"], 1).otherwise(0))
    arr = F.transform(arr, lambda x: x["_v"])
    samples = top.agg(F.when(F.size(arr) > 0, F.to_json(arr, {"ignoreNullFields": "false"})).alias("sample_failures"))
    return counts, samples


# Each check is a pair of one-row frames: counts, and samples (computed only
# when something failed).  The public functions combine both.
def check_patient_completeness(dim_patient: DataFrame) -> DataFrame:
    return _combine("completeness", *_parts_completeness(dim_patient))


def check_icd10_format(dim_diagnosis: DataFrame) -> DataFrame:
    return _combine("icd10", *_parts_icd10(dim_diagnosis))


def check_npi_format(dim_provider: DataFrame) -> DataFrame:
    return _combine("npi", *_parts_npi(dim_provider))


def check_encounter_dates(fact_encounter: DataFrame) -> DataFrame:
    return _combine("dates", *_parts_dates(fact_encounter))


def check_claim_amounts(fact_claim: DataFrame) -> DataFrame:
    return _combine("amounts", *_parts_amounts(fact_claim))


def check_encounter_timeliness(fact_encounter: DataFrame, as_of: _dt.date) -> DataFrame:
    return _combine("timeliness", *_parts_timeliness(fact_encounter, as_of))


def check_encounter_uniqueness(fact_encounter: DataFrame) -> DataFrame:
    return _combine("uniqueness", *_parts_uniqueness(fact_encounter))


def _combine(key: str, counts: DataFrame, samples: DataFrame | None) -> DataFrame:
    return _result(CHECKS[key], counts, samples) if samples is not None else \
        _result_row(CHECKS[key], counts)


def _result_row(spec: CheckSpec, row: DataFrame) -> DataFrame:
    return row.select(
        F.lit(spec.name).alias("check_name"), F.lit(spec.category).alias("check_category"),
        F.lit(spec.table).alias("target_table"), F.lit(spec.column).alias("target_column"),
        F.col("records_checked").cast("long"), F.col("records_failed").cast("long"),
        F.lit(spec.threshold_pct).cast("decimal(8,4)").alias("threshold_pct"),
        "sample_failures")


# ── suite, log rows, views, gate ─────────────────────────────────────────
def run_suite(dim_patient: DataFrame, dim_diagnosis: DataFrame, dim_provider: DataFrame,
              fact_encounter: DataFrame, fact_claim: DataFrame, run_id: str,
              as_of: _dt.datetime) -> DataFrame:
    """All checks of one run as dq_results rows (Q8 + Q9)."""
    return run_suite_on({"dim_patient": dim_patient, "dim_diagnosis": dim_diagnosis,
                         "dim_provider": dim_provider, "fact_encounter": fact_encounter,
                         "fact_claim": fact_claim}, run_id, as_of)


def _encounter_checks(fact_encounter: DataFrame) -> DataFrame:
    """Date-logic and uniqueness checks of the encounter fact from one stats
    row (row total, discharge-before-admit rows, duplicated keys): the fact
    is counted once, and both checks' rows come out of that row with
    ``stack``, so no branch prunes the shared aggregate into a copy."""
    bad = F.col("discharge_date") < F.col("admit_date")
    dups = (fact_encounter.groupBy("encounter_id").agg(F.count("*").alias("cnt"))
            .where(F.col("cnt") > 1))
    stats = _one_row(fact_encounter.agg(F.count("*").alias("total"),
                                        F.count_if(bad).alias("dates_failed")),
                     dups.agg(F.count("*").alias("dup_failed")))
    counts = stats.select(F.expr("stack(2, 'dates', total, dates_failed, "
                                 "'uniqueness', total, dup_failed) "
                                 "as (_check, records_checked, records_failed)"))
    _, date_samples = _parts_dates(fact_encounter)
    _, dup_samples = _parts_uniqueness(fact_encounter)
    samples = (date_samples.select(F.lit("dates").alias("_check"), "sample_failures")
               .unionByName(dup_samples.select(F.lit("uniqueness").alias("_check"),
                                               "sample_failures")))
    long = (counts.withColumn("sample_failures", F.lit(None).cast("string"))
            .unionByName(samples.select("_check", F.lit(None).cast("long").alias("records_checked"),
                                        F.lit(None).cast("long").alias("records_failed"),
                                        "sample_failures")))
    merged = long.groupBy("_check").agg(*[F.max(c).alias(c) for c in
                                          ("records_checked", "records_failed", "sample_failures")])

    def spec_col(attr: str, cast: str | None = None):
        e = F.when(F.col("_check") == "dates", F.lit(getattr(CHECKS["dates"], attr))) \
            .otherwise(F.lit(getattr(CHECKS["uniqueness"], attr)))
        return e.cast(cast) if cast else e

    return merged.select(
        spec_col("name").alias("check_name"), spec_col("category").alias("check_category"),
        spec_col("table").alias("target_table"), spec_col("column").alias("target_column"),
        F.col("records_checked").cast("long"), F.col("records_failed").cast("long"),
        spec_col("threshold_pct", "decimal(8,4)").alias("threshold_pct"), "sample_failures")


def run_suite_on(tables: dict[str, DataFrame], run_id: str, as_of: _dt.datetime) -> DataFrame:
    """The checks whose tables are given (a load checks what it loaded, T8).

    One lazy plan for the whole run: checks that read the same table share
    its scan and exchanges (Spark reuses identical subplans), and each
    check's counts and sample are two aggregates of that plan."""
    plan = [
        ("completeness", "dim_patient", _parts_completeness),
        ("icd10", "dim_diagnosis", _parts_icd10),
        ("npi", "dim_provider", _parts_npi),
        ("dates", "fact_encounter", _parts_dates),
        ("amounts", "fact_claim", _parts_amounts),
        ("timeliness", "fact_encounter", lambda df: _parts_timeliness(df, as_of.date())),
        ("uniqueness", "fact_encounter", _parts_uniqueness),
    ]
    rows = None
    fused = {"dates", "uniqueness"} if "fact_encounter" in tables else set()
    for k, t, fn in plan:
        if t in tables and k not in fused:
            part = _combine(k, *fn(tables[t]))
            rows = part if rows is None else rows.unionByName(part)
    if fused:
        part = _encounter_checks(tables["fact_encounter"])
        rows = part if rows is None else rows.unionByName(part)
    return as_results(rows, run_id, as_of)


def as_results(rows: DataFrame, run_id: str, as_of: _dt.datetime) -> DataFrame:
    """Checks' rows as dq_results rows of a run."""
    rate = failure_rate_pct("records_checked", "records_failed")
    return rows.select(
        F.expr("uuid()").alias("check_id"),
        F.lit(run_id).alias("run_id"),
        "check_name", "check_category", "target_table", "target_column",
        "records_checked", "records_failed",
        rate.alias("failure_rate_pct"), "threshold_pct",
        check_status(rate, F.col("threshold_pct")).alias("status"),
        "sample_failures",
        ts_lit(as_of).alias("checked_at"),
    )


# ── checks of two tables that change together ────────────────────────────
PAIR_CHECKS = (
    CheckSpec("encounter_patient_key_resolves", "consistency", "edw.fact_encounter", "patient_key", 0.0),
    CheckSpec("patient_current_record_unique", "uniqueness", "edw.dim_patient", "patient_id", 0.0),
    CheckSpec("patient_key_kept", "consistency", "edw.dim_patient", "patient_key", 0.0),
)


def check_pair(fact_encounter: DataFrame, dim_patient: DataFrame, published_dim: DataFrame | None) -> DataFrame:
    """Keys resolve both ways: every fact row has its patient row, every
    patient has one current row, and no key that was published is gone (older
    facts and other tables point at it)."""
    keys = dim_patient.select("patient_key")
    failed = [fact_encounter.select("patient_key").join(keys.distinct(), "patient_key", "left_anti"),
              dim_patient.where(F.col("is_current_record")).groupBy("patient_id").count().where("count > 1")]
    checked = [fact_encounter, dim_patient.where(F.col("is_current_record"))]
    if published_dim is not None:
        failed.append(published_dim.select("patient_key").join(keys, "patient_key", "left_anti"))
        checked.append(published_dim)
    rows = None
    for spec, all_rows, bad in zip(PAIR_CHECKS, checked, failed):
        counts = _one_row(all_rows.agg(F.count(F.lit(1)).alias("records_checked")), bad.agg(F.count(F.lit(1)).alias("records_failed")))
        part = _result_row(spec, counts.withColumn("sample_failures", F.lit(None).cast("string")))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def latest_status(results: DataFrame, history: int = 7) -> DataFrame:
    """Latest row per check with its last ``history`` statuses, newest first
    (Q10; includes sample_failures, ruling R15)."""
    w = Window.partitionBy("check_name").orderBy(F.col("checked_at").desc(), F.col("run_id").desc())
    ranked = results.select("*", F.row_number().over(w).alias("_rn")).where(F.col("_rn") <= history)
    trail = ranked.groupBy("check_name").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rn", "status"))),
                                 lambda x: x["status"]), ",").alias("last_7_statuses"))
    latest = ranked.where(F.col("_rn") == 1).select(
        "check_name", "check_category", "target_table", "target_column", "records_checked",
        "records_failed", "failure_rate_pct", "threshold_pct", "status", "checked_at",
        "sample_failures")
    return latest.join(trail, "check_name")


def failure_trend(results: DataFrame) -> DataFrame:
    """Daily failure trend per check (Q11)."""
    return (results.groupBy("check_name", "check_category", "target_table",
                            F.to_date("checked_at").alias("check_date"))
            .agg(F.round(F.sum("failure_rate_pct") / F.count("failure_rate_pct"), 4)
                 .cast("double").alias("avg_failure_rate_pct"),
                 F.max("failure_rate_pct").alias("max_failure_rate_pct"),
                 F.count_if(F.col("status") == "FAIL").alias("fail_count"),
                 F.count_if(F.col("status") == "WARN").alias("warn_count"),
                 F.count_if(F.col("status") == "PASS").alias("pass_count"))
            .orderBy(F.col("check_date").desc(), "check_name"))


def run_status_counts(results: DataFrame, run_id: str) -> DataFrame:
    """Status counts of one run (A16/A17) and the runner message (Q9)."""
    run = results.where(F.col("run_id") == run_id)
    return run.groupBy("run_id", "status").agg(F.count("*").alias("checks"))


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame, run_id: str) -> int:
    """Q12: raise when any check of ``run_id`` failed.  Call after the
    results have been appended, so failures are recorded before the stop."""
    fails = results.where((F.col("run_id") == run_id) & (F.col("status") == "FAIL")).count()
    if fails:
        raise QualityGateError(f"Run {run_id} complete. FAILs: {fails}")
    return fails


def suite_history(run, as_of: _dt.datetime, days: int, log_path: str | None = None) -> DataFrame:
    """Results of daily runs at ``as_of - days + 1 .. as_of`` (one run each).

    With ``log_path`` every run is its own job appending to the results log
    (partitioned by check date), as scheduled runs would, and the log is
    returned; without it the runs are unioned lazily."""
    if log_path is None:
        out = None
        for d in range(days - 1, -1, -1):
            at = as_of - _dt.timedelta(days=d)
            part = run(f"run-{at:%Y%m%d}", at)
            out = part if out is None else out.unionByName(part)
        return out
    for d in range(days - 1, -1, -1):
        at = as_of - _dt.timedelta(days=d)
        write_results(run(f"run-{at:%Y%m%d}", at), log_path)
    return read_results(log_path)


def write_results(results: DataFrame, log_path: str) -> None:
    """Append a run's rows to the results log, by check date."""
    (results.withColumn("check_date", F.to_date("checked_at")).repartition(1)  # a row per check
     .write.mode("append").partitionBy("check_date").parquet(log_path))


def read_results(log_path: str) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.read.parquet(log_path).drop("check_date")


def log_row(spark, run_id: str, check_name: str, category: str, target_table: str,
            target_column: str | None, records_checked: int, records_failed: int,
            threshold_pct: float, sample_failures: str | None,
            checked_at: _dt.datetime) -> DataFrame:
    """UD4: one dq_results row for a check computed elsewhere (rate, status)."""
    row = spark.createDataFrame(
        [(run_id, check_name, category, target_table, target_column, records_checked,
          records_failed, sample_failures)],
        "run_id string, check_name string, check_category string, target_table string, "
        "target_column string, records_checked long, records_failed long, "
        "sample_failures string")
    rate = failure_rate_pct("records_checked", "records_failed")
    threshold = F.lit(threshold_pct).cast("decimal(8,4)")
    return row.select(
        F.expr("uuid()").alias("check_id"), "run_id", "check_name", "check_category",
        "target_table", "target_column", "records_checked", "records_failed",
        rate.alias("failure_rate_pct"), threshold.alias("threshold_pct"),
        check_status(rate, threshold).alias("status"), "sample_failures",
        ts_lit(checked_at).alias("checked_at"))
