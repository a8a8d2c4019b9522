"""Warehouse load jobs: patient SCD2 (M10), claims upsert (M8, batch form)
and the incremental encounter append (M9).

Each job takes the current table state plus the incoming batch and returns
the rows to write; ``tessera.operators.sinks`` commits them as a new table
version.  Dimension lookups use the current dimension rows only (the source
always uses the current row, even for old events: ruling J18).
"""

from __future__ import annotations

import datetime as _dt
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.exprs import date_key, fingerprint_key, patient_row_hash, ts_lit
from tessera.operators.dedup import latest_per_key
from tessera.operators.merge import append_new, changed_any, scd2_merge, upsert

if TYPE_CHECKING:
    from tessera.operators.sinks import VersionedTable

PATIENT_TRACKED = ["first_name", "last_name", "date_of_birth", "gender", "zip_code",
                   "state_code", "payer_type"]


# ── M10: patient dimension SCD2 ──────────────────────────────────────────
def load_dim_patient(dim_patient: DataFrame, stg_patient: DataFrame,
                     effective_date: _dt.date, now: _dt.datetime,
                     stats: dict | None = None) -> DataFrame:
    staged_hash = patient_row_hash(*[F.col(c) for c in PATIENT_TRACKED])
    return scd2_merge(dim_patient, stg_patient, "patient_id", "row_hash", staged_hash,
                      effective_date, now, surrogate_key="patient_key", stats=stats)


def etl_run_log_row(spark, procedure: str, stats: dict, now: _dt.datetime) -> DataFrame:
    """One log row with the inserted / expired counts of a load."""
    ins = stats["inserted"].agg(F.count("*").alias("rows_inserted"))
    upd = stats["expired"].agg(F.count("*").alias("rows_updated"))
    return (ins.unionByName(upd, allowMissingColumns=True)
            .agg(F.max("rows_inserted").alias("rows_inserted"),
                 F.max("rows_updated").alias("rows_updated"))
            .select(F.lit(procedure).alias("procedure_name"), "rows_inserted", "rows_updated",
                    ts_lit(now).alias("run_at")))


# ── M8: claims upsert ─────────────────────────────────────────────────────
CLAIM_KEYS = ["claim_id", "claim_line_number"]
CLAIM_CHANGE_COLS = ["claim_status", "paid_amount", "denial_reason_code"]
CLAIM_UPDATE_COLS = ["claim_status", "allowed_amount", "paid_amount", "patient_responsibility",
                     "denial_reason_code"]


def merge_claims(fact_claim: DataFrame, batch: DataFrame, null_safe: bool = False,
                 dedup_order: list[str] | None = None, stats: dict | None = None,
                 action_col: str | None = None) -> DataFrame:
    """Update five measures of matched claim lines when status, paid amount
    or denial code changed; insert new lines.  ``null_safe`` off by default
    (ruling R9)."""
    return upsert(fact_claim, batch, CLAIM_KEYS,
                  change_predicate=changed_any(CLAIM_CHANGE_COLS, null_safe=null_safe),
                  update_cols=CLAIM_UPDATE_COLS, dedup_order=dedup_order, stats=stats,
                  action_col=action_col)


# Partition columns a claims fact may be laid out by, derived from the
# service date (month partitions bound a rewrite to the months a batch
# touches; a year of claims is far too large to rewrite per batch).
SERVICE_PARTITIONS = {"service_year": lambda d: F.year(d), "service_month": lambda d: F.month(d)}


def with_service_partitions(df: DataFrame, cols) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, SERVICE_PARTITIONS[c](F.col("service_date")))
    return df


def merge_claims_partitions(table, batch: DataFrame, null_safe: bool = False, batch_path: str | None = None) -> int:
    """``merge_claims`` into a table partitioned by service period (see
    ``SERVICE_PARTITIONS``): only the periods that the batch names or that hold
    its lines are rewritten.  The partition columns are added from the service
    date; inserted lines get a ``claim_line_key``."""
    batch = with_service_partitions(batch, [c for c in table.partition_cols
                                            if c not in batch.columns])
    from tessera.operators.merge import upsert_partitions
    order = ["loaded_at"] if "loaded_at" in batch.columns else None
    numbered = not table.exists() or "claim_line_key" in table.read().columns
    return upsert_partitions(table, batch, CLAIM_KEYS,
                             surrogate_key="claim_line_key" if numbered else None,
                             change_predicate=changed_any(CLAIM_CHANGE_COLS, null_safe=null_safe),
                             update_cols=CLAIM_UPDATE_COLS, dedup_order=order, batch_path=batch_path)


def join_claim_dims(parsed: DataFrame, dims: dict[str, DataFrame], row: str | None = None) -> DataFrame:
    """J5 + J6 in one pass of left joins: parsed payloads with the surrogate
    keys of the current patient and provider rows, of the code dimensions and
    of the encounter, and ``missing_dimension``: the first lookup that failed
    (patient, provider, procedure, diagnosis; the encounter may be missing).
    Write the result, then take ``resolved`` and ``claim_rejects`` from it.

    ``row``: a column of the (stored) payloads that tells their rows apart.  Each
    lookup then moves the row and the natural key alone, and the payloads meet
    what was found by their row: shuffled once for all lookups."""
    def current(df: DataFrame) -> DataFrame:
        return df.where(F.col("is_current_record"))

    pat = current(dims["dim_patient"]).select("patient_id", "patient_key")
    prov = current(dims["dim_provider"]).select(F.col("npi").alias("rendering_npi"),
                                                F.col("provider_key").alias("rendering_provider_key"))
    proc = dims["dim_procedure"].select("procedure_code", "procedure_key")
    dx = dims["dim_diagnosis"].select(F.col("icd10_code").alias("primary_icd10"),
                                      F.col("diagnosis_key").alias("primary_diagnosis_key"))
    lookups = [pat, prov, proc, dx]
    if "fact_encounter" in dims:
        lookups.append(dims["fact_encounter"].select("encounter_id", "encounter_key"))
    joined, columns = parsed, [*parsed.columns]
    for dim in lookups:
        natural, surrogate = dim.columns
        columns.append(surrogate)
        if row is None:
            joined = joined.join(dim, natural, "left")
        else:
            found = parsed.select(row, natural).join(dim, natural).select(row, surrogate)
            joined = joined.join(found, row, "left")
    missing = (F.when(F.col("patient_key").isNull(), "patient").when(F.col("rendering_provider_key").isNull(), "provider")
               .when(F.col("procedure_key").isNull(), "procedure").when(F.col("primary_diagnosis_key").isNull(), "diagnosis"))
    return joined.select(*columns, missing.alias("missing_dimension"))


CLAIM_ROW = "_row"


def store_claim_join(spark, parsed: str, dims: dict[str, DataFrame], out: str, finish=None) -> DataFrame:
    """``join_claim_dims`` of payloads stored in the folder ``parsed`` with their
    ``CLAIM_ROW``, stored in ``out``: many in two turns, and the files of a turn
    are discarded when it is joined.  ``finish`` is applied to each."""
    from tessera.operators import sinks

    parts = sinks.dealt_files(spark, parsed, 2) or [[parsed]]
    schema = spark.read.parquet(parsed).schema
    for files in parts:
        rows = spark.read.schema(schema).parquet(*files)
        joined = join_claim_dims(rows, dims, CLAIM_ROW if len(parts) > 1 else None).drop(CLAIM_ROW)
        sinks.store(joined if finish is None else finish(joined), out, "append")
        sinks.discard(spark, *files)
    sinks.discard(spark, parsed)
    return spark.read.parquet(out)


def commit_merged_claims(fact: "VersionedTable", resolved: DataFrame, path: str, counted: bool = False) -> dict:
    """``merge_claims`` of rows stored in ``path`` as the fact's next version.
    Many in four turns by their keys, so that the shuffle files of a turn are a
    part of what both tables need.  ``counted``: rows updated and inserted."""
    from tessera.operators import sinks

    turns = sinks.turns(resolved.sparkSession, path, 4)
    target = fact.read()
    if target is None:  # first load: an empty table with the batch's columns
        target = resolved.drop("loaded_at").limit(0)
    seen = []

    def part(i: int) -> DataFrame:
        old, new = target, resolved
        if turns > 1:
            kinds = dict(resolved.dtypes)
            old = old.where(sinks.in_turn([F.col(k).try_cast(kinds[k]) for k in CLAIM_KEYS], i, turns))
            new = new.where(sinks.in_turn([F.col(k) for k in CLAIM_KEYS], i, turns))
        merged = merge_claims(old, new, dedup_order=["loaded_at"], action_col="_action")
        if counted:  # row counts ride along with the write (no extra job)
            seen.append(Observation(f"merge_{i}"))
            merged = merged.observe(seen[-1], F.count_if(F.col("_action") == "updated").alias("updated"),
                                    F.count_if(F.col("_action") == "inserted").alias("inserted"))
        return merged.drop("_action")

    fact.commit_parts(part(i) for i in range(turns))
    return {k: sum(o.get[k] for o in seen) for k in ("updated", "inserted")}


def unresolved_claims(parsed: DataFrame, dim_patient: DataFrame, dim_provider: DataFrame,
                      dim_procedure: DataFrame, dim_diagnosis: DataFrame) -> DataFrame:
    """Claims without a dimension row, with the first lookup that failed."""
    joined = join_claim_dims(parsed, {"dim_patient": dim_patient, "dim_provider": dim_provider,
                                      "dim_procedure": dim_procedure, "dim_diagnosis": dim_diagnosis})
    return joined.where(F.col("missing_dimension").isNotNull()).select(*parsed.columns, "missing_dimension")


def _sound(joined: DataFrame):
    return F.col("_bad_fields") == 0 if "_bad_fields" in joined.columns else F.lit(True)


def resolved_claims(joined: DataFrame) -> DataFrame:
    """The fact's columns of the claims that found every dimension row."""
    return joined.where(_sound(joined) & F.col("missing_dimension").isNull()).select(
        "claim_id", "claim_line_number", "encounter_key", "patient_key",
        "rendering_provider_key", "service_date",
        date_key("service_date").alias("service_date_key"),
        date_key("paid_date").alias("paid_date_key"),
        "procedure_key", "primary_diagnosis_key", "billed_amount", "allowed_amount",
        "paid_amount", "patient_responsibility", "units_of_service", "claim_status",
        "denial_reason_code", *[c for c in ("loaded_at",) if c in joined.columns])


def claim_rejects(malformed: DataFrame, joined: DataFrame) -> DataFrame:
    """Everything a claims load does not merge, with the reason: lines that
    are no JSON, payloads with a bad or missing field, claims without a
    dimension row (J5)."""
    from tessera.sources import ingest

    raw = F.to_json(F.struct(*[c for c, _ in ingest.CLAIM_FIELDS])).alias("raw_record")
    reason = F.when(~_sound(joined), "uncastable_field").otherwise(
        F.concat(F.lit("unresolved_"), F.col("missing_dimension")))
    lost = joined.where(~_sound(joined) | F.col("missing_dimension").isNotNull())
    return malformed.unionByName(lost.select(raw, "file_name", "loaded_at", reason.alias("reason")))


# ── M9: incremental encounter append ──────────────────────────────────────
def _extracted(encounters_raw: DataFrame, as_of: _dt.datetime, window: _dt.timedelta | None) -> DataFrame:
    if window is None:
        return encounters_raw
    return encounters_raw.where(F.col("extracted_at") >= ts_lit(as_of - window))


def unresolved_encounters(encounters: DataFrame, dim_patient: DataFrame, dim_provider: DataFrame,
                          dim_diagnosis: DataFrame) -> DataFrame:
    """Rows that the dimension lookups of the append would drop (J7), with the
    first lookup that failed."""
    found = (encounters
             .join(dim_patient.where(F.col("is_current_record")).select("patient_id", F.lit(True).alias("_p")),
                   "patient_id", "left")
             .join(dim_provider.where(F.col("is_current_record"))
                   .select(F.col("npi").alias("attending_npi"), F.lit(True).alias("_r")), "attending_npi", "left")
             .join(dim_diagnosis.select(F.col("icd10_code").alias("primary_icd10_code"), F.lit(True).alias("_d")),
                   "primary_icd10_code", "left"))
    missing = (F.when(F.col("encounter_id").isNull(), "encounter_id").when(F.col("_p").isNull(), "patient")
               .when(F.col("_r").isNull(), "provider").when(F.col("_d").isNull(), "diagnosis"))
    return (found.select(*encounters.columns, missing.alias("missing_dimension"))
            .where(F.col("missing_dimension").isNotNull()))


def append_encounters(encounters_raw: DataFrame, dim_patient: DataFrame,
                      dim_provider: DataFrame, dim_diagnosis: DataFrame,
                      fact_encounter: DataFrame, as_of: _dt.datetime,
                      window: _dt.timedelta | None = _dt.timedelta(days=1)) -> DataFrame:
    """Rows extracted within ``window`` before ``as_of`` (None: all rows),
    resolved to surrogate keys, minus encounter ids already loaded.  Batch
    duplicates collapse to the latest extract (ruling R10); rows without a
    dimension row are listed by ``unresolved_encounters``."""
    src = _extracted(encounters_raw, as_of, window)
    src = latest_per_key(src, ["encounter_id"], ["extracted_at"])
    pat = dim_patient.where(F.col("is_current_record")).select("patient_id", "patient_key")
    prov = (dim_provider.where(F.col("is_current_record"))
            .select(F.col("npi").alias("attending_npi"),
                    F.col("provider_key").alias("attending_provider_key")))
    dx = dim_diagnosis.select(F.col("icd10_code").alias("primary_icd10_code"),
                              F.col("diagnosis_key").alias("primary_diagnosis_key"))
    j = src.join(pat, "patient_id").join(prov, "attending_npi").join(dx, "primary_icd10_code")
    new = append_new(j, fact_encounter, "encounter_id")
    return new.select(
        fingerprint_key("encounter_id").alias("encounter_key"),
        "patient_key", "attending_provider_key", "admit_date", "discharge_date",
        date_key("admit_date").alias("admit_date_key"),
        date_key("discharge_date").alias("discharge_date_key"),
        "primary_diagnosis_key", "encounter_id", "encounter_type", "admit_source",
        "discharge_disposition",
        F.datediff("discharge_date", "admit_date").alias("length_of_stay_days"),
        "icu_days", "total_charges", "total_payments", "readmission_30d_flag",
        "mortality_flag", ts_lit(as_of).alias("created_at"))


def watermarked_encounter_load(encounters_raw: DataFrame, dims: dict[str, DataFrame],
                               fact: "VersionedTable", watermark: "VersionedTable",
                               as_of: _dt.datetime, rejects: "VersionedTable | None" = None,
                               lateness: _dt.timedelta | None = _dt.timedelta(0)) -> int:
    """Incremental load driven by a stored high watermark instead of
    an assumed one-day window.

    A run reads what was extracted at or after the mark less ``lateness``
    (rows without an extract time always, everything in the first run or with
    ``lateness`` None); what the fact already holds is left out by its id, so
    reading a row again costs nothing but the reading.  Rows that arrive late
    with an older extract time need a ``lateness`` as long as they may be late.

    ``rejects`` is the keyed store of rows that found no dimension row: one row
    per encounter, the latest extract, with the lookup that failed, the time of
    the first failure and the number of runs.  Each run reads it along with
    the new rows and writes what is still unresolved, so an encounter whose
    provider arrives later is loaded then, however far the mark has moved.
    Rows without an encounter id are kept there, as they cannot be told apart.

    Order of commits: fact, rejects, mark.  A run that dies in between is
    repeated from the old mark and finds its rows loaded.  Returns the rows
    added."""
    from tessera.operators.sinks import materialize

    mark = watermark.read()
    after = mark.first()[0] if mark is not None else None
    fresh = encounters_raw
    if after is not None and lateness is not None:
        seen = F.col("extracted_at")
        fresh = fresh.where(seen.isNull() | (seen >= ts_lit(after - lateness)))
    columns = encounters_raw.columns
    waiting = rejects.read() if rejects is not None else None
    source = fresh if waiting is None else fresh.unionByName(waiting.select(*columns))
    # What this run reads, fixed once: the mark, the rows and the rejects agree.
    named = F.col("encounter_id").isNotNull()
    source = materialize(latest_per_key(source.where(named), ["encounter_id"], ["extracted_at"])
                         .unionByName(source.where(~named).distinct()), "encounters_extracted")
    target = fact.read()
    lookups = (dims["dim_patient"], dims["dim_provider"], dims["dim_diagnosis"])
    none_yet = source.select("encounter_id").limit(0) if target is None else target
    new = materialize(append_encounters(source.where(named), *lookups, none_yet, as_of, window=None), "encounters_new")
    added = new.count()
    if added or target is None:
        fact.commit(new if target is None else target.unionByName(new.select(*target.columns)))
    if rejects is not None:
        lost = unresolved_encounters(source, *lookups)
        first, runs = ts_lit(as_of), F.lit(1)
        if waiting is not None:
            known = waiting.select("encounter_id", "first_rejected_at", "runs")
            known = known.where(named).toDF("_known_id", "_first", "_runs")
            lost = lost.join(known, F.col("encounter_id") == F.col("_known_id"), "left")
            first, runs = F.coalesce("_first", first), F.coalesce("_runs", F.lit(0)) + 1
        rejects.commit(lost.select(*columns, "missing_dimension", first.alias("first_rejected_at"),
                                   runs.cast("int").alias("runs")))
    high = source.agg(F.max("extracted_at").alias("high_watermark"))
    if high.first()[0] is not None and (after is None or high.first()[0] > after):
        watermark.commit(high)
    return added


def encounters_last_n_days(fact_encounter: DataFrame, as_of: _dt.date, days: int = 365) -> DataFrame:
    """Bounded-period view; the admit_date predicate reaches the scan
    (and prunes partitions when the fact is partitioned by admit date)."""
    return fact_encounter.where(F.col("admit_date") >= F.lit(as_of - _dt.timedelta(days=days)))
