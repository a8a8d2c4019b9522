"""Load -> transform -> quality gate -> ledger.

A plain driver-side sequence of Spark jobs.  Claims: stage the landed files,
merge them into the claims fact as a new table version, run the quality checks
on the loaded table (results appended to the partitioned results log), stop at
the first failure, and always append one ledger row for the run.

Encounters: two tables change together, so they are written, audited and only
then published.  The next versions of the encounter fact and of the patient
dimension are staged (whole, but current for nobody), checked one by one and as
a pair, and become current, the dimension first, when every check has passed;
a failing check leaves both tables as they were.

No step pulls data to the driver beyond row counts.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators import sinks
from tessera.operators.sinks import VersionedTable, append_log, materialize
from tessera.plans import loads, quality
from tessera.session import scratch_path
from tessera.sources import ingest

LEDGER_SCHEMA = ("run_id string, pipeline_name string, status string, started_at timestamp_ntz, "
                 "finished_at timestamp_ntz, total_rows long, duration_sec double, "
                 "run_summary string, failed_step string, error_message string")


@dataclass
class StepResult:
    step: str
    status: str
    rows: int


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)


class _RunBook:
    """What a run did: one entry per step, none after the first failure."""

    def __init__(self, spark: SparkSession, run_id: str, pipeline_name: str):
        self.spark, self.run_id, self.name = spark, run_id, pipeline_name
        self.steps: list[StepResult] = []
        self.failed_step = self.error = None
        self.started, self.t0 = _now(), time.perf_counter()

    def run(self, name: str, fn) -> None:
        if self.failed_step:
            return
        try:
            self.steps.append(StepResult(name, "SUCCESS", int(fn())))
        except Exception as e:  # noqa: BLE001 - every failure ends the run
            self.failed_step, self.error = name, str(e)
            self.steps.append(StepResult(name, "FAILED", int(getattr(e, "rows", 0))))

    def close(self, ledger_path: str | None) -> DataFrame:
        summary = json.dumps([asdict(s) for s in self.steps], separators=(",", ":"))
        row = (self.run_id, self.name, "FAILED" if self.failed_step else "SUCCESS", self.started, _now(),
               sum(s.rows for s in self.steps), round(time.perf_counter() - self.t0, 3), summary, self.failed_step, self.error)
        ledger = self.spark.createDataFrame([row], LEDGER_SCHEMA)
        if ledger_path:
            append_log(ledger, ledger_path)
        return ledger


def _gate(spark: SparkSession, results: DataFrame, run_id: str, results_path: str | None) -> int:
    """Store the results, then stop the run if a check failed; the number of
    checks."""
    if results_path:
        append_log(results.withColumn("check_date", F.to_date("checked_at")), results_path, "check_date")
        results = spark.read.parquet(results_path)
    else:
        results = materialize(results, "dq_results")
    n_checks = results.where(F.col("run_id") == run_id).count()
    try:
        quality.gate(results, run_id)
    except quality.QualityGateError as e:
        e.rows = n_checks
        raise
    return n_checks


def run_claims_load(spark: SparkSession, landing_dir: str, fact_claim: VersionedTable,
                        dims: dict[str, DataFrame], run_id: str, as_of: _dt.datetime,
                        results_path: str | None = None, ledger_path: str | None = None,
                        pipeline_name: str = "claims_daily", rejects_path: str | None = None) -> DataFrame:
    book = _RunBook(spark, run_id, pipeline_name)
    staged: dict = {}

    def stage():
        # One pass over the landed files: parsed, stored and counted.
        landing, malformed = ingest.read_stage(spark, landing_dir)
        obs = Observation("stage")
        parsed = ingest.project_claims(landing).withColumn(loads.CLAIM_ROW, F.monotonically_increasing_id())
        staged["parsed"] = scratch_path(spark, "parsed")
        sinks.store(parsed.observe(obs, F.count(F.lit(1)).alias("rows")), staged["parsed"])
        staged["malformed"] = malformed
        return obs.get["rows"]

    def transform():
        # Without rejects only what is merged is stored.
        stored = scratch_path(spark, "claims_joined")
        joined = loads.store_claim_join(spark, staged["parsed"], dims, stored, None if rejects_path else loads.resolved_claims)
        if rejects_path:
            append_log(loads.claim_rejects(staged["malformed"], joined)
                       .withColumn("run_id", F.lit(run_id)), rejects_path)
        resolved = loads.resolved_claims(joined) if rejects_path else joined
        m = loads.commit_merged_claims(fact_claim, resolved, stored, counted=True)
        sinks.discard(spark, stored)
        return m["updated"] + m["inserted"]

    def quality_gate():
        return _gate(spark, quality.run_suite_on({"fact_claim": fact_claim.read()}, run_id, as_of), run_id, results_path)

    book.run("stage_load", stage)
    book.run("transform", transform)
    book.run("quality_gate", quality_gate)
    return book.close(ledger_path)


def run_encounters_load(spark: SparkSession, landing_dir: str, stg_patient: DataFrame, fact_encounter: VersionedTable,
                        dim_patient: VersionedTable, dims: dict[str, DataFrame], run_id: str, as_of: _dt.datetime,
                        rejects: VersionedTable | None = None, results_path: str | None = None,
                        ledger_path: str | None = None, pipeline_name: str = "encounters_daily") -> DataFrame:
    """Landed encounter files -> fact, patient extract -> dimension (SCD2),
    published together if the checks pass.

    Encounters are resolved against the published dimension, as the steps come
    in this order; those of patients that only this run adds go to ``rejects``
    and are read again with the next run.  ``rejects`` is published with the
    tables: a failed run leaves it as it was, too."""
    book = _RunBook(spark, run_id, pipeline_name)
    work: dict = {}

    def stage():
        landing, malformed = ingest.read_stage(spark, landing_dir)
        obs = Observation("stage")
        parsed = ingest.project_encounters(landing).observe(obs, F.count(F.lit(1)).alias("rows"))
        work["parsed"] = materialize(parsed, "encounters_parsed")
        return obs.get["rows"]

    def encounters():
        columns = [n for n, _ in ingest.ENCOUNTER_FIELDS]
        good = work["parsed"].where(F.col("_bad_fields") == 0).select(*columns)
        waiting = rejects.read() if rejects is not None else None
        if waiting is not None:
            good = good.unionByName(waiting.select(*columns))
        current = {**dims, "dim_patient": dim_patient.read()}
        lookups = [current[n] for n in ("dim_patient", "dim_provider", "dim_diagnosis")]
        target = fact_encounter.read()
        known = good.select("encounter_id").limit(0) if target is None else target
        new = materialize(loads.append_encounters(good, *lookups, known, as_of, window=None), "encounters_new")
        work["fact"] = fact_encounter.stage(new if target is None else target.unionByName(new.select(*target.columns)))
        if rejects is not None:
            lost = loads.latest_per_key(loads.unresolved_encounters(good, *lookups), ["encounter_id"], ["extracted_at"])
            work["rejects"] = rejects.stage(lost)
        return new.count()

    def patients():
        stats: dict = {}
        work["dim"] = dim_patient.stage(loads.load_dim_patient(dim_patient.read(), stg_patient, as_of.date(), as_of, stats))
        return sum(stats[k].count() for k in ("inserted", "expired"))

    def audit():
        fact, dim = fact_encounter.read_version(work["fact"]), dim_patient.read_version(work["dim"])
        results = quality.run_suite_on({"fact_encounter": fact, "dim_patient": dim}, run_id, as_of)
        pair = quality.as_results(quality.check_pair(fact, dim, dim_patient.read()), run_id, as_of)
        return _gate(spark, results.unionByName(pair), run_id, results_path)

    def publish():
        # The dimension first: a fact row never shows before its patient.
        for table, version in ((dim_patient, "dim"), (fact_encounter, "fact"), (rejects, "rejects")):
            if table is not None:
                table.publish(work[version])
        return 2

    book.run("stage_load", stage)
    book.run("transform_encounters", encounters)
    book.run("transform_patients_scd2", patients)
    book.run("quality_gate", audit)
    book.run("publish", publish)
    return book.close(ledger_path)
