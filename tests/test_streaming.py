"""Stream equals batch: the claims file stream, fed one file per
micro-batch, ends in the same table as one batch MERGE; re-running the
stream on the same checkpoint processes nothing new."""

from pyspark.sql import functions as F

from tessera.operators import sinks
from tessera.plans import loads
from tessera.session import scratch_path
from tessera.sources import bindings as b
from tessera.sources import ingest
from tessera.sources import scenarios as sc
from tessera.sources.tables import Tables
from tessera.streaming import claims as claims_stream


def test_stream_equals_batch_and_replay_is_noop(spark, small_dir):
    t = Tables(spark, small_dir)
    c = sinks.materialize(sc.claims(t), "claims")
    batch = sc.claim_batch(c)
    expected = sorted(loads.merge_claims(sc.claim_target(c), batch).collect())

    landing = scratch_path(spark, "landing")
    payloads = sc.claim_payloads(batch, t).repartition(3, "service_year").select("claim_json")
    payloads.write.text(landing)
    # A corrupt line lands next to the good files and must be rejected, not fatal.
    spark.createDataFrame([("{not json",)], "value string").coalesce(1).write.mode("append").text(landing)

    dims = {"dim_patient": b.dim_patient(t), "dim_provider": b.dim_provider(t),
            "dim_procedure": b.dim_procedure(t), "dim_diagnosis": b.dim_diagnosis(t),
            "fact_encounter": b.fact_encounter(t)}
    target = sinks.versioned_table(spark, "fact_claim")
    target.commit(sc.claim_target(c))
    ckpt, rejects, ledger, checks = (scratch_path(spark, n)
                                     for n in ("ckpt", "rejects", "ledger", "checks"))
    q = claims_stream.run_claims_stream(spark, landing, ckpt, target, dims,
                                        max_files_per_trigger=1, rejects_path=rejects,
                                        ledger_path=ledger, checks_path=checks)
    q.awaitTermination()
    got = sorted(target.read().select(*sc.CLAIM_COLUMNS).collect())
    assert got == expected
    batches = spark.read.parquet(ledger).count()
    assert batches >= 2
    assert spark.read.parquet(rejects).where(F.col("reason") == "malformed_json").count() == 1
    # one claim-amount check result per micro-batch
    assert spark.read.parquet(checks).count() == batches

    version = target.current_version()
    q2 = claims_stream.run_claims_stream(spark, landing, ckpt, target, dims,
                                         max_files_per_trigger=1)
    q2.awaitTermination()
    assert target.current_version() == version


def test_projection_flags_uncastable_fields(spark):
    rows = [('{"claim_id": "C1", "claim_line_number": 2, "billed_amount": 12.5, '
             '"service_date": "2024-01-02"}',),
            ('{"claim_id": "C2", "claim_line_number": "two", "service_date": "2024-13-40"}',),
            ('[1, 2]',), ('{"claim_line_number": 1}',),
            ('{"claim_id": "C3", "claim_line_number": 1, "claim_status": " DENIED"}',)]
    landing = spark.createDataFrame(rows, "j string").select(F.parse_json("j").alias("claim_json"))
    out = {r.claim_id: r for r in ingest.project_claims(landing).collect()}
    assert out["C1"]._bad_fields == 0 and out["C1"].claim_line_number == 2
    # two values that don't cast, and no line number left
    assert out["C2"]._bad_fields == 3 and out["C2"].service_date is None
    # no object, no claim id: rejected; a status is normalised
    assert out[None]._bad_fields == 1 and out["C3"].claim_status == "Denied" and out["C3"]._bad_fields == 0


import pytest  # noqa: E402


@pytest.mark.parametrize("kind", ["versioned", "partitioned"])
def test_late_events_recompute_touched_dates(spark, small_dir, kind):
    """Second file carries events for days already published by the first
    batch; the mart must still equal a full rebuild (whole-version commits
    or partition-scoped rewrites of the touched dates)."""
    import datetime as dt

    from tessera.plans import product, staging
    from tessera.streaming import activity

    t = Tables(spark, small_dir)
    as_of = dt.datetime(2024, 1, 30)
    users = staging.stg_users(b.raw_users(t), as_of)
    expected = sorted(product.user_activity(staging.stg_events(b.raw_events(t)), users, as_of)
                      .collect(), key=repr)

    land = scratch_path(spark, "events_landing")
    ev = t.events
    ev.where(F.col("event_id") % 2 == 0).coalesce(1).write.parquet(f"{land}/a")
    ev.where(F.col("event_id") % 2 == 1).coalesce(1).write.parquet(f"{land}/b")
    mart = (sinks.versioned_table(spark, "mart") if kind == "versioned"
            else sinks.partitioned_table(spark, "mart", ["activity_date"]))
    flat = scratch_path(spark, "events_flat")
    # one directory, two files, arriving in order a then b
    spark.read.parquet(f"{land}/a").coalesce(1).write.parquet(flat)
    spark.read.parquet(f"{land}/b").coalesce(1).write.mode("append").parquet(flat)
    q = activity.run_activity_stream(spark, flat, "*.parquet", scratch_path(spark, "ck"),
                                     scratch_path(spark, "hist"), mart, users, as_of,
                                     b.raw_events_from, max_files_per_trigger=1)
    q.awaitTermination()
    if kind == "versioned":
        assert mart.current_version() == 2
    got = sorted(mart.read().select(*product.user_activity(
        staging.stg_events(b.raw_events(t)), users, as_of).columns).collect(), key=repr)
    assert got == expected


def test_unresolved_claims_name_the_missing_dimension(spark, small_dir):
    from tessera.plans import loads

    t = Tables(spark, small_dir)
    parsed = spark.createDataFrame(
        [("C1", "P0", "0000000001", "CPT1", "E02.0"), ("C2", "P999999", "0000000001", "CPT1", "x"),
         ("C3", "P0", "bad-npi", "CPT1", "x")],
        "claim_id string, patient_id string, rendering_npi string, procedure_code string, "
        "primary_icd10 string")
    got = {r.claim_id: r.missing_dimension for r in loads.unresolved_claims(
        parsed, b.dim_patient(t), b.dim_provider(t), b.dim_procedure(t), b.dim_diagnosis(t)).collect()}
    assert got["C2"] == "patient" and got["C3"] == "provider"
    assert "C1" not in got or got["C1"] == "diagnosis"
