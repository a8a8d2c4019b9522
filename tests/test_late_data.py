"""Rows that come late: equal extract times, rejects replayed, folded
partials, events without a time (T7, X7, X10)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera import catalog
from tessera.operators import sinks
from tessera.plans import loads
from tessera.session import scratch_path
from tessera.sources import bindings as b
from tessera.sources import scenarios as sc
from tessera.sources.tables import Tables
from tessera.streaming import aggregates

AT = sc.ENCOUNTER_LOAD_AT
HOUR = dt.timedelta(hours=1)


@pytest.fixture()
def load(spark, small_dir):
    t = Tables(spark, small_dir)
    raw = sinks.materialize(sc.encounters_raw(t), "test-raw")
    fact, rejects, mark = (sinks.versioned_table(spark, n) for n in ("f", "r", "m"))

    def run(rows, at, providers=None, **args):
        return loads.watermarked_encounter_load(rows, catalog._encounter_dims(t, providers), fact, mark, at, rejects, **args)

    return t, raw, fact, rejects, run


def test_equal_extract_times_in_two_parts(load):
    t, raw, fact, rejects, run = load
    same = raw.withColumn("extracted_at", F.lit(AT).cast("timestamp_ntz"))
    half = F.crc32("encounter_id") % 2 == 0
    first, second = run(same.where(half), AT), run(same, AT + HOUR)
    assert second > 0 and first + second == raw.count() == fact.read().count()
    assert run(same, AT + 2 * HOUR) == 0


def test_late_provider_missing_id_and_missing_time(load):
    t, raw, fact, rejects, run = load
    providers = b.dim_provider(t)
    known = providers.where(F.col("provider_key") % 2 == 0)
    odd = (raw.limit(3).withColumn("encounter_id", F.lit(None).cast("string"))
           .unionByName(raw.limit(1).withColumn("encounter_id", F.lit("no-time")).withColumn("extracted_at", F.lit(None).cast("timestamp_ntz"))))
    all_rows = sinks.materialize(raw.unionByName(odd), "test-odd")
    loaded = run(all_rows, AT, known)
    waiting = rejects.read()
    assert waiting.where("missing_dimension = 'encounter_id'").count() == 3
    assert loaded + waiting.count() == all_rows.count() and loaded < raw.count()
    # Nothing new is read, the dimension is there now.
    assert run(raw.limit(0), AT + HOUR, providers) == raw.count() + 1 - loaded
    assert fact.read().groupBy("encounter_id").count().where("count > 1").count() == 0
    left = rejects.read().collect()
    assert len(left) == 3 and {r.missing_dimension for r in left} == {"encounter_id"}


def test_lateness_reads_older_rows(load):
    t, raw, fact, rejects, run = load
    old = F.col("extracted_at") < F.lit(AT - 24 * HOUR).cast("timestamp_ntz")
    n_old = raw.where(old).count()
    assert n_old and run(raw.where(~old), AT) == raw.count() - n_old
    assert run(raw, AT + HOUR) == 0  # older than the mark, no lateness allowed
    assert run(raw, AT + HOUR, lateness=dt.timedelta(days=3)) == n_old


def test_reject_counts_runs(load):
    t, raw, fact, rejects, run = load
    none = b.dim_provider(t).limit(0)
    run(raw, AT, none)
    run(raw.limit(0), AT + HOUR, none)
    assert {(r.runs, r.first_rejected_at) for r in rejects.read().collect()} == {(2, AT)}


def test_folded_partials_read_the_same_and_survive_replay(spark):
    events = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1 + i % 5), "abc"[i % 3], float(i)) for i in range(60)] + [(None, "a", 1.0)],
        "ts timestamp_ntz, event_type string, value double")
    want = {tuple(r) for r in aggregates.event_counts(events).collect()}
    path = scratch_path(spark, "test-partials")
    parts = [events.where(F.coalesce(F.dayofmonth("ts") % 4, F.lit(0)) == n) for n in range(4)]

    def read():
        return {tuple(r) for r in aggregates.read_event_counts(spark, path).collect()}

    for n, part in enumerate(parts):
        sinks.write_batch_log(aggregates.event_counts(part), path, n)
        if n:
            aggregates.fold(spark, path, n - 1)
            sinks.write_batch_log(aggregates.event_counts(parts[n - 1]), path, n - 1)  # a replayed batch
    assert read() == want
    aggregates.fold(spark, path, 3)
    assert read() == want
    kept = {r[0] for r in spark.read.parquet(path).select("batch_id").distinct().collect()}
    assert kept == {3}  # what the fold before held is gone


def test_events_without_a_time_are_counted(spark, small_dir, tmp_path):
    events = spark.read.parquet(f"{small_dir}/events.parquet")
    events.withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.col("ts"))).write.parquet(f"{tmp_path}/events.parquet")
    out = catalog.REGISTRY["events_late_files"](spark, str(tmp_path))
    assert out.agg(F.sum("events")).first()[0] == events.count()
    assert out.where("event_date IS NULL").agg(F.sum("events")).first()[0] == events.where("event_id % 10 = 0").count()


def test_first_stream_batch_into_an_empty_versioned_table(spark, small_dir):
    from tessera.streaming import claims

    t = Tables(spark, small_dir)
    landing = scratch_path(spark, "landing")
    batch = sc.claim_batch(sc.claims(t))
    sc.claim_payloads(batch, t).select("claim_json").write.text(landing)
    dims = {"dim_patient": b.dim_patient(t), "dim_provider": b.dim_provider(t), "dim_procedure": b.dim_procedure(t),
            "dim_diagnosis": b.dim_diagnosis(t), "fact_encounter": b.fact_encounter(t)}
    target = sinks.versioned_table(spark, "fact_claim")
    claims.run_claims_stream(spark, landing, scratch_path(spark, "ckpt"), target, dims).awaitTermination()
    assert target.read().count() == batch.count()
