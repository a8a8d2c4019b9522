"""Loads of large batches: lookups by row, joins and rewrites in turns, and what
they leave on disk."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F
from test_load_volume import claims_folder, plan

from tessera.operators import merge, sinks
from tessera.plans import loads
from tessera.session import scratch_path, scratch_root
from tessera.sources import ingest
from tessera.sources import scenarios as sc
from tessera.sources.tables import Tables


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def in_turns(monkeypatch):
    monkeypatch.setattr(sinks, "TURN_BYTES", 1)


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_a_step_leaves_no_shuffle_files_and_no_settings(spark):
    before = {k: spark.conf.get(k, None) for k in sinks.STEP_CONF}
    old = shuffle_files(spark)
    sinks.land_text(spark.range(1000).repartition(4, "id").select(F.col("id").cast("string")), scratch_path(spark, "landed"))
    until = time.time() + 20
    while shuffle_files(spark) - old and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - old
    assert {k: spark.conf.get(k, None) for k in sinks.STEP_CONF} == before


def claims_and_dims(spark):
    names = ["patient_id", "rendering_npi", "procedure_code", "primary_icd10", "encounter_id"]
    keys = [("a", "n", "p", "d", "e"), ("a", "n", "p", "d", None), ("b", "n", "p", "d", "e"), ("a", None, "p", "d", "e"),
            ("a", "n", "q", "d", "e"), ("a", "n", "p", "x", "e"), ("a", "m", "p", "d", "f"), (None,) * 5] * 3
    at = dt.datetime(2024, 1, 1)
    fields = [f"{n} {t}" for n, t in ingest.CLAIM_FIELDS if n not in names]
    schema = ", ".join([*(f"{n} string" for n in names), *fields, "file_name string", "loaded_at timestamp_ntz", "_bad_fields int"])
    parsed = spark.createDataFrame([(*k, f"C{i}", i % 4, "2024-01-01", None, *[None] * 4, i, "Paid", None, "f", at, 0)
                                    for i, k in enumerate(keys)], schema)
    parsed = parsed.withColumns({c: F.col(c).cast("date") for c in ingest.DATE_FIELDS})
    make = spark.createDataFrame
    dims = {"dim_patient": make([("a", 1, True), ("a", 2, False), (None, 3, True)], "patient_id string, patient_key long, is_current_record boolean"),
            "dim_provider": make([("n", 1, True), ("m", 2, True), ("m", 3, True)], "npi string, provider_key long, is_current_record boolean"),
            "dim_procedure": make([("p", 1)], "procedure_code string, procedure_key long"),
            "dim_diagnosis": make([("d", 1), (None, 2)], "icd10_code string, diagnosis_key long"),
            "fact_encounter": make([("e", 1)], "encounter_id string, encounter_key long")}
    return parsed, dims


def test_lookups_by_row_find_what_joins_find(spark, in_turns):
    """Repeated and null keys on both sides, in two turns of files."""
    parsed, dims = claims_and_dims(spark)
    expected = rows(loads.join_claim_dims(parsed, dims))
    assert len(expected) == 27 and any("provider" in x for x in expected)
    path, out = (scratch_path(spark, n) for n in ("parsed", "joined"))
    stored = sinks.store(parsed.repartition(4).withColumn(loads.CLAIM_ROW, F.monotonically_increasing_id()), path)
    assert len(sinks.dealt_files(spark, path, 2)) == 2
    assert rows(loads.join_claim_dims(stored, dims, loads.CLAIM_ROW).drop(loads.CLAIM_ROW)) == expected
    assert rows(loads.store_claim_join(spark, path, dims, out)) == expected
    assert not os.path.exists(path.replace("file:", ""))


def test_payloads_are_shuffled_once_for_all_lookups(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parsed, dims = claims_and_dims(spark)
        wide = [x for x in plan(loads.join_claim_dims(parsed.withColumn("_row", F.monotonically_increasing_id()), dims, "_row"))
                .split("\n") if "Exchange hashpartitioning(_row" in x]
        assert len(wide) == 6  # the payloads, and the keys that five lookups found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_version_merged_in_turns(spark, in_turns):
    t = Tables(spark, claims_folder(spark))
    target = sinks.materialize(sc.claims(t).union(sc.claims(t).withColumn("claim_id", F.lit(None).cast("string"))), "target")
    batch = target.withColumn("paid_amount", F.col("paid_amount") + 1).withColumn("claim_status", F.lit("Adjusted"))
    later = batch.withColumn("claim_id", F.concat("claim_id", F.lit("x")))
    path = scratch_path(spark, "batch")
    batch = sinks.store(batch.union(later).select(*target.columns).withColumn("paid_amount", F.col("paid_amount").cast("decimal(14,2)"))
                        .withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp_ntz")), path)
    merged = loads.merge_claims(target, batch, dedup_order=["loaded_at"], action_col="_action")
    counts = {r._action: r.n for r in merged.groupBy("_action").agg(F.count("*").alias("n")).collect()}
    fact = sinks.versioned_table(spark, "fact_claim")
    fact.commit(target)
    assert loads.commit_merged_claims(fact, batch, path, counted=True) == {k: counts[k] for k in ("updated", "inserted")}
    assert fact.current_version() == 2 and rows(fact.read()) == rows(merged.drop("_action"))


@pytest.mark.parametrize("ordered", [True, False])
def test_partitions_merged_in_turns(spark, in_turns, ordered):
    """Repeated and null keys, keys that moved, null partitions: the rows of the
    plain merge, new rows numbered without gaps, the batch's folder gone."""
    base = spark.createDataFrame([(1, 2020, "a", 1), (1, 2021, "b", 2), (None, 2020, "n", 3), (4, None, "d", 4), (5, 2022, "e", 5)],
                                 "k long, yr int, v string, line_key long")
    table = sinks.partitioned_table(spark, "t", ["yr"])
    table.create(base)
    made = [(1, 2022, "x", 1), (1, 2022, "y", 2), (None, 2020, "z", 1), (6, 2023, "s", 1), (7, 2023, "t", 1), (8, None, "u", 1), (4, 2020, "w", 1)]
    made = made if ordered else [r for r in made if r[2] != "x"]
    path = scratch_path(spark, "batch")
    batch = sinks.store(spark.createDataFrame(made, "k long, yr int, v string, loaded_at int").repartition(3), path)
    order = ["loaded_at"] if ordered else None
    expected = rows(merge.upsert(base.drop("line_key"), batch, ["k"], update_cols=["v"], dedup_order=order))
    assert merge.upsert_partitions(table, batch, ["k"], surrogate_key="line_key", dedup_order=order, batch_path=path) == 5
    assert rows(table.read().select("k", "yr", "v")) == expected
    assert sorted(r.line_key for r in table.read().collect()) == list(range(1, 10))
    assert not os.path.exists(path.replace("file:", ""))


def test_only_listed_partitions_are_read(spark):
    table = sinks.partitioned_table(spark, "t", ["yr", "mon"])
    table.create(spark.createDataFrame([(y, m, f"{y}{m}") for y in (1, 2, None) for m in (1, 2, None)], "yr int, mon int, v string"))
    some = [(1, 2), (1, None), (None, 1)]
    assert rows(table.read_partitions(some).select("yr", "mon")) == sorted(f"Row(yr={y}, mon={m})" for y, m in some)
    assert table.not_in_partitions(table.read(), some).count() == 6
    assert "Join" not in plan(table.read_partitions(some))


def test_the_stored_claims_are_the_target_of_all(spark):
    t = Tables(spark, claims_folder(spark))
    expected = rows(sc.claim_target(sc.claims(t)))
    assert rows(sc.stored_claims(t)) == expected and expected


def test_dates_as_the_formatter_reads_them(spark):
    texts = ["2024-02-29", "2023-02-29", "0000-01-01", "2024-1-02", " 2024-01-02", "2024-01-02\n", "12024-01-02", "+2024-01-02",
             "2024-01-02T00", "-024-01-02", "", "x", "9999-12-31", "0001-01-01", "2024-01-2 "]
    lines = [ingest_line(x) for x in texts]
    landing = spark.createDataFrame([(x,) for x in lines], "j string").select(F.parse_json("j").alias("claim_json"))
    typed = ingest.project_claims(landing).select("claim_id", F.col("service_date").cast("string"))
    got = {r.claim_id: r.service_date for r in typed.collect()}
    plain = spark.createDataFrame([(x,) for x in texts], "t string").select("t", F.try_to_date("t", "yyyy-MM-dd").cast("string").alias("d"))
    assert got == {r.t: r.d for r in plain.collect()}


def ingest_line(text):
    import json
    return json.dumps({"claim_id": text, "claim_line_number": 1, "service_date": text})


def test_a_streamed_batch_leaves_no_intermediates(spark, small_dir):
    from tessera import catalog
    root = scratch_root(spark).replace("file:", "")
    names = ("claims_parsed*", "claims_batch_*", "partition_batch*", "keyed*", "partition_merge*")
    seen = {n: set(glob.glob(os.path.join(root, n))) for n in names}
    assert catalog.REGISTRY["claims_stream_batches"](spark, small_dir).count()
    assert {n: set(glob.glob(os.path.join(root, n))) - seen[n] for n in names} == {n: set() for n in names}
