"""Write, audit, publish over the encounter fact and the patient dimension."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import sinks
from tessera.plans import load_runs, quality
from tessera.session import scratch_path
from tessera.sources import bindings as b
from tessera.sources import scenarios as sc
from tessera.sources.tables import Tables


@pytest.fixture()
def run(spark, small_dir):
    t = Tables(spark, small_dir)
    tables = {n: sinks.versioned_table(spark, n) for n in ("fact", "dim", "rejects")}
    tables["dim"].commit(sc.scd2_target(t))
    tables["fact"].commit(sc.sound_encounters(sc.encounter_target(t)).join(
        tables["dim"].read().select("patient_key"), "patient_key", "left_semi"))
    dims = {"dim_provider": b.dim_provider(t), "dim_diagnosis": b.dim_diagnosis(t)}

    def go(rows, stg=None):
        landing = scratch_path(spark, "landing")
        (rows if rows.columns == ["value"] else sc.encounter_lines(rows)).write.text(landing)
        return load_runs.run_encounters_load(
            spark, landing, sc.scd2_staging(t) if stg is None else stg, tables["fact"], tables["dim"], dims, "r",
            sc.ENCOUNTER_RUN_AT, tables["rejects"]).first()

    return t, tables, go


def state(tables):
    return {n: (t.current_version(), t.read().count() if t.read() is not None else None) for n, t in tables.items()}


def test_a_failing_check_leaves_both_tables_as_they_were(run):
    t, tables, go = run
    raw = sc.sound_encounters(sc.encounters_raw(t))
    before = state(tables)
    got = go(raw.withColumn("discharge_date", F.date_sub("admit_date", 1)))
    assert (got.status, got.failed_step) == ("FAILED", "quality_gate") and state(tables) == before
    got = go(raw)
    assert got.status == "SUCCESS"
    after = state(tables)
    assert after["dim"][1] > before["dim"][1] and after["fact"][1] > before["fact"][1]
    # Patients that the run itself added: their encounters wait for the next one.
    waiting = after["rejects"][1]
    assert waiting and tables["rejects"].read().select("missing_dimension").distinct().collect()[0][0] == "patient"
    assert go(raw.limit(0)).status == "SUCCESS"
    again = state(tables)
    assert again["fact"][1] == after["fact"][1] + waiting and again["rejects"][1] == 0
    assert tables["fact"].read().join(tables["dim"].read(), "patient_key", "left_anti").count() == 0


def test_pair_check_finds_orphans_duplicates_and_lost_keys(run, spark):
    t, tables, go = run
    fact, dim = tables["fact"].read(), tables["dim"].read()
    some = dim.where(F.col("patient_key") % 2 == 0)
    twice = some.unionByName(some.limit(1))
    failed = {r.check_name: r.records_failed for r in quality.check_pair(fact, twice, dim).collect()}
    assert failed["encounter_patient_key_resolves"] == fact.where("patient_key % 2 = 1").count() > 0
    assert failed["patient_current_record_unique"] == 1 and failed["patient_key_kept"] == dim.count() - some.count()
    assert {r.records_failed for r in quality.check_pair(fact, dim, dim).collect()} == {0}


def test_bad_lines_do_not_stop_the_run(run, spark):
    t, tables, go = run
    lines = sc.encounter_lines(sc.sound_encounters(sc.encounters_raw(t))).unionByName(
        spark.createDataFrame([("nope{",), ('{"encounter_id":"Q1","admit_date":"n/a"}',), ('{"a":1}',)], "value string"))
    got = go(lines)
    assert got.status == "SUCCESS" and tables["fact"].read().where("encounter_id = 'Q1'").count() == 0


def test_staged_versions_are_nobodys_current_state(spark):
    table = sinks.versioned_table(spark, "staged")
    table.commit(spark.range(3))
    v = table.stage(spark.range(5))
    assert table.read().count() == 3 and table.read_version(v).count() == 5
    assert table.commit(spark.range(7)) == v + 1 and table.read().count() == 7
    w = table.stage(spark.range(9))
    table.publish(w)
    assert table.read().count() == 9
