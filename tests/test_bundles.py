"""Nested message bundles: split, rejects per entry, pruned reads (X11)."""

import json

import pytest

from tessera.sources import fhir


def bundle(*entries, **fields):
    return json.dumps({"resourceType": "Bundle", **fields, "entry": list(entries)})


PATIENT = {"resource": {"resourceType": "Patient", "id": "p1", "birthDate": "1990-01-02", "name": [{"family": "F", "given": ["G"]}]}}
CLAIM = {"resource": {"resourceType": "Claim", "id": "c1", "item": [
    {"sequence": 1, "net": {"value": 1.25}}, {"sequence": 2, "net": {"value": "x"}}, 7, {"net": {"value": 2}}]}}


@pytest.fixture(scope="module")
def loaded(spark):
    lines = [bundle(PATIENT, CLAIM, 5, {"resource": {"resourceType": "Patient"}}, {"resource": {"resourceType": "Dog", "id": "d"}},
                    {"resource": {"resourceType": "Patient", "id": "p2", "birthDate": "199x"}}, {"a": 1}, None, id="b1"),
             bundle(id="b2"), '{"resourceType":"Bundle","id":"b3"}', '{"resourceType":"Bundle","id":"b4","entry":{"a":1}}',
             "[1,2]", "nope{", "", "  ", "7", "null", '{"resourceType":"Patient","id":"p9"}',
             bundle({"resource": {**PATIENT["resource"], "gender": None, "birthDate": None}}, PATIENT, id="b5"), None]
    return fhir.Bundles.load(spark.createDataFrame([(x, "f1") for x in lines], "value string, file_name string"))


def test_rejects_are_per_entry(loaded):
    got = sorted((r.bundle_id or "", r.pos, r.reason) for r in loaded.rejects().collect())
    assert got == sorted([
        ("b1", 2, "no_resource"), ("b1", 3, "missing_id"), ("b1", 4, "unknown_type"), ("b1", 5, "bad_field:birth_date"),
        ("b1", 6, "no_resource"), ("b1", 7, "no_resource"), ("b2", 0, "no_entries"), ("b3", 0, "no_entries"),
        ("b4", 0, "no_entries"), ("", 0, "not_a_bundle"), ("", 0, "malformed_json"), ("", 0, "not_a_bundle"),
        ("", 0, "not_a_bundle"), ("p9", 0, "not_a_bundle")])
    assert all(r.raw_entry for r in loaded.rejects().collect() if r.pos != 7)


def test_good_entries_of_a_bad_bundle_stay(loaded):
    assert [(r.bundle_id, r.patient_id, str(r.birth_date), r.family_name) for r in loaded.table("Patient").orderBy("bundle_id", "birth_date")
            .collect()] == [("b1", "p1", "1990-01-02", "F"), ("b5", "p1", "None", "F"), ("b5", "p1", "1990-01-02", "F")]
    assert [(r.claim_id, r.line_number, float(r.net_amount)) for r in loaded.claim_lines().collect()] == [("c1", 1, 1.25)]
    assert sorted((r.item_pos, r.reason) for r in loaded.rejected_lines().collect()) == [
        (1, "bad_field:net_amount"), (2, "missing_sequence"), (3, "missing_sequence")]
    assert fhir.patients(loaded).collect()[0].times_sent == 3


def test_targets_read_their_partition_and_no_shuffle_splits_them(loaded):
    plan = loaded.table("Patient")._jdf.queryExecution().executedPlan().toString()
    assert "kind" in plan.split("PartitionFilters:")[1].split("]")[0] and "Exchange" not in plan


def test_no_lines(spark):
    none = fhir.Bundles.load(spark.createDataFrame([], "value string, file_name string"))
    assert none.path
