"""What the load jobs shuffle, parse and write per input row."""

import os

from pyspark.sql import functions as F

from tessera.operators import merge, sinks
from tessera.session import scratch_path
from tessera.sources import fhir, ingest
from tessera.sources import scenarios as sc
from tessera.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_claims_are_shuffled_once(spark, small_dir):
    """Lines and orders meet by order; duplicates collapse where they met."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(sc.claims(Tables(spark, small_dir))).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def claims_folder(spark):
    """Lines that repeat a key on both sides of the batch window, or lack a date."""
    days = [(1, 1, "1998-01-01"), (1, 1, "1999-05-05"), (1, 2, "1999-05-05"), (1, 2, "1998-01-01"), (2, 1, "1998-09-30"),
            (2, 1, None), (2, 2, None), (3, 1, "1998-10-01"), (3, 1, "1998-10-01"), (3, None, "1999-01-01"), (None, 1, "1999-01-01")]
    rows = [(o, p, 5 + p, n, 1.0 + p, 10.0 * p, 0.1, 0.1, "RNA"[p % 3], "OF"[p % 2], d) for p, (o, n, d) in enumerate(days)]
    path = scratch_path(spark, "claims_input")
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                "l_linestatus string, l_shipdate string").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, 7), (2, 8), (3, 9), (3, 10)], "o_orderkey long, o_custkey long").write.parquet(f"{path}/orders.parquet")
    return path


def test_the_batch_from_its_window_alone(spark):
    t = Tables(spark, claims_folder(spark))
    whole = sorted(map(str, sc.claim_batch(sc.claims(t)).collect()))
    assert sorted(map(str, sc.landed_claims(t).collect())) == whole and len(whole) == 4


def test_landed_text_is_compressed_and_read_back(spark):
    lines = [f'{{"claim_id":"C{i}","claim_status":"Paid"}}' for i in range(5000)]
    path = scratch_path(spark, "landed")
    sinks.land_text(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(lines)
    assert 4 * sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path)) < sum(map(len, lines))


def raw_lines(spark, lines):
    return spark.createDataFrame([(x, "f") for x in lines], "value string, file_name string").withColumn(
        "loaded_at", F.lit("2024-01-01").cast("timestamp_ntz"))


def test_a_landed_line_is_parsed_once(spark):
    lines = ["[null, 1, {}]", "null", "[]", ' [{"claim_id":"c"}]', "x{", "  ", "7", None]
    landing, bad = ingest.landing_from_text(raw_lines(spark, lines))
    assert sorted(r.j for r in landing.select(F.to_json("claim_json").alias("j")).collect()) == [
        "1", "7", "null", "null", '{"claim_id":"c"}', "{}"]
    assert [r.raw_record for r in bad.collect()] == ["x{"]
    assert plan(landing).count("parseJson") == 1


def test_a_filter_on_claim_fields_extracts_the_payload_once(spark):
    landing, _ = ingest.landing_from_text(raw_lines(spark, ['{"claim_id":"a","claim_line_number":1}', '{"claim_id":"b"}']))
    good = ingest.project_claims(landing).where("_bad_fields = 0")
    assert plan(good).count("try_variant_get(claim_json") == 1
    assert [r.claim_id for r in good.collect()] == ["a"]


def test_bundles_take_one_scan_of_the_lines_and_one_parse(spark, small_dir):
    assert plan(sc.bundle_lines(Tables(spark, small_dir))).count("FileScan parquet") == 3
    entries = plan(fhir.entries(raw_lines(spark, ["{}"]).drop("loaded_at")))
    assert entries.count("parseJson") == 1 and "schema_of_variant" not in entries and "schemaOfVariant" not in entries


def test_text_fields_of_any_kind_are_no_rejects(spark):
    line = ('{"resourceType":"Bundle","id":"B","entry":[{"resource":{"resourceType":"Patient","id":{"a":1},"gender":[1]}},'
            '{"resource":{"resourceType":"Patient","id":"p","birthDate":{"x":1}}}]}')
    found = fhir.Bundles.load(raw_lines(spark, [line]).drop("loaded_at"))
    assert [(r.patient_id, r.gender) for r in found.table("Patient").collect()] == [('{"a":1}', "[1]")]
    assert [(r.pos, r.reason) for r in found.rejects().collect()] == [(1, "bad_field:birth_date")]


def test_append_new_joins_the_keys_as_stored(spark):
    source, target = (spark.createDataFrame(rows, "id long, x string") for rows in ([(1, "a"), (2, "b"), (2, "c"), (None, "d")], [(1, "z"), (1, "y")]))
    new = merge.append_new(source, target, "id")
    assert sorted(map(str, new.collect())) == sorted(["Row(id=2, x='b')", "Row(id=2, x='c')", "Row(id=None, x='d')"])
    assert "Aggregate" not in plan(new)
