"""Nested claims: bounded arrays, pruned leaves, sketches."""

import random

from pyspark.sql import functions as F

from tessera.operators import nested, quantiles
from tessera.plans import nested_claims
from tessera.sources import bindings as b
from tessera.sources.tables import Tables


def lines(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", f"c{i % 9}"]), rng.choice([i, i, 5, None]), rng.choice([None, 1.25, 7.0]),
             rng.choice(["Paid", "Denied", "Adjusted", "Other", None]), rng.choice([None, "CO-1", "CO-2"])) for i in range(900)]
    return spark.createDataFrame(rows, "claim_id string, claim_line_number int, paid double, claim_status string, code string").select(
        "claim_id", "claim_line_number", F.lit(None).cast("date").alias("service_date"), F.lit(1).alias("procedure_key"),
        F.lit(1).alias("rendering_provider_key"), F.lit(2).cast("decimal(14,2)").alias("billed_amount"),
        F.lit(1).cast("decimal(14,2)").alias("allowed_amount"), F.col("paid").cast("decimal(14,2)").alias("paid_amount"),
        F.lit(1).alias("units_of_service"), "claim_status", F.col("code").alias("denial_reason_code"))


def test_chunks_bound_the_arrays_and_add_up(spark, tmp_path):
    flat = lines(spark).cache()
    for chunk in (8, 1024):
        path = f"{tmp_path}/nested{chunk}"
        nested_claims.store(flat, path, chunk)
        rows = nested_claims.read(spark, path)
        assert rows.agg(F.sum(F.size("lines"))).first()[0] == 900
        mix = {tuple(r) for r in nested_claims.status_mix(rows).collect()}
        assert mix == {tuple(r) for r in flat.groupBy("claim_status").agg(
            F.count("*"), F.sum("paid_amount").cast("decimal(18,2)")).collect()}
        got = {tuple(r) for r in nested_claims.claim_totals(rows).collect()}
        want = flat.groupBy("claim_id").agg(
            F.count("*"), F.sum("billed_amount").cast("decimal(18,2)"), F.sum("paid_amount").cast("decimal(18,2)"),
            F.coalesce(F.sum(F.when(F.col("claim_status") == "Adjusted", F.col("paid_amount"))), F.lit(0)).cast("decimal(18,2)"),
            F.coalesce(F.bool_or(F.col("claim_status") == "Denied"), F.lit(False)),
            F.array_join(F.array_sort(F.collect_set("denial_reason_code")), ","))
        assert got == {tuple(r) for r in want.collect()}
    per = spark.read.parquet(f"{tmp_path}/nested8").where("claim_id = 'hot' AND chunk > 10").agg(F.max(F.size("lines"))).first()[0]
    assert per <= 8


def test_only_used_leaves_are_read(spark, small_dir, tmp_path):
    path = f"{tmp_path}/nested"
    nested_claims.store(b.fact_claim(Tables(spark, small_dir)), path)
    plan = nested_claims.status_mix(nested_claims.read(spark, path))._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "lines:array<struct<paid_amount" in schema and "claim_status" in schema
    assert not any(c in schema for c in ("billed_amount", "procedure_key", "claim_id", "service_date"))
    assert "Generate explode(lines" not in plan


def test_sums_skip_nulls(spark):
    df = spark.sql("SELECT array(1.5D, null, 2D) a, cast(array() AS array<double>) e, array(null) n, array('x', 'x', 'y') f")
    row = df.select(nested.total(F.col("a"), "double"), nested.total(F.col("e"), "double"), nested.total(F.col("n"), "double"),
                    nested.total_where(F.col("a"), F.col("f"), ["x"], "double")).first()
    assert tuple(row) == (3.5, None, None, 1.5)


def test_merged_sketches_answer_within_their_error(spark):
    df = spark.range(200_000).selectExpr("id % 3 AS g", "date_add(date'2024-01-01', int(id % 40)) AS day",
                                         "CASE WHEN id % 1000 > 0 THEN pow(rand(3), 4) * 1e6 END AS v").cache()
    daily = quantiles.daily_sketches(df, ["g"], "day", "v")
    assert daily.count() == 120
    found = quantiles.quantiles(quantiles.period_sketches(daily, ["g"]), ["g"], [0.01, 0.5, 0.99])
    checked = quantiles.rank_bounds(df, found, ["g"], "v").collect()
    assert len(checked) == 9
    for r in checked:
        assert r.share_below - quantiles.rank_error() <= r.share <= r.share_upto + quantiles.rank_error()
