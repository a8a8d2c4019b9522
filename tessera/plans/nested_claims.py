"""Claims stored with their lines nested, and reports that read only the
leaves they need (X9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.nested import leaf, nest, total, total_where

LINE_FIELDS = ["service_date", "procedure_key", "rendering_provider_key", "billed_amount", "allowed_amount", "paid_amount",
               "units_of_service", "claim_status", "denial_reason_code"]
MONEY = "decimal(18,2)"


def store(claims: DataFrame, path: str, chunk: int = 1024) -> None:
    nest(claims, ["claim_id"], "claim_line_number", LINE_FIELDS, "lines", chunk).write.mode("errorifexists").parquet(path)


def claim_totals(nested: DataFrame) -> DataFrame:
    """Per claim: lines, billed and paid, paid on adjusted lines, whether any
    line was denied, and the distinct denial codes in order."""
    paid, status = leaf("lines", "paid_amount"), leaf("lines", "claim_status")
    codes = leaf("lines", "denial_reason_code")
    per_chunk = nested.select(
        "claim_id", F.size(status).alias("n_lines"), total(leaf("lines", "billed_amount"), MONEY).alias("billed"),
        total(paid, MONEY).alias("paid"), total_where(paid, status, ["Adjusted"], MONEY).alias("adjusted_paid"),
        F.exists(status, lambda s: s == "Denied").alias("any_denied"),
        F.array_distinct(F.filter(codes, lambda c: c.isNotNull())).alias("codes"))
    # Codes are a small fixed set; a claim's chunks add up.
    return per_chunk.groupBy("claim_id").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("billed").cast(MONEY).alias("billed"), F.sum("paid").cast(MONEY).alias("paid"),
        F.sum("adjusted_paid").cast(MONEY).alias("adjusted_paid"), F.coalesce(F.bool_or("any_denied"), F.lit(False)).alias("any_denied"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("codes")))), ",").alias("denial_codes"))


def status_mix(nested: DataFrame) -> DataFrame:
    """Lines and money paid per status: two leaves, added up inside each row
    for the statuses it holds (a null status is one), then over the rows."""
    status = leaf("lines", "claim_status")
    lines = F.arrays_zip(status.alias("s"), leaf("lines", "paid_amount").alias("paid"))

    def added_up(s: Column) -> Column:
        own = F.filter(lines, lambda x: x["s"].eqNullSafe(s))
        return F.struct(s.alias("claim_status"), F.size(own).alias("n"),
                        total(F.transform(own, lambda x: x["paid"]), MONEY).alias("paid"))

    rows = nested.select(F.inline(F.transform(F.array_distinct(status), added_up)))
    return rows.groupBy("claim_status").agg(F.sum("n").alias("n_lines"), F.sum("paid").cast(MONEY).alias("paid"))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
