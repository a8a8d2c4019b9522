"""Before/after states for the load jobs, derived from the driver tables.

A load needs a current table and an incoming batch.  Both are carved out of
the same driver data by attributes (balance sign, service dates, extract
times), so every scenario grows with the data and can be rebuilt by an
independent SQL engine.  The rules are listed in FIXTURES.md section 3.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import ts_lit
from tessera.operators.dedup import latest_per_key
from tessera.sources import bindings as b
from tessera.sources.tables import Tables

# ── SCD2 (M10) ───────────────────────────────────────────────────────────
SCD2_EFFECTIVE = _dt.date(2024, 1, 1)
SCD2_NOW = _dt.datetime(2024, 1, 1, 2, 0, 0)


def scd2_target(t: Tables) -> DataFrame:
    """Patients already in the dimension: customers with a non-negative
    balance (the others are new registrations in the staging batch)."""
    known = t.customer.where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("patient_key"))
    return b.dim_patient(t).join(known, "patient_key", "left_semi")


def scd2_staging(t: Tables) -> DataFrame:
    """Today's extract of every patient; every tenth changed payer."""
    p = b.patient_attributes(t.customer)
    payer = F.when(F.col("patient_key") % 10 == 0, F.lit("MEDICAID")).otherwise(F.col("payer_type"))
    return p.select(
        "patient_id", "first_name", "last_name", "date_of_birth", "gender", "race", "ethnicity",
        "zip_code", "state_code", payer.alias("payer_type"),
        F.lit("crm").alias("source_system"),
        ts_lit(SCD2_NOW - _dt.timedelta(hours=1)).alias("extracted_at"))


# ── claims upsert (M8) ───────────────────────────────────────────────────
CLAIM_TARGET_BEFORE = _dt.date(1999, 1, 1)
CLAIM_BATCH_FROM = _dt.date(1998, 10, 1)

CLAIM_COLUMNS = ["claim_id", "claim_line_number", "encounter_key", "patient_key",
                 "rendering_provider_key", "service_date", "service_date_key", "paid_date_key",
                 "procedure_key", "primary_diagnosis_key", "billed_amount", "allowed_amount",
                 "paid_amount", "patient_responsibility", "units_of_service", "claim_status",
                 "denial_reason_code"]


def claim_lines_with_patient(t: Tables, since: _dt.date | None = None, before: _dt.date | None = None) -> DataFrame:
    """Every claim line with the patient key (duplicates of the driver's
    non-unique (order, line) key included); with ``since`` those of that
    service date or later; with ``before`` those that are not of an earlier
    date have their key and date alone.  Lines are joined as read: the wider
    claim columns are made behind the shuffle."""
    lines = t.lineitem
    if before is not None:
        early = F.to_date("l_shipdate") < F.lit(before)
        lines = lines.select(*[c if c in ("l_orderkey", "l_linenumber", "l_shipdate") else F.when(early, F.col(c)).alias(c)
                               for c in lines.columns])
    if since is not None:
        lines = lines.where(F.to_date("l_shipdate") >= F.lit(since))
    x = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return b.claim_lines(x, F.col("o_custkey").alias("patient_key")).select(*CLAIM_COLUMNS)


def claims(t: Tables, since: _dt.date | None = None, before: _dt.date | None = None) -> DataFrame:
    """Claim lines with the patient key, one row per (claim, line).

    The driver's (order, line) key is not unique; duplicates collapse to the
    row with the greatest (service date, payload) tuple.  A claim is an order:
    keyed by it, lines that were shuffled to meet their order stay where they
    are.  ``since`` leaves out the keys whose latest line is older, which are
    those that have no line as late (or only lines without a date)."""
    return latest_per_key(claim_lines_with_patient(t, since, before), ["encounter_key", "claim_line_number"],
                          ["service_date"])


def landed_claims(t: Tables) -> DataFrame:
    """``claim_batch`` of all claims, from the lines of its window alone."""
    return claim_batch(claims(t, CLAIM_BATCH_FROM))


def claim_target(c: DataFrame) -> DataFrame:
    return c.where(F.col("service_date") < F.lit(CLAIM_TARGET_BEFORE))


def stored_claims(t: Tables) -> DataFrame:
    """``claim_target`` of all claims.  Later lines only hide their key's
    earlier ones: of them the key and the date are moved."""
    return claim_target(claims(t, before=CLAIM_TARGET_BEFORE))


def claim_batch(c: DataFrame) -> DataFrame:
    """Lines from the batch window (overlapping the target by a quarter),
    with late adjustments: first lines of paid claims are re-adjudicated,
    second lines get a new or first denial code."""
    batch = c.where(F.col("service_date") >= F.lit(CLAIM_BATCH_FROM))
    line1_paid = (F.col("claim_line_number") == 1) & (F.col("claim_status") == "Paid")
    line2 = F.col("claim_line_number") == 2
    ten = F.lit(10).cast("decimal(14,2)")
    return batch.select(
        *[c for c in CLAIM_COLUMNS if c not in ("paid_amount", "claim_status",
                                                 "denial_reason_code")],
        F.when(line1_paid, (F.col("paid_amount") - ten).cast("decimal(14,2)"))
         .otherwise(F.col("paid_amount")).alias("paid_amount"),
        F.when(line1_paid, F.lit("Adjusted")).otherwise(F.col("claim_status")).alias("claim_status"),
        F.when(line2 & (F.col("claim_status") == "Denied"), F.lit("CO-97"))
         .when(line2 & (F.col("claim_status") == "Paid"), F.lit("N1"))
         .otherwise(F.col("denial_reason_code")).alias("denial_reason_code"),
    ).select(*CLAIM_COLUMNS)


def claim_adjustments(batch: DataFrame) -> list[DataFrame]:
    """The batch, then late adjustments: second lines are paid five less and
    change status, then first lines two more."""
    def paid(line: int, by: int) -> DataFrame:
        return (batch.where(F.col("claim_line_number") == line)
                .withColumn("paid_amount", (F.col("paid_amount") + by).cast("decimal(14,2)"))
                .withColumn("claim_status", F.lit("Adjusted")).select(*CLAIM_COLUMNS))

    return [batch, paid(2, -5), paid(1, 2)]


def claim_payloads(batch: DataFrame, t: Tables) -> DataFrame:
    """The batch as landing payloads: natural keys instead of surrogate
    keys, dates as text, serialised as JSON (one object per claim line)."""
    part = t.part.select(F.col("p_partkey").alias("primary_diagnosis_key"),
                         b.icd10_for(b.brand_number(F.col("p_brand")), F.col("p_partkey"))
                         .alias("primary_icd10"))
    x = batch.join(part, "primary_diagnosis_key")
    payload = F.struct(
        F.col("claim_id"), F.col("claim_line_number"),
        F.concat(F.lit("E"), F.col("encounter_key").cast("string")).alias("encounter_id"),
        F.concat(F.lit("P"), F.col("patient_key").cast("string")).alias("patient_id"),
        b.npi_for(F.col("rendering_provider_key")).alias("rendering_npi"),
        F.date_format("service_date", "yyyy-MM-dd").alias("service_date"),
        F.date_format(F.when(F.col("paid_date_key").isNotNull(),
                             F.date_add("service_date", 30)), "yyyy-MM-dd").alias("paid_date"),
        F.concat(F.lit("CPT"), F.col("procedure_key").cast("string")).alias("procedure_code"),
        F.col("primary_icd10"),
        "billed_amount", "allowed_amount", "paid_amount", "patient_responsibility",
        "units_of_service", "claim_status", "denial_reason_code")
    return x.select(F.year("service_date").alias("service_year"),
                    F.to_json(payload).alias("claim_json"))


# ── encounter append (M9) ────────────────────────────────────────────────
ENCOUNTER_TARGET_BEFORE = _dt.date(2001, 1, 1)
ENCOUNTER_RAW_FROM = _dt.date(2000, 12, 25)
ENCOUNTER_LOAD_AT = _dt.datetime(2001, 9, 1, 2, 0, 0)


def encounter_target(t: Tables) -> DataFrame:
    return b.fact_encounter(t).where(F.col("admit_date") < F.lit(ENCOUNTER_TARGET_BEFORE))


def encounters_raw(t: Tables) -> DataFrame:
    """Source extract with natural keys; extract times spread over the two
    days before the load, so the one-day watermark keeps about half."""
    fe = b.fact_encounter(t).where(F.col("admit_date") >= F.lit(ENCOUNTER_RAW_FROM))
    part = t.part.select(F.col("p_partkey").alias("primary_diagnosis_key"),
                         b.icd10_for(b.brand_number(F.col("p_brand")), F.col("p_partkey"))
                         .alias("primary_icd10_code"))
    x = fe.join(part, "primary_diagnosis_key")
    return x.select(
        "encounter_id",
        F.concat(F.lit("P"), F.col("patient_key").cast("string")).alias("patient_id"),
        b.npi_for(F.col("attending_provider_key")).alias("attending_npi"),
        "primary_icd10_code", "encounter_type", "admit_source", "discharge_disposition",
        "admit_date", "discharge_date", F.col("icu_days").cast("long").alias("icu_days"),
        "total_charges", "total_payments", "readmission_30d_flag", "mortality_flag",
        F.timestamp_add("HOUR", -(F.col("encounter_key") % 48).cast("int"),
                        ts_lit(ENCOUNTER_LOAD_AT)).alias("extracted_at"))


# ── encounter run (M16) ──────────────────────────────────────────────────
ENCOUNTER_RUN_AT = _dt.datetime(2002, 1, 2, 2, 0, 0)


def sound_encounters(rows: DataFrame) -> DataFrame:
    """No discharge before its admission."""
    return rows.withColumn("discharge_date", F.greatest("discharge_date", "admit_date"))


def encounter_lines(rows: DataFrame) -> DataFrame:
    """Encounter extracts as landing lines."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


# ── message bundles (X11) ────────────────────────────────────────────────
def bundle_lines(t: Tables) -> DataFrame:
    """One message bundle per encounter: its patient, the encounter and a claim
    with its lines, as nested JSON.  By the encounter's key some are flawed:
    cut off (43rd), a patient without id (37th), an admission that is no date
    (41st), a resource of a type without a table (31st), an entry that is no
    resource (29th), a quantity in words (third lines of every 11th)."""
    def resource(kind: str, *fields) -> Column:
        return F.to_json(F.struct(F.struct(F.lit(kind).alias("resourceType"), *fields).alias("resource")))

    def ref(kind: str, id_col) -> Column:
        return F.concat(F.lit(f"{kind}/"), id_col)

    k = F.col("encounter_key")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    person = ["patient_id", "first_name", "last_name", "date_of_birth", "gender", "zip_code"]
    patients = b.patient_attributes(t.customer).select(F.col("patient_key").alias("_patient"), *person)
    item = F.struct(
        F.col("claim_line_number").alias("sequence"),
        F.struct(F.array(F.struct(F.concat(F.lit("CPT"), F.col("procedure_key").cast("string")).alias("code"))).alias("coding"))
        .alias("productOrService"),
        day("service_date").alias("servicedDate"),
        F.struct(F.when((F.col("claim_line_number") == 3) & (k % 11 == 0), "many")
                 .otherwise(F.col("units_of_service").cast("string")).alias("value")).alias("quantity"),
        F.struct(F.col("billed_amount").alias("value")).alias("net"))
    # Lines of one claim meet in their message, as they would when it is sent:
    # shuffled once, as read, for the claim and for the encounter.
    claims = b.claim_lines(t.lineitem.repartition("l_orderkey")).groupBy(k.alias("l_orderkey")).agg(
        F.min("rendering_provider_key").alias("attending_provider_key"), F.min("procedure_key").alias("primary_diagnosis_key"),
        F.collect_list(item).alias("items"), F.sum("billed_amount").cast("decimal(14,2)").alias("billed"))
    x = b.fact_encounter(t, t.orders.join(patients, F.col("o_custkey") == F.col("_patient")), claims, [*person, "items", "billed"])
    entries = F.concat_ws(
        ",",
        resource("Patient", F.when(k % 37 != 0, F.col("patient_id")).alias("id"),
                 F.array(F.struct(F.col("last_name").alias("family"), F.array("first_name").alias("given"))).alias("name"),
                 "gender", day("date_of_birth").alias("birthDate"),
                 F.array(F.struct(F.col("zip_code").alias("postalCode"))).alias("address")),
        resource("Encounter", F.col("encounter_id").alias("id"), F.struct(ref("Patient", F.col("patient_id")).alias("reference")).alias("subject"),
                 F.struct(F.col("encounter_type").alias("code")).alias("class"),
                 F.struct(F.when(k % 41 == 0, "n/a").otherwise(day("admit_date")).alias("start"), day("discharge_date").alias("end"))
                 .alias("period"),
                 F.array(F.struct(F.struct(F.struct(b.npi_for(F.col("attending_provider_key")).alias("value")).alias("identifier"))
                                  .alias("individual"))).alias("participant"),
                 F.struct(F.struct(F.col("discharge_disposition").alias("text")).alias("dischargeDisposition"))
                 .alias("hospitalization")),
        resource("Claim", F.concat(F.lit("C"), k.cast("string")).alias("id"),
                 F.struct(ref("Patient", F.col("patient_id")).alias("reference")).alias("patient"),
                 F.array(F.struct(ref("Encounter", F.col("encounter_id")).alias("reference"))).alias("encounter"),
                 F.struct(F.col("billed").alias("value")).alias("total"), F.col("items").alias("item")),
        F.when(k % 31 == 0, resource("Device", F.concat(F.lit("D"), k.cast("string")).alias("id"))),
        F.when(k % 29 == 0, F.lit("7")))
    text = F.concat(F.lit('{"resourceType":"Bundle","id":"B'), k.cast("string"), F.lit('","entry":['), entries, F.lit("]}"))
    x = x.select(k, text.alias("text"))
    return x.select(F.when(k % 43 == 0, F.substring("text", 1, 60)).otherwise(F.col("text")).alias("value"))
