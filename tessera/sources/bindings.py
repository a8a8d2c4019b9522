"""Driver tables -> the warehouse shapes the jobs work on.

The driver ships TPC-H-like tables; the jobs expect a clinical star schema
and a product event model.  Each function here is one lazy projection/join
over the driver Parquet, so Catalyst prunes columns and pushes filters into
the scans.  Every derived attribute is a deterministic expression of the
source row (documented in FIXTURES.md section 3), which is what lets an
independent SQL engine rebuild the same rows for parity checks.

Size notes for the joins below: ``nation`` and ``region`` are fixed-size code
tables (25 and 5 rows), broadcast explicitly.  Everything else is joined on
keys and left to AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import date_key, patient_row_hash
from tessera.sources.tables import Tables

OPEN_END = "9999-12-31"
DIM_EFFECTIVE = "1995-01-01"


def _lit_date(s: str) -> Column:
    return F.lit(s).cast("date")


def _ts_plus_hours(ts: Column, hours: Column | int) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_add("HOUR", h, ts)


# ── clinical dimensions ──────────────────────────────────────────────────
def patient_attributes(customer: DataFrame) -> DataFrame:
    """Tracked patient attributes derived from a customer row."""
    k = F.col("c_custkey")
    return customer.select(
        k.alias("patient_key"),
        F.concat(F.lit("P"), k.cast("string")).alias("patient_id"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        F.date_add(_lit_date("1940-01-01"), ((k * 37) % 25000).cast("int")).alias("date_of_birth"),
        F.when(k % 200 == 0, F.lit(None).cast("string"))
         .when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.lit(None).cast("string").alias("race"),
        F.lit(None).cast("string").alias("ethnicity"),
        F.lpad(((k * 7919) % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_code"),
        F.col("c_mktsegment").alias("payer_type"),
    )


def dim_patient(t: Tables) -> DataFrame:
    p = patient_attributes(t.customer)
    return p.select(
        "*",
        _lit_date(DIM_EFFECTIVE).alias("effective_date"),
        _lit_date(OPEN_END).alias("expiration_date"),
        F.lit(True).alias("is_current_record"),
        patient_row_hash("first_name", "last_name", "date_of_birth", "gender",
                         "zip_code", "state_code", "payer_type").alias("row_hash"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def npi_for(suppkey: Column) -> Column:
    """10-digit NPI; every 25th provider gets a 9-digit (invalid) one."""
    s = suppkey.cast("string")
    return F.when(suppkey % 25 == 0, F.lpad(s, 9, "0")).otherwise(F.lpad(s, 10, "0"))


def dim_provider(t: Tables) -> DataFrame:
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))
    s = (t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return s.select(
        F.col("s_suppkey").alias("provider_key"),
        npi_for(F.col("s_suppkey")).alias("npi"),
        F.col("s_name").alias("provider_name"),
        F.col("r_name").alias("specialty"),
        F.col("n_name").alias("sub_specialty"),
        F.concat(F.col("n_name"), F.lit(" General")).alias("facility_name"),
        F.lit("Hospital").alias("facility_type"),
        F.col("n_name").alias("address_city"),
        F.col("r_name").alias("address_state"),
        (F.col("s_acctbal") >= 0).alias("is_in_network"),
        _lit_date(DIM_EFFECTIVE).alias("effective_date"),
        _lit_date(OPEN_END).alias("expiration_date"),
        F.lit(True).alias("is_current_record"),
    )


def brand_number(p_brand: Column) -> Column:
    return F.substring_index(p_brand, "#", -1).cast("int")


def icd10_for(brand: Column, partkey: Column) -> Column:
    """'E' + 2-digit brand + '.' + part key; brand 13 yields the invalid 'E1.'."""
    stem = F.when(brand == 13, F.lit("E1")).otherwise(
        F.concat(F.lit("E"), F.lpad(brand.cast("string"), 2, "0")))
    return F.concat(stem, F.lit("."), partkey.cast("string"))


def dim_diagnosis(t: Tables) -> DataFrame:
    b = brand_number(F.col("p_brand"))
    code = icd10_for(b, F.col("p_partkey"))
    return t.part.select(
        F.col("p_partkey").alias("diagnosis_key"),
        code.alias("icd10_code"),
        F.col("p_name").alias("icd10_description"),
        F.substring(code, 1, 3).alias("category_code"),
        F.col("p_type").alias("category_desc"),
        F.lit("IV").alias("chapter_code"),
        F.lit("Endocrine, nutritional and metabolic diseases").alias("chapter_desc"),
        (b % 2 == 0).alias("is_chronic"),
        F.concat(F.lit("HCC"), b.cast("string")).alias("cms_hcc_category"),
    )


def dim_procedure(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("procedure_key"),
        F.concat(F.lit("CPT"), F.col("p_partkey").cast("string")).alias("procedure_code"),
        F.lit("CPT").alias("code_type"),
        F.col("p_name").alias("procedure_desc"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("subcategory"),
        (F.col("p_size") > 25).alias("is_surgical"),
        (F.col("p_retailprice") / 100).cast("decimal(8,2)").alias("rvu_total"),
    )


def bridge_encounter_diagnosis(t: Tables) -> DataFrame:
    return (t.lineitem.groupBy("l_orderkey", "l_partkey")
            .agg(F.min("l_linenumber").alias("diagnosis_seq"))
            .select(F.col("l_orderkey").alias("encounter_key"),
                    F.col("l_partkey").alias("diagnosis_key"),
                    "diagnosis_seq",
                    F.lit("Y").alias("poa_indicator")))


# ── clinical facts ───────────────────────────────────────────────────────
def _order_lines(t: Tables) -> DataFrame:
    # Partial (map-side) aggregation: one row per order leaves each task.
    return t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("attending_provider_key"),
        F.min("l_partkey").alias("primary_diagnosis_key"))


def encounter_type_for(status: Column) -> Column:
    return (F.when(status == "F", "IP").when(status == "O", "OP")
            .when(status == "P", "ED").otherwise("Telehealth"))


def fact_encounter(t: Tables, orders: DataFrame | None = None, lines: DataFrame | None = None,
                   more: Sequence[str] = ()) -> DataFrame:
    """Partitioned-schema fact_encounter (carries admit/discharge dates).
    Callers that join more to the orders or their lines give both, by their
    keys, and the columns to keep."""
    k = F.col("o_orderkey")
    admit = F.to_date("o_orderdate")
    discharge = F.when(k % 97 == 0, F.date_sub(admit, 1)).otherwise(
        F.date_add(admit, (k % 10).cast("int")))
    etype = encounter_type_for(F.col("o_orderstatus"))
    charges = F.col("o_totalprice").cast("decimal(14,2)")
    o = (t.orders if orders is None else orders).join(_order_lines(t) if lines is None else lines, k == F.col("l_orderkey"))
    return o.select(
        k.alias("encounter_key"),
        F.col("o_custkey").alias("patient_key"),
        "attending_provider_key",
        admit.alias("admit_date"),
        discharge.alias("discharge_date"),
        date_key(admit).alias("admit_date_key"),
        date_key(discharge).alias("discharge_date_key"),
        "primary_diagnosis_key",
        F.concat(F.lit("E"), k.cast("string")).alias("encounter_id"),
        etype.alias("encounter_type"),
        F.col("o_orderpriority").alias("admit_source"),
        F.when(k % 50 == 0, "Expired").otherwise("Home").alias("discharge_disposition"),
        F.datediff(discharge, admit).alias("length_of_stay_days"),
        F.when(etype == "IP", (k % 3).cast("int")).otherwise(F.lit(0)).alias("icu_days"),
        charges.alias("total_charges"),
        F.round(charges * F.lit(0.85).cast("decimal(3,2)"), 2).cast("decimal(14,2)")
         .alias("total_payments"),
        (k % 7 == 0).alias("readmission_30d_flag"),
        (k % 50 == 0).alias("mortality_flag"),
        F.date_add(admit, 1).cast("timestamp_ntz").alias("created_at"),
        *more,
    )


def claim_status_for(flag: Column) -> Column:
    return (F.when(flag == "R", "Denied").when(flag == "A", "Adjusted")
            .when(flag == "N", "Paid").otherwise("Pending"))


def claim_lines(lineitem: DataFrame, *more: Column) -> DataFrame:
    """One claim line per lineitem row (natural key not unique: see dedup),
    with ``more`` columns of the rows given."""
    billed = F.col("l_extendedprice").cast("decimal(14,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    one = F.lit(1).cast("decimal(1,0)")
    service = F.to_date("l_shipdate")
    status = claim_status_for(F.col("l_returnflag"))
    return lineitem.select(
        F.concat(F.lit("C"), F.col("l_orderkey").cast("string")).alias("claim_id"),
        F.col("l_linenumber").alias("claim_line_number"),
        F.col("l_orderkey").alias("encounter_key"),
        F.col("l_suppkey").alias("rendering_provider_key"),
        service.alias("service_date"),
        date_key(service).alias("service_date_key"),
        F.when(status != "Denied", date_key(F.date_add(service, 30))).alias("paid_date_key"),
        F.col("l_partkey").alias("procedure_key"),
        F.col("l_partkey").alias("primary_diagnosis_key"),
        billed.alias("billed_amount"),
        F.round(billed * (one - disc), 2).cast("decimal(14,2)").alias("allowed_amount"),
        F.round(billed * (one - disc) * (one + tax), 2).cast("decimal(14,2)").alias("paid_amount"),
        F.round(billed * disc, 2).cast("decimal(14,2)").alias("patient_responsibility"),
        F.col("l_quantity").cast("int").alias("units_of_service"),
        status.alias("claim_status"),
        F.when(F.col("l_returnflag") == "R",
               F.concat(F.lit("CO-"), F.col("l_linestatus"))).alias("denial_reason_code"),
        *more,
    )


def fact_claim(t: Tables) -> DataFrame:
    return claim_lines(t.lineitem)


# ── product (event) model ────────────────────────────────────────────────
def _raw_event_type(event_type: Column, user_id: Column, event_id: Column) -> Column:
    base = (F.when(event_type == "signup", "signup")
            .when(event_type == "click",
                  F.when(user_id % 5 != 0, "feature_used").otherwise("page_view"))
            .when(event_type == "purchase",
                  F.when(user_id % 3 == 0, "upgrade").otherwise("page_view"))
            .when(event_type == "view",
                  F.when(event_id % 2 == 0, "page_view").otherwise("login"))
            .otherwise(event_type))
    # Source noise the staging model must clean: padding and upper case.
    return F.when(event_id % 7 == 0, F.concat(F.lit(" "), F.upper(base), F.lit(" "))).otherwise(base)


def raw_events(t: Tables) -> DataFrame:
    return raw_events_from(t.events)


def raw_events_from(e: DataFrame) -> DataFrame:
    """Raw product events from rows of the driver ``events`` table."""
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    raw_type = _raw_event_type(F.col("event_type"), uid, eid)
    return e.select(
        eid.cast("string").alias("event_id"),
        uid.cast("string").alias("user_id"),
        F.concat_ws("-", uid.cast("string"), F.date_format(ts, "yyyyMMdd"),
                    F.floor(F.hour(ts) / 4).cast("string")).alias("session_id"),
        raw_type.alias("event_type"),
        F.concat(F.lit("/app/"), F.col("event_type")).alias("page_url"),
        F.when(F.lower(F.trim(raw_type)) == "feature_used",
               F.concat(F.lit("feature_"), (eid % 10).cast("string"))).alias("feature_name"),
        (F.when(eid % 3 == 0, "web").when(eid % 3 == 1, " ios").otherwise("Android "))
        .alias("platform"),
        F.when(uid % 2 == 0, "desktop").otherwise("mobile").alias("device_type"),
        F.lpad((uid % 25).cast("string"), 2, "0").alias("country_code"),
        F.when(eid % 4 == 0, F.lit(" google ")).alias("utm_source"),
        F.when(eid % 4 == 0, F.lit("cpc")).alias("utm_medium"),
        F.lit(None).cast("string").alias("utm_campaign"),
        F.when(eid % 1000 == 999, F.lit(None).cast("timestamp_ntz")).otherwise(ts)
        .alias("occurred_at"),
        F.timestamp_add("MINUTE", F.lit(5), ts).alias("_loaded_at"),
        F.concat(F.lit("events/"), F.date_format(ts, "yyyy-MM-dd"), F.lit(".json"))
        .alias("_source_file"),
    )


def _raw_user_rows(customer: DataFrame, stale: bool) -> DataFrame:
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    plan = (F.when(seg == "BUILDING", "free").when(seg == "AUTOMOBILE", " Starter")
            .when(seg == "MACHINERY", "growth").when(seg == "HOUSEHOLD", "ENTERPRISE"))
    created = _ts_plus_hours(
        F.date_add(_lit_date("2023-12-01"), (k % 45).cast("int")).cast("timestamp_ntz"),
        (k % 24).cast("int"))
    updated = created if stale else F.timestamp_add("DAY", F.lit(1), created)
    return customer.select(
        k.cast("string").alias("user_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.com")).alias("email"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        (F.lit("free") if stale else plan).alias("plan_name"),
        F.lit("trial" if stale else "Active").alias("account_status"),
        (F.when(k % 3 == 0, "organic").when(k % 3 == 1, "Paid").otherwise("referral"))
        .alias("signup_source"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("country_code"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        _ts_plus_hours(updated, 1).alias("_loaded_at"),
    )


def raw_users(t: Tables) -> DataFrame:
    """Current user rows plus each user's previous version (signup-time
    plan and status), as a change-capture source delivers them."""
    c = t.customer
    return _raw_user_rows(c, stale=False).unionByName(_raw_user_rows(c, stale=True))


def raw_sessions(t: Tables) -> DataFrame:
    """Sessions derived from the event stream (user, day, 4-hour block)."""
    e = t.events
    uid, ts = F.col("user_id"), F.col("ts")
    sess = F.concat_ws("-", uid.cast("string"), F.date_format(ts, "yyyyMMdd"),
                       F.floor(F.hour(ts) / 4).cast("string"))
    g = (e.select(sess.alias("session_id"), uid, ts, F.col("event_id"), F.col("event_type"))
         .groupBy("session_id", "user_id")
         .agg(F.min("ts").alias("started_at"), F.max("ts").alias("last_ts"),
              F.min("event_id").alias("first_event"),
              F.count_if(F.col("event_type") == "view").alias("page_views"),
              F.count("*").alias("events_count")))
    return g.select(
        "session_id",
        F.col("user_id").cast("string").alias("user_id"),
        "started_at",
        F.when(F.col("user_id") % 10 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("last_ts")).alias("ended_at"),
        (F.when(F.col("first_event") % 3 == 0, "web").when(F.col("first_event") % 3 == 1, " ios")
         .otherwise("Android ")).alias("platform"),
        F.when(F.col("user_id") % 2 == 0, "desktop").otherwise("mobile").alias("device_type"),
        F.lpad((F.col("user_id") % 25).cast("string"), 2, "0").alias("country_code"),
        F.col("page_views").cast("int").alias("page_views"),
        F.col("events_count").cast("int").alias("events_count"),
        F.timestamp_add("MINUTE", F.lit(5), F.col("last_ts")).alias("_loaded_at"),
    )


def raw_subscriptions(t: Tables) -> DataFrame:
    """Subscription lifecycle events: sign-ups and purchases of the event
    stream, some with a repeated id, without a user, or of an unknown type."""
    eid = F.col("event_id")
    kinds = F.array(*[F.lit(k) for k in ("upgraded", "downgraded", "cancelled", "reactivated", "paused")])
    return t.events.where(F.col("event_type").isin("signup", "purchase")).select(
        F.concat(F.lit("S"), F.when(eid % 97 == 0, F.lit(0)).otherwise(eid).cast("string")).alias("subscription_id"),
        F.when(eid % 333 != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_type") == "signup", "created").otherwise(F.get(kinds, eid % 5)).alias("event_type"),
        F.col("ts").alias("occurred_at"), F.timestamp_add("MINUTE", F.lit(5), F.col("ts")).alias("_loaded_at"))
