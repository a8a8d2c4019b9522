"""Raw JSON landing (S1-S4, X7): stage files -> landing rows + rejects,
and the typed projection of a claim payload.

Two read modes:

* ``lines`` (default, splittable): newline-delimited JSON.  A bad line is
  rejected on its own and the load continues.
* ``documents``: one JSON document per file (an outer array is stripped so
  each element becomes a row).  A file is one task and a malformed file is
  rejected as a whole.

Payloads are parsed into Spark's VARIANT type, so the landing table keeps
the semi-structured value and the projection extracts typed fields with
``try_variant_get`` (a bad value becomes NULL plus a reject flag instead of
aborting the job under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Claim payload fields and their SQL types.
CLAIM_FIELDS = [
    ("claim_id", "string"),
    ("claim_line_number", "int"),
    ("encounter_id", "string"),
    ("patient_id", "string"),
    ("rendering_npi", "string"),
    ("service_date", "string"),
    ("paid_date", "string"),
    ("procedure_code", "string"),
    ("primary_icd10", "string"),
    ("billed_amount", "decimal(14,2)"),
    ("allowed_amount", "decimal(14,2)"),
    ("paid_amount", "decimal(14,2)"),
    ("patient_responsibility", "decimal(14,2)"),
    ("units_of_service", "int"),
    ("claim_status", "string"),
    ("denial_reason_code", "string"),
]
DATE_FIELDS = ("service_date", "paid_date")
PLAIN_DATE = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"

#: Fields of an encounter extract and their SQL types.
ENCOUNTER_FIELDS = [
    ("encounter_id", "string"), ("patient_id", "string"), ("attending_npi", "string"), ("primary_icd10_code", "string"),
    ("encounter_type", "string"), ("admit_source", "string"), ("discharge_disposition", "string"), ("admit_date", "date"),
    ("discharge_date", "date"), ("icu_days", "long"), ("total_charges", "decimal(14,2)"), ("total_payments", "decimal(14,2)"),
    ("readmission_30d_flag", "boolean"), ("mortality_flag", "boolean"), ("extracted_at", "timestamp_ntz"),
]


def landing_from_text(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``raw``: rows with ``value`` (text) and ``file_name``/``loaded_at``.

    Returns (landing rows with a VARIANT ``claim_json``, rejected rows)."""
    parsed = raw.where(F.trim("value") != "").select("*", F.try_parse_json("value").alias("_v"))
    # STRIP_OUTER_ARRAY: one landing row per element of a top-level array, any
    # other value is its own.  Every line is parsed once: what is no JSON gives
    # a null row, dropped behind the explode (a JSON null is no SQL null).
    elements = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.array("_v"))
    landing = (parsed.select("file_name", "loaded_at", F.explode_outer(elements).alias("claim_json"))
               .where(F.col("claim_json").isNotNull()).select("claim_json", "file_name", "loaded_at"))
    rejects = parsed.where(F.col("_v").isNull()).select(F.col("value").alias("raw_record"), "file_name", "loaded_at",
                         F.lit("malformed_json").alias("reason"))
    return landing, rejects


def read_stage(spark: SparkSession, path: str, mode: str = "lines") -> tuple[DataFrame, DataFrame]:
    """Load every file under ``path``; keep source files; return
    (landing rows, rejected records).  ``rows_loaded`` is ``landing.count()``
    or an ``observe`` metric on the write."""
    reader = spark.read.format("text")
    if mode == "documents":
        reader = reader.option("wholetext", "true")
    raw = reader.load(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("loaded_at"))
    return landing_from_text(raw)


def project_claims(landing: DataFrame) -> DataFrame:
    """Typed columns from the VARIANT payload, plus ``_bad_fields`` (the
    number of present-but-uncastable fields, one more without a claim id or
    line number, as for a payload that is no object) for the reject path.
    The status is normalised here (F2): later filters compare plain values.

    One extraction of the whole object as text fields, then one cast per
    field.  The fields come out of a generator, behind which a later filter on
    them stays: through a projection it would be pushed down with an extraction
    of the whole object for every field it names."""
    text_struct = ", ".join(f"`{n}`: string" for n, _ in CLAIM_FIELDS).replace(": ", " ")
    extra = [c for c in ("file_name", "loaded_at") if c in landing.columns]
    fields = F.try_variant_get(F.col("claim_json"), "$", f"struct<{text_struct}>")
    raw = landing.select(F.inline_outer(F.array(fields)), *extra)
    raw = raw.select(*[F.col(n).alias(f"_raw_{n}") for n, _ in CLAIM_FIELDS], *extra)
    typed_cols = []
    for name, typ in CLAIM_FIELDS:
        r = F.col(f"_raw_{name}")
        # Plain digits need no formatter, which takes most of a date's time.
        typed = (F.when(r.rlike(PLAIN_DATE), r.try_cast("date")).otherwise(F.try_to_date(r, "yyyy-MM-dd"))
                 if name in DATE_FIELDS else r.try_cast(typ))
        typed_cols.append(typed.alias(name))
    typed = raw.select(*[F.col(f"_raw_{n}") for n, _ in CLAIM_FIELDS], *typed_cols, *extra)
    bad = sum((F.when(F.col(f"_raw_{n}").isNotNull() & F.col(n).isNull(), 1).otherwise(0)
               for n, _ in CLAIM_FIELDS), F.lit(0))
    bad = bad + F.when(F.col("claim_id").isNull() | F.col("claim_line_number").isNull(), 1).otherwise(0)
    status = F.initcap(F.trim("claim_status")).alias("claim_status")
    return typed.select(*[status if n == "claim_status" else n for n, _ in CLAIM_FIELDS], *extra,
                        bad.alias("_bad_fields"))


def project_encounters(landing: DataFrame) -> DataFrame:
    """Typed columns of an encounter extract, plus ``_bad_fields`` as for
    claims (the encounter id must be there)."""
    text = ", ".join(f"`{n}` string" for n, _ in ENCOUNTER_FIELDS)
    raw = landing.select(F.try_variant_get(F.col("claim_json"), "$", f"struct<{text}>").alias("_t"), "file_name", "loaded_at")
    raw = raw.select(*[F.col(f"_t.{n}").alias(f"_raw_{n}") for n, _ in ENCOUNTER_FIELDS], "file_name", "loaded_at")
    typed = raw.select("*", *[F.col(f"_raw_{n}").try_cast(kind).alias(n) for n, kind in ENCOUNTER_FIELDS])
    bad = sum((F.when(F.col(f"_raw_{n}").isNotNull() & F.col(n).isNull(), 1).otherwise(0) for n, _ in ENCOUNTER_FIELDS),
              F.when(F.col("encounter_id").isNull(), 1).otherwise(0))
    return typed.select(*[n for n, _ in ENCOUNTER_FIELDS], "file_name", "loaded_at", bad.alias("_bad_fields"))
