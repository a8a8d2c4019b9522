"""Clinical message bundles (X11): nested JSON -> several target tables.

A landed line is one FHIR-style ``Bundle``: a JSON object whose ``entry`` array
holds resources of different types (Patient, Encounter, Claim ...), nested in
their turn (a claim's ``item`` array).  The lines are parsed once, to VARIANT;
``variant_explode`` turns a bundle into one row per entry in the task that
parsed it, and the entries are written once, partitioned by resource type.
Each target table then reads its own partition only and projects typed columns
(a claim's lines by a second explode).

Rejects are per entry: a bad resource does not cost the bundle its other
entries.  Reasons: ``malformed_json`` (no JSON), ``not_a_bundle``,
``no_entries``, ``no_resource`` (an entry that is no object with a
resource), ``unknown_type``, ``missing_id``, and ``bad_field:<name>`` (a value
that is there and does not cast to its column's type).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Target columns per resource type: name, path in the resource, type.
PATIENT = (("patient_id", "$.id", "string"), ("family_name", "$.name[0].family", "string"),
           ("given_name", "$.name[0].given[0]", "string"), ("gender", "$.gender", "string"),
           ("birth_date", "$.birthDate", "date"), ("postal_code", "$.address[0].postalCode", "string"))
ENCOUNTER = (("encounter_id", "$.id", "string"), ("patient_ref", "$.subject.reference", "string"),
             ("class_code", "$.class.code", "string"), ("admit_date", "$.period.start", "date"),
             ("discharge_date", "$.period.end", "date"), ("provider_npi", "$.participant[0].individual.identifier.value", "string"),
             ("disposition", "$.hospitalization.dischargeDisposition.text", "string"))
CLAIM = (("claim_id", "$.id", "string"), ("patient_ref", "$.patient.reference", "string"),
         ("encounter_ref", "$.encounter[0].reference", "string"), ("total_billed", "$.total.value", "decimal(14,2)"))
#: Columns of one line of a claim, paths in the item.
CLAIM_ITEM = (("line_number", "$.sequence", "int"), ("procedure_code", "$.productOrService.coding[0].code", "string"),
              ("service_date", "$.servicedDate", "date"), ("quantity", "$.quantity.value", "int"),
              ("net_amount", "$.net.value", "decimal(14,2)"))
RESOURCES = {"Patient": PATIENT, "Encounter": ENCOUNTER, "Claim": CLAIM}


def _typed(value: str, fields: Sequence[tuple[str, str, str]]) -> list[Column]:
    return [F.try_variant_get(F.col(value), path, kind).alias(name) for name, path, kind in fields]


def _bad_field(value: str, fields: Sequence[tuple[str, str, str]]) -> Column:
    """The first field that is there (and no JSON null) but does not cast.  Any
    value casts to text: text fields are never bad, and what has no text is
    not there."""
    get = lambda path, kind: F.try_variant_get(F.col(value), path, kind)
    return F.coalesce(*[F.when(get(path, kind).isNull() & get(path, "string").isNotNull(), F.lit(name))
                        for name, path, kind in fields if kind != "string"])


def _exploded(rows: DataFrame, array: Column, keep: Sequence[str], pos: str, value: str) -> DataFrame:
    """One row per element of a VARIANT array."""
    rows = rows.select(F.struct(*keep).alias("kept"), array.alias("elements"))
    joined = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("elements").outer()))
    return joined.select("kept.*", F.col("pos").alias(pos), F.col("value").alias(value))


def entries(lines: DataFrame) -> DataFrame:
    """(value, file_name) lines -> one row per bundle entry: bundle_id, pos,
    resource_type, resource (VARIANT) and the reason if it is rejected.  Lines
    without entries give one rejected row."""
    get = lambda value, path, kind: F.try_variant_get(F.col(value), path, kind)
    # Each step takes the one before by plain columns, so that a line is parsed
    # and an entry looked into once.
    parsed = lines.where(F.trim("value") != "").select("value", "file_name", F.try_parse_json("value").alias("bundle"))
    parsed = parsed.select("value", "file_name", F.col("bundle").isNull().alias("broken"),
                           get("bundle", "$.id", "string").alias("bundle_id"), get("bundle", "$.resourceType", "string").alias("type"),
                           get("bundle", "$.entry", "array<variant>").alias("entry"))
    reason = (F.when(F.col("broken"), "malformed_json")
              .when(~F.col("type").eqNullSafe(F.lit("Bundle")), "not_a_bundle")  # what is no object has no type
              .when(F.coalesce(F.size("entry"), F.lit(0)) < 1, "no_entries"))
    parsed = parsed.select("value", "file_name", "bundle_id", "entry", reason.alias("line_reason"))
    # A rejected line is an entry of its own, so that one pass has all rows; the
    # others leave their text behind here.
    sound = F.col("line_reason").isNull()
    parsed = parsed.select("file_name", "bundle_id", "line_reason", F.when(~sound, F.col("value")).alias("value"),
                           F.when(sound, F.col("entry")).otherwise(F.array(F.lit(None).cast("variant"))).alias("entry"))
    out = parsed.select("file_name", "bundle_id", "line_reason", "value", F.posexplode_outer("entry").alias("pos", "element"))
    out = out.select("*", get("element", "$.resource", "variant").alias("resource"))
    out = out.select("*", get("resource", "$.resourceType", "string").alias("resource_type"),
                     get("resource", "$.id", "string").isNull().alias("no_id"))
    known = F.col("resource_type").isin(*RESOURCES)
    checks = F.coalesce(F.col("line_reason"), F.when(F.col("resource_type").isNull(), "no_resource"),
                        F.when(~known, "unknown_type"), F.when(F.col("no_id"), "missing_id"))
    for name, fields in RESOURCES.items():
        bad = F.when(F.col("resource_type") == name, _bad_field("resource", fields))
        checks = F.coalesce(checks, F.concat(F.lit("bad_field:"), bad))
    out = out.select("*", checks.alias("reason"))
    passed = F.col("reason").isNull()
    raw = F.when(F.col("line_reason").isNotNull(), F.col("value")).otherwise(F.to_json("element"))
    return out.select("bundle_id", "pos", "file_name", "reason", F.when(passed, F.col("resource")).alias("resource"),
                      F.when(~passed, raw).alias("raw_entry"),
                      F.when(passed, F.col("resource_type")).otherwise("rejected").alias("kind"))


class Bundles:
    """Landed bundles, parsed and split once; ``path`` holds the entries, one
    folder per kind."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def load(cls, lines: DataFrame, path: str | None = None) -> "Bundles":
        spark = lines.sparkSession
        path = path or scratch_path(spark, "bundle_entries")
        entries(lines).write.mode("errorifexists").partitionBy("kind").parquet(path)
        return cls(spark, path)

    def of(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(self.path).where(F.col("kind") == kind)

    def table(self, resource_type: str) -> DataFrame:
        """Typed rows of a resource type, with the bundle they came in."""
        return self.of(resource_type).select("bundle_id", *_typed("resource", RESOURCES[resource_type]))

    def claim_lines(self) -> DataFrame:
        """One row per item of each claim; items that do not cast are in
        ``rejected_lines``."""
        return self._items().where(F.col("reason").isNull()).drop("reason", "raw_entry")

    def rejected_lines(self) -> DataFrame:
        return self._items().where(F.col("reason").isNotNull()).select("bundle_id", "claim_id", "item_pos", "reason", "raw_entry")

    def _items(self) -> DataFrame:
        claims = self.of("Claim").select("bundle_id", F.try_variant_get(F.col("resource"), "$.id", "string").alias("claim_id"),
                                         F.try_variant_get(F.col("resource"), "$.item", "variant").alias("item"))
        items = _exploded(claims, F.col("item"), ["bundle_id", "claim_id"], "item_pos", "line")
        bad = F.coalesce(F.when(F.try_variant_get(F.col("line"), "$.sequence", "variant").isNull(), "missing_sequence"),
                         F.concat(F.lit("bad_field:"), _bad_field("line", CLAIM_ITEM)))
        return items.select("bundle_id", "claim_id", "item_pos", *_typed("line", CLAIM_ITEM), bad.alias("reason"),
                            F.to_json("line").alias("raw_entry"))

    def rejects(self) -> DataFrame:
        return self.of("rejected").select("bundle_id", "pos", "file_name", "reason", "raw_entry")


def patients(bundles: Bundles) -> DataFrame:
    """The patient dimension's rows: a patient sent in several bundles once,
    the values of the last bundle (by id)."""
    rows = bundles.table("Patient")
    fields = [c for c in rows.columns if c not in ("bundle_id", "patient_id")]
    last = F.max(F.struct("bundle_id", *fields)).alias("last")
    return rows.groupBy("patient_id").agg(last, F.count(F.lit(1)).alias("times_sent")).select(
        "patient_id", *[F.col(f"last.{c}").alias(c) for c in fields], "times_sent")
