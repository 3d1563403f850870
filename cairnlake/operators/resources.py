"""JSON resources and search indexes from the silver tables.

Repeated deliveries of a record (same fhir_id, same content) count once; the
row with the smallest silver_id is taken. ``to_json`` leaves out null fields,
so absent and null are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INDEX = "array<struct<code:string,system:string,value:string>>"


def once(df: DataFrame) -> DataFrame:
    """One row per fhir_id; rows without one are left out."""
    # One aggregate per column, so that those a query doesn't use are pruned down to the scan.
    order = F.coalesce("silver_id", F.lit(""))
    return df.where("fhir_id is not null").groupBy("fhir_id").agg(*[F.min_by(c, order).alias(c) for c in df.columns if c != "fhir_id"])


def _entry(code: str, value: Column, system: Column | None = None) -> Column:
    s = F.struct(F.lit(code).alias("code"), (system if system is not None else F.lit(None)).cast("string").alias("system"), value.cast("string").alias("value"))
    return F.when(value.isNotNull(), F.array(s)).otherwise(F.expr(f"cast(array() as {INDEX})"))


def _each(code: str, items: Column, value, system=None) -> Column:
    made = F.transform(items, lambda x: F.struct(F.lit(code).alias("code"), (system(x) if system else F.lit(None)).cast("string").alias("system"), value(x).cast("string").alias("value")))
    return F.coalesce(F.filter(made, lambda e: e["value"].isNotNull()), F.expr(f"cast(array() as {INDEX})"))


def patients(df: DataFrame) -> DataFrame:
    """Patient resources: resource_type, id, version_id, deleted, body_json, index."""
    body = F.to_json(F.struct(F.lit("Patient").alias("resourceType"), F.col("fhir_id").alias("id"), "active", "gender", "birthDate", "name", "address", "identifier", "managingOrganization"))
    index = F.concat(
        _entry("_id", F.col("fhir_id")),
        _each("family", F.col("name"), lambda n: F.lower(n["family"])),
        _each("given", F.flatten(F.transform("name", lambda n: F.coalesce(n["given"], F.expr("cast(array() as array<string>)")))), lambda g: F.lower(g)),
        _entry("gender", F.col("gender")), _entry("active", F.col("active")), _entry("birthdate", F.col("birthDate")),
        _each("identifier", F.col("identifier"), lambda i: i["value"], lambda i: i["system"]),
        _entry("organization", F.col("managingOrganization.reference")),
    )
    return once(df).select(F.lit("Patient").alias("resource_type"), F.col("fhir_id").alias("id"), "version_id", "deleted", F.col("governed_at"), body.alias("body_json"), index.alias("index"))


def observations(df: DataFrame) -> DataFrame:
    """Observation resources, as ``patients``."""
    body = F.to_json(F.struct(F.lit("Observation").alias("resourceType"), F.col("fhir_id").alias("id"), "status", "code", "subject", "effectiveInstant", "valueQuantity"))
    index = F.concat(
        _entry("_id", F.col("fhir_id")), _entry("status", F.col("status")),
        _each("code", F.col("code.coding"), lambda c: c["code"], lambda c: c["system"]),
        _entry("subject", F.col("subject.reference")), _entry("date", F.col("effectiveInstant")),
        _entry("value-quantity", F.col("valueQuantity.value"), F.col("valueQuantity.unit")),
    )
    return once(df).select(F.lit("Observation").alias("resource_type"), F.col("fhir_id").alias("id"), "version_id", "deleted", F.col("governed_at"), body.alias("body_json"), index.alias("index"))


def claims(df: DataFrame) -> DataFrame:
    """ClaimResponse resources."""
    body = F.to_json(F.struct(F.lit("ClaimResponse").alias("resourceType"), F.col("fhir_id").alias("id"), "status", "outcome", "created", "patient", "insurer", "item"))
    index = F.concat(_entry("_id", F.col("fhir_id")), _entry("status", F.col("status")), _entry("outcome", F.col("outcome")), _entry("patient", F.col("patient.reference")), _entry("insurer", F.col("insurer.reference")), _entry("created", F.col("created")))
    return once(df).select(F.lit("ClaimResponse").alias("resource_type"), F.col("fhir_id").alias("id"), "version_id", "deleted", F.col("governed_at"), body.alias("body_json"), index.alias("index"))


def organizations(df: DataFrame) -> DataFrame:
    """Organization resources."""
    body = F.to_json(F.struct(F.lit("Organization").alias("resourceType"), F.col("fhir_id").alias("id"), "name", "active", "partOf"))
    index = F.concat(_entry("_id", F.col("fhir_id")), _entry("name", F.lower("name")), _entry("active", F.col("active")), _entry("partof", F.col("partOf.reference")))
    return once(df).select(F.lit("Organization").alias("resource_type"), F.col("fhir_id").alias("id"), "version_id", "deleted", F.col("governed_at"), body.alias("body_json"), index.alias("index"))


def extract_identifiers(body: Column) -> Column:
    """Identifier index of a JSON body: system, value and the type's first code."""
    parsed = F.from_json(body, "struct<identifier:array<struct<system:string,value:string,type:struct<coding:array<struct<code:string>>>>>>")
    return F.transform(F.coalesce(parsed["identifier"], F.expr("array()")), lambda i: F.struct(i["system"].alias("system"), i["value"].alias("value"), F.get(i["type"]["coding"]["code"], 0).alias("typeCode")))


def bronze_row(df: DataFrame, source: str, now: str) -> DataFrame:
    """Version rows of new resources (body_json): ids and time stamped into columns and ``meta``."""
    v = F.try_parse_json("body_json")
    return df.select(
        F.try_variant_get(v, "$.id", "string").alias("id"), F.lit(1).cast("bigint").alias("version_id"), F.lit(now).alias("last_updated"), "body_json",
        extract_identifiers(F.col("body_json")).alias("identifier_index"), F.lit(False).alias("deleted"), F.lit(True).alias("is_current"), F.lit(now).alias("_ingested_at"), F.lit(source).alias("_ingest_source"),
    )


def uuid7(millis: Column, seed: Column) -> Column:
    """A time-ordered identifier (version 7) from a time and a seed, so it can be made again."""
    t, h = F.lpad(F.hex(millis), 12, "0"), F.sha2(seed.cast("string"), 256)
    raw = F.concat(F.left(t, F.lit(8)), F.lit("-"), F.substring(t, 9, 4), F.lit("-7"), F.substring(h, 1, 3), F.lit("-"), F.element_at(F.array(*map(F.lit, "89ab")), F.conv(F.substring(h, 4, 1), 16, 10).cast("int") % 4 + 1), F.substring(h, 5, 3), F.lit("-"), F.substring(h, 8, 12))
    return F.lower(raw)


def uuid7_millis(value: Column) -> Column:
    """The time of a version 7 identifier; null if it isn't one."""
    ok = value.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return F.when(ok, F.conv(F.left(F.replace(value, F.lit("-"), F.lit("")), F.lit(12)), 16, 10).cast("bigint"))
