"""Promotion of raw versions: current rows (gold) and flat rows (silver).

Gold is the current version of each live resource, merged by key. Silver keeps
scalars as typed columns and complex elements as JSON text (or, nested, as
structs to a depth). Deleted resources stay in silver with their flag; a
chunked variant that skips them is ``keep_deleted=False``. All of it is narrow
but for the version ranking (see changefeed). Broken and null bodies give rows
with null elements, so nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.operators import changefeed

PRIMITIVES = {"boolean": T.BooleanType(), "integer": T.IntegerType(), "positiveInt": T.IntegerType(), "unsignedInt": T.IntegerType(), "decimal": T.DoubleType()}


def schema_of(elements: dict, depth: int = 3) -> T.StructType:
    """The struct of element definitions: name to a type name, ``[x]`` for a list, a dict for a complex element.

    Beyond ``depth`` levels a complex element is JSON text; unknown primitives are text.
    """

    def field(kind: object, left: int) -> T.DataType:
        if isinstance(kind, list):
            return T.ArrayType(field(kind[0], left))
        if isinstance(kind, dict):
            return schema_of(kind, left - 1) if left > 1 else T.StringType()
        return PRIMITIVES.get(str(kind), T.StringType())

    return T.StructType([T.StructField(n, field(k, depth)) for n, k in elements.items()])


def gold(bronze: DataFrame) -> DataFrame:
    """The current version of each live resource."""
    return changefeed.current_rows(bronze)


def merge_gold(before: DataFrame, changes: DataFrame) -> DataFrame:
    """Gold after further changes; replaying the same changes gives the same."""
    return changefeed.apply_changes(before, changes)


def silver(bronze: DataFrame, resource_type: str, elements: dict[str, str], body: str = "body_json", keep_deleted: bool = True) -> DataFrame:
    """Governance columns and one column per top-level element: scalars typed, complex ones as JSON text."""
    now = changefeed.latest(bronze.where(F.col("resource_type") == resource_type))
    if not keep_deleted:
        now = now.where(~F.coalesce("deleted", F.lit(False)))
    v = now.select("resource_type", "id", "version_id", "deleted", F.try_parse_json(body).alias("_v"))

    def element(name: str, kind: str) -> Column:
        at = f"$.{name}"
        if kind in PRIMITIVES:
            return F.try_variant_get("_v", at, PRIMITIVES[kind].simpleString())
        return F.try_variant_get("_v", at, "string") if kind != "json" else F.to_json(F.try_variant_get("_v", at, "variant"))

    return v.select(F.concat_ws("/", "resource_type", "id", F.col("version_id").cast("string")).alias("silver_id"), F.col("id").alias("fhir_id"), "version_id", F.coalesce("deleted", F.lit(False)).alias("deleted"), *[element(n, k).alias(n) for n, k in elements.items()])


def silver_nested(bronze: DataFrame, resource_type: str, elements: dict, depth: int = 3, body: str = "body_json") -> DataFrame:
    """As ``silver``, complex elements as nested structs."""
    now = changefeed.latest(bronze.where(F.col("resource_type") == resource_type))
    return now.select("id", "version_id", F.coalesce("deleted", F.lit(False)).alias("deleted"), F.from_json(body, schema_of(elements, depth)).alias("_s")).select("id", "version_id", "deleted", "_s.*")


def apply_merges(patients: DataFrame, decisions: DataFrame) -> DataFrame:
    """Patients after identity merges: the survivor gains the merged one's index entries and a link to it; the merged one is inactive and not current, and stays readable.

    ``patients``: id, active, is_current, index (array). ``decisions``: survivor, merged.
    """
    d = decisions.where("survivor is not null").select("survivor", "merged")
    gained = d.join(patients.select(F.col("id").alias("merged"), F.col("index").alias("more")), "merged").groupBy("survivor").agg(F.flatten(F.sort_array(F.collect_list("more"))).alias("more"), F.sort_array(F.collect_list("merged")).alias("replaces"))
    j = patients.join(gained.withColumnRenamed("survivor", "id"), "id", "left").join(d.select(F.col("merged").alias("id"), F.lit(True).alias("_out")).distinct(), "id", "left")
    out = F.col("_out").isNotNull()
    return j.select("id", F.when(out, False).otherwise(F.col("active")).alias("active"), F.when(out, False).otherwise(F.col("is_current")).alias("is_current"), F.array_distinct(F.concat("index", F.coalesce("more", F.expr("array()")))).alias("index"), "replaces")


def schema_drift(pinned: DataFrame, live: DataFrame) -> DataFrame:
    """Keys (key, hash) that were added, removed or changed between a pin and now."""
    j = pinned.select("key", F.col("hash").alias("p")).join(live.select("key", F.col("hash").alias("l")), "key", "full_outer")
    state = F.when(F.col("p").isNull(), "added").when(F.col("l").isNull(), "removed").when(F.col("p") != F.col("l"), "changed")
    return j.withColumn("drift", state).where("drift is not null").select("key", "drift")


def lineage_edges(tables: DataFrame) -> DataFrame:
    """Edges between tiers (bronze, silver, gold) of one table name."""
    rank = F.element_at(F.create_map(F.lit("bronze"), F.lit(1), F.lit("silver"), F.lit(2), F.lit("gold"), F.lit(3)), F.col("tier"))
    t = tables.select("name", "tier").distinct().withColumn("r", rank)
    return t.alias("a").join(t.alias("b"), (F.col("a.name") == F.col("b.name")) & (F.col("b.r") == F.col("a.r") + 1)).select(F.col("a.name").alias("name"), F.col("a.tier").alias("from_tier"), F.col("b.tier").alias("to_tier"))
