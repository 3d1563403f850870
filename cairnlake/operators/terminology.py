"""Code systems, value sets and membership in three states.

A code is valid if it is in the set, invalid if the set is loaded and complete
and hasn't it, else unknown. Null codes are unknown; repeated entries count
once; of several headers of one set any incomplete one makes it incomplete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def membership(asked: DataFrame, expansion: DataFrame, headers: DataFrame) -> DataFrame:
    """``asked`` (valueset, code[, system]) with ``status`` and the entry's ``display``."""
    on = ["valueset", "code"] + (["system"] if "system" in asked.columns else [])
    entries = expansion.groupBy(*on).agg(F.min("display").alias("display"), F.lit(True).alias("_hit"))
    loaded = expansion.select("valueset").distinct().withColumn("_loaded", F.lit(True))
    full = headers.groupBy(F.col("url").alias("valueset")).agg(F.bool_and(F.coalesce("complete", F.lit(True))).alias("_full"))
    j = asked.join(entries, on, "left").join(loaded, "valueset", "left").join(full, "valueset", "left")
    status = F.when(F.col("_hit"), "valid").when(F.col("code").isNull() | F.col("_loaded").isNull() | (F.col("_full") == F.lit(False)), "unknown").otherwise("invalid")
    return j.withColumn("status", status).drop("_hit", "_loaded", "_full")


def lookup(asked: DataFrame, concepts: DataFrame) -> DataFrame:
    """``asked`` (system, code) with the concept's display and status."""
    c = concepts.groupBy("system", "code").agg(F.min("display").alias("display"), F.lit(True).alias("_hit"))
    known = concepts.select("system").distinct().withColumn("_known", F.lit(True))
    j = asked.join(c, ["system", "code"], "left").join(known, "system", "left")
    return j.withColumn("status", F.when(F.col("_hit"), "valid").when(F.col("_known"), "invalid").otherwise("unknown")).drop("_hit", "_known")


def expand(expansion: DataFrame, valueset: str, needle: str | None = None, offset: int = 0, limit: int = 1000) -> DataFrame:
    """A page of a value set, codes or displays containing the needle (any case; % is a plain character)."""
    rows = expansion.where(F.col("valueset") == valueset)
    if needle:
        n = needle.lower()
        rows = rows.where(F.lower("code").contains(n) | F.coalesce(F.lower("display").contains(n), F.lit(False)))
    return rows.select("system", "code", "display").distinct().orderBy("code", "system").offset(offset).limit(limit)


def compose(concepts: DataFrame, include: list[DataFrame], exclude: list[DataFrame] | None = None) -> DataFrame:
    """Value-set algebra on (system, code): the union of the includes without the excludes."""
    out = include[0].select("system", "code")
    for x in include[1:]:
        out = out.unionByName(x.select("system", "code"))
    out = out.distinct()
    for x in exclude or []:
        out = out.join(x.select("system", "code").distinct(), ["system", "code"], "left_anti")
    return out.join(concepts.groupBy("system", "code").agg(F.min("display").alias("display")), ["system", "code"], "left")


def system_headers(concepts: DataFrame) -> DataFrame:
    """Concepts per code system."""
    return concepts.groupBy(F.col("system").alias("url")).agg(F.count_distinct("code").alias("count"))


def flatten_concepts(nested: DataFrame, levels: int = 8) -> DataFrame:
    """(system, code, display) of concept trees held as JSON (``system``, ``json``), at any depth up to ``levels``."""
    v = F.try_parse_json("json")
    cur = nested.select("system", F.explode(F.try_variant_get(v, "$.concept", "array<variant>")).alias("c"))
    row = lambda df: df.select("system", F.try_variant_get("c", "$.code", "string").alias("code"), F.try_variant_get("c", "$.display", "string").alias("display"))
    out = row(cur)
    for _ in range(levels - 1):
        cur = cur.select("system", F.explode(F.try_variant_get("c", "$.concept", "array<variant>")).alias("c"))
        out = out.unionByName(row(cur))
    return out


def read_loinc(spark: SparkSession, path: str) -> DataFrame:
    """Active concepts of a LOINC table: the long name, else the short one, else the code."""
    df = spark.read.csv(path, header=True, quote='"', escape='"')
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    ok = blank("LOINC_NUM").isNotNull() & (F.coalesce(blank("STATUS"), F.lit("ACTIVE")) == "ACTIVE")
    return df.where(ok).select(F.lit("http://loinc.org").alias("system"), F.col("LOINC_NUM").alias("code"), F.coalesce(blank("LONG_COMMON_NAME"), blank("SHORTNAME"), F.col("LOINC_NUM")).alias("display"))


# Fixed value: the type of fully specified names in the SNOMED CT release format.
FULL_NAME = "900000000000003001"


def read_snomed(spark: SparkSession, concepts: str, descriptions: str) -> DataFrame:
    """Active concepts with their first active full name, else their id."""
    tsv = lambda p: spark.read.csv(p, header=True, sep="\t", quote="")
    names = tsv(descriptions).where((F.col("active") == "1") & (F.col("typeId") == FULL_NAME)).groupBy("conceptId").agg(F.min_by("term", "id").alias("term"))
    c = tsv(concepts).where("active = '1'").select(F.col("id").alias("conceptId")).distinct()
    return c.join(names, "conceptId", "left").select(F.lit("http://snomed.info/sct").alias("system"), F.col("conceptId").alias("code"), F.coalesce("term", "conceptId").alias("display"))


def read_rxnorm(spark: SparkSession, path: str) -> DataFrame:
    """English RxNorm names, the first row (by atom id) of each concept."""
    df = spark.read.csv(path, sep="|", quote="")
    rows = df.select(F.col("_c0").alias("code"), F.col("_c1").alias("lat"), F.col("_c7").alias("atom"), F.col("_c11").alias("sab"), F.col("_c14").alias("display")).where("sab = 'RXNORM' and lat = 'ENG'")
    w = Window.partitionBy("code").orderBy("atom")
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(F.lit("http://www.nlm.nih.gov/research/umls/rxnorm").alias("system"), "code", "display")


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """Resources of a folder of JSON files: resource_type, url, json."""
    df = spark.read.text(path, wholetext=True).select(F.col("value").alias("json"), F.try_parse_json("value").alias("v"))
    return df.where("v is not null").select(F.try_variant_get("v", "$.resourceType", "string").alias("resource_type"), F.try_variant_get("v", "$.url", "string").alias("url"), "json").where("resource_type is not null")


def expansion_pages(pages: DataFrame) -> DataFrame:
    """(valueset, system, code, display) of saved expansion pages (``url``, ``json``)."""
    shape = "struct<expansion:struct<contains:array<struct<system:string,code:string,display:string>>>>"
    return pages.select(F.col("url").alias("valueset"), F.inline(F.from_json("json", shape)["expansion"]["contains"]))


def status_split(validated: DataFrame, error: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows by ``status``: (accepted, dead letters with their error cut to 1500 characters, pending)."""
    dead = validated.where("status = 'invalid'").withColumn("error", F.left(error if error is not None else F.lit("invalid"), F.lit(1500)))
    return validated.where("status = 'valid'"), dead, validated.where("status = 'unknown'")
