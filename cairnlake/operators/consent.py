"""Label and consent filters as columns, and member matching.

Null labels are none; a null context is denied by default; ``provisions``
without labels, actors or purposes are open in that respect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Confidentiality codes that a user may not read by default, and sensitivity tags.
RESTRICTED = ("R", "V")
SENSITIVE = ("HIV", "PSY", "ETH", "SDV", "SEX", "STD", "TABOO", "SUD", "MH")


def decision(context: Column, labels: Column, patient: Column, launch: Column) -> tuple[Column, Column]:
    """(allowed, labels that block) for a scope context: patient, user or system."""
    blocking = F.coalesce(F.filter(labels, lambda x: x.isin(*RESTRICTED, *SENSITIVE)), F.expr("cast(array() as array<string>)"))
    user = context == "user"
    ok = F.when(context == "system", True).when(context == "patient", F.coalesce(patient == launch, F.lit(False))).when(user, F.size(blocking) == 0).otherwise(False)
    return ok, F.when(user, blocking).otherwise(F.expr("cast(array() as array<string>)"))


def granted(requests: DataFrame, consents: DataFrame, now: str) -> DataFrame:
    """Requests (id, patient, actor, purpose, blocking) that an active permit covers.

    ``consents`` has patient, status and provisions, an array of (type, labels,
    actors, purposes, start, end) with nested provisions unrolled into it.
    """
    hit = lambda p: (
        (p["type"] == "permit") & (F.coalesce(p["start"], F.lit("")) <= now) & (F.coalesce(p["end"], F.lit("9999")) >= now)
        & ((F.size(F.coalesce(p["labels"], F.expr("array()"))) == 0) | F.arrays_overlap(p["labels"], "blocking"))
        & ((F.size(F.coalesce(p["actors"], F.expr("array()"))) == 0) | F.array_contains(p["actors"], F.col("actor")))
        & ((F.size(F.coalesce(p["purposes"], F.expr("array()"))) == 0) | F.coalesce(F.array_contains(p["purposes"], F.col("purpose")), F.lit(False)))
    )
    j = requests.join(consents.where("status = 'active'"), "patient")
    return requests.join(j.where(F.exists("provisions", lambda p: F.coalesce(hit(p), F.lit(False)))).select("id").distinct(), "id", "left_semi")


def redact(df: DataFrame, columns: list[str], labelled: Column) -> DataFrame:
    """Listed columns masked where the row is labelled, with a tag that says so."""
    out = df.withColumns({c: F.when(~F.coalesce(labelled, F.lit(False)), F.col(c)) for c in columns})
    return out.withColumn("redacted", F.coalesce(labelled, F.lit(False)))


def member_match(requests: DataFrame, members: DataFrame) -> DataFrame:
    """(request, member, strategy, ambiguous) per request.

    The request's identifiers are tried in their order and the first that exactly one member has decides; one
    that several have is passed over. If none decides, the family name (any case), the birth date (as far as
    the request has it) and the gender do, if exactly one member fits. ``ambiguous`` says that nobody was
    found, but something fitted several. Members are counted per identifier and per demographic key
    beforehand, so a common key costs its rows, not its pairs.
    """
    each = members.select("member", F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
    keyed = each.groupBy("key").agg(F.count_distinct("member").alias("n"), F.min("member").alias("m"))
    tried = requests.select("request", F.posexplode("keys").alias("turn", "key")).join(keyed, "key")
    by_key = tried.groupBy("request").agg(F.min(F.when(F.col("n") == 1, F.struct("turn", "m"))).alias("first"), F.max(F.col("n") > 1).alias("several"))
    known = members.where("family is not null and gender is not null and birth_date is not null")
    begun = known.select("member", F.lower("family").alias("f"), "gender", "birth_date", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("birth_date")))).alias("k"))
    fits = begun.groupBy("f", "gender", F.left("birth_date", F.col("k")).alias("b")).agg(F.count_distinct("member").alias("n"), F.min("member").alias("m"))
    asked = requests.select("request", F.lower("family").alias("f"), "gender", F.col("birth_date").alias("b")).distinct()
    by_demo = asked.join(fits, ["f", "gender", "b"]).groupBy("request").agg(F.max("n").alias("n_demo"), F.min("m").alias("m_demo"))
    j = requests.select("request").distinct().join(by_key, "request", "left").join(by_demo, "request", "left")
    found = F.when(F.col("first").isNotNull(), "identifier").when(F.col("n_demo") == 1, "demographics")
    many = F.coalesce("several", F.lit(False)) | (F.coalesce("n_demo", F.lit(0)) > 1)
    return j.select("request", F.coalesce("first.m", F.when(F.col("n_demo") == 1, F.col("m_demo"))).alias("member"), found.alias("strategy"), (found.isNull() & many).alias("ambiguous"))
