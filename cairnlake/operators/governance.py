"""Decision log, provenance, applied decisions, event classes, element subsets, body rewriting.

Ids are hashes of content, so a run that is repeated gives the same rows and
an anti-join drops those that are already there.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.operators.identity import LEVELS


def _id(*parts: Column) -> Column:
    return F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(32))


def decision_log(scored: DataFrame, bands: DataFrame, run: str, now: str) -> DataFrame:
    """A row per decided pair: ids, probability, band, reason and the levels that led to it as JSON."""
    evidence = F.to_json(F.struct(*[F.col(c) for c in LEVELS], F.round("match_weight", 6).alias("match_weight")))
    j = bands.join(scored.select("id_l", "id_r", evidence.alias("contributions")), ["id_l", "id_r"])
    return j.select(_id(F.lit(run), "id_l", "id_r").alias("decision_id"), F.lit(run).alias("run_id"), "id_l", "id_r", "match_probability", "band", "reason", "contributions", F.lit(now).alias("decided_at"))


def review_rows(bands: DataFrame, now: str) -> DataFrame:
    """Pending reviews of automatic and review bands; the candidate set is its two ids in order."""
    ids = F.concat_ws(",", F.array_sort(F.array("id_l", "id_r")))
    rows = bands.where("band in ('auto_match', 'review')")
    return rows.select(_id(ids).alias("review_id"), ids.alias("candidate_ids"), F.coalesce("reason", F.col("band")).alias("reason"), F.when(F.col("band") == "auto_match", "merge").otherwise("inspect").alias("suggested_action"), F.lit("pending").alias("status"), F.lit(now).alias("created_at"))


def apply_decisions(approved: DataFrame, patients: DataFrame, merges: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(new merges, errors) of approved reviews (candidate_ids ``a,b``): the later write survives.

    A pair that is merged already is left alone; one whose patient is missing is an error.
    ``patients``: id, last_updated. ``merges``: survivor, merged.
    """
    a, b = F.split("candidate_ids", ",")[0], F.split("candidate_ids", ",")[1]
    p = patients.select("id", "last_updated")
    j = approved.select("review_id", a.alias("a"), b.alias("b")).join(p.select(F.col("id").alias("a"), F.col("last_updated").alias("ta")), "a", "left").join(p.select(F.col("id").alias("b"), F.col("last_updated").alias("tb")), "b", "left")
    lost = j.where("ta is null or tb is null").select("review_id", F.lit("patient missing").alias("error"))
    first = F.col("ta") >= F.col("tb")
    new = j.where("ta is not null and tb is not null").select("review_id", F.when(first, F.col("a")).otherwise(F.col("b")).alias("survivor"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("merged"), F.lit(now).alias("merged_at"))
    return new.join(merges.select("survivor", "merged"), ["survivor", "merged"], "left_anti"), lost


def provenance(decisions: DataFrame, activity: str, agent: str, now: str) -> DataFrame:
    """Provenance records of decisions (survivor, merged): id and JSON body."""
    body = F.to_json(F.struct(
        F.lit("Provenance").alias("resourceType"), _id(F.lit(activity), "survivor", "merged").alias("id"), F.lit(now).alias("recorded"),
        F.array(F.struct(F.concat(F.lit("Patient/"), "survivor").alias("reference")), F.struct(F.concat(F.lit("Patient/"), "merged").alias("reference"))).alias("target"),
        F.struct(F.array(F.struct(F.lit(activity).alias("code"))).alias("coding")).alias("activity"), F.array(F.struct(F.struct(F.lit(agent).alias("display")).alias("who"))).alias("agent"),
    ))
    return decisions.where("survivor is not null").select(_id(F.lit(activity), "survivor", "merged").alias("id"), body.alias("body_json"))


def event_class(method: Column, status: Column) -> tuple[Column, Column]:
    """(action, outcome) of an access: C, R, U, D or E; 0 success, 4 refused, 8 failed."""
    action = F.when(method == "POST", "C").when(method.isin("GET", "HEAD"), "R").when(method.isin("PUT", "PATCH"), "U").when(method == "DELETE", "D").otherwise("E")
    return action, F.when(status < 400, "0").when(status < 500, "4").otherwise("8")


def subset(df: DataFrame, keys: list[str], body: str = "body_json") -> DataFrame:
    """Bodies cut to the asked top-level elements, with id, meta and resourceType always kept; broken bodies are null."""
    keep = sorted({*keys, "id", "meta", "resourceType"})
    m = F.try_variant_get(F.try_parse_json(body), "$", "map<string,variant>")
    return df.withColumn(body, F.to_json(F.map_filter(m, lambda k, _: k.isin(keep))))


def rewrite_bodies(df: DataFrame, key: list[str], survivors: DataFrame, body: str = "body_json", kind: str = "Patient") -> DataFrame:
    """``df`` with every ``reference`` field inside the bodies led to the terminal survivor; free text is not touched.

    The references of a body are extracted and joined to the survivors first, so only
    bodies with something to change go through Python, in Arrow batches.
    """
    refs = df.select(*key, F.explode(F.array_distinct(F.regexp_extract_all(F.col(body), F.lit(rf'"reference"\s*:\s*"[^"]*{kind}/([A-Za-z0-9.\-]+)'), F.lit(1)))).alias("_ref"))
    maps = refs.join(survivors.select(F.col("id").alias("_ref"), "terminal"), "_ref").groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("_ref", "terminal"))).alias("_map"))
    j = df.join(maps, key, "left")

    @F.pandas_udf("string")
    def change(bodies: pd.Series, names: pd.Series) -> pd.Series:
        def walk(x, to):
            if isinstance(x, list):
                return [walk(y, to) for y in x]
            if isinstance(x, dict):
                return {k: lead(v, to) if k == "reference" and isinstance(v, str) else walk(v, to) for k, v in x.items()}
            return x

        def lead(ref, to):
            head, sep, rest = ref.rpartition(kind + "/")
            name = re.match(r"[A-Za-z0-9.\-]*", rest)[0]
            return head + sep + to[name] + rest[len(name) :] if sep and name in to else ref

        out = []
        for b, to in zip(bodies, names, strict=True):
            try:
                out.append(json.dumps(walk(json.loads(b), dict(to)), separators=(",", ":"), ensure_ascii=False))
            except ValueError:
                out.append(b)
        return pd.Series(out)

    same = j.where("_map is null").drop("_map")
    return same.unionByName(j.where("_map is not null").withColumn(body, change(F.col(body), F.col("_map"))).drop("_map"))


def allowed(scopes: list[dict], resource_type: str, action: str) -> dict | None:
    """What a caller's scopes allow on a type: None, or the filters of the matching scopes and whether only the own compartment.

    A scope has context (patient, user, system), type (or ``*``), actions and query (key to values). Filters are
    the union per key; a key that some matching scope leaves open is open; the compartment binds only if every matching scope is a patient's.
    """
    hit = [s for s in scopes if s["type"] in (resource_type, "*") and action in s["actions"]]
    if not hit:
        return None
    keys = set.intersection(*[set(s.get("query") or {}) for s in hit])
    return {"filters": {k: sorted({v for s in hit for v in s["query"][k]}) for k in sorted(keys)}, "compartment": all(s["context"] == "patient" for s in hit)}


def package(questionnaire: DataFrame, libraries: DataFrame) -> DataFrame:
    """(questionnaire, library) by canonical address without its version; missing ones have a null library."""
    url = F.split("canonical", r"\|")[0]
    return questionnaire.select("questionnaire", url.alias("url")).distinct().join(libraries.select("url", F.col("id").alias("library")), "url", "left").select("questionnaire", "library")
