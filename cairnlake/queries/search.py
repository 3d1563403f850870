"""Search queries over patients, observations and claims, and their SQL."""

from __future__ import annotations

from cairnlake.operators import resources as R
from cairnlake.operators import search as S
from cairnlake.operators.search import Param
from cairnlake.sources.tables import table


def _p(s, d):
    return R.patients(table(s, d, "patient"))


def _o(s, d):
    return R.observations(table(s, d, "observation"))


def _c(s, d):
    return R.claims(table(s, d, "claimresponse"))


def _g(s, d):
    return R.organizations(table(s, d, "organization"))


def _find(load, *params, **kw):
    return lambda s, d: S.search(load(s, d), list(params), **kw).select("id")


def _ids(df):
    return df.select("resource_type", "id")


def _everything(s, d):
    few = S.search(_p(s, d), [Param("family", "string", "sal")])
    return _ids(S.compartment(few, [(_o(s, d), ["subject"]), (_c(s, d), ["patient"])]))


def _group_export(s, d):
    """Members of an organization's group, their compartments, counted by type."""
    from pyspark.sql import functions as F

    members = S.search(_p(s, d), [Param("active", "token", "false")])
    return S.compartment(members, [(_o(s, d), ["subject"]), (_c(s, d), ["patient"])]).groupBy("resource_type").agg(F.count("*").alias("n"))


QUERIES = {
    "search_string_prefix": _find(_p, Param("family", "string", "Sal")),
    "search_string_exact": _find(_p, Param("given", "string", "amin", "exact")),
    "search_string_contains": _find(_p, Param("family", "string", "brecht%", "contains")),
    "search_token": _find(_p, Param("gender", "token", "female")),
    "search_token_system": _find(_o, Param("code", "token", "urn:codes:vitals|temp")),
    "search_token_or": _find(_o, Param("code", "token", "temp,wt")),
    "search_token_not": _find(_p, Param("gender", "token", "female", "not")),
    "search_missing": _find(_p, Param("gender", "token", "true", "missing")),
    "search_missing_false": _find(_o, Param("value-quantity", "quantity", "false", "missing")),
    "search_date_range": _find(_o, Param("date", "date", "ge2024-06"), Param("date", "date", "lt2024-09")),
    "search_date_prefix": _find(_p, Param("birthdate", "date", "1984")),
    "search_number": _find(_o, Param("value-quantity", "number", "gt100")),
    "search_quantity_system": _find(_o, Param("value-quantity", "quantity", "le37|Cel")),
    "search_reference_bare": _find(_c, Param("insurer", "reference", "og-0100edd24c")),
    "search_reference_full": _find(_c, Param("insurer", "reference", "Organization/og-0100edd24c")),
    "search_conjunction": _find(_p, Param("gender", "token", "male"), Param("family", "string", "d"), Param("active", "token", "true")),
    "search_ids": _find(_p, ids=["pt-386f13d524", "pt-4a91872d0e", "nobody"]),
    "search_no_ids": _find(_p, ids=[]),
    "search_total": lambda s, d: S.search(_p(s, d), [Param("gender", "token", "male")]).groupBy().count().withColumnRenamed("count", "total"),
    "search_sort_param": lambda s, d: S.sorted_page(S.live(_p(s, d)), "family", False, 20, 30).select("id", "sort_key"),
    "search_sort_numeric": lambda s, d: S.sorted_page(S.live(_o(s, d)), "value-quantity", True, 200, 25, numeric=True).select("id", "sort_key"),
    "search_paging": lambda s, d: S.sorted_page(S.live(_p(s, d)), None, False, 100, 50).select("id"),
    "search_chain": lambda s, d: S.chained(_o(s, d), "subject", _p(s, d), "Patient", [Param("gender", "token", "female"), Param("family", "string", "d")]).select("id"),
    "search_has": lambda s, d: S.reverse_chained(_p(s, d), "Patient", _o(s, d), "subject", [Param("code", "token", "temp")]).select("id"),
    "search_has_two": lambda s, d: S.reverse_chained(S.reverse_chained(_p(s, d), "Patient", _o(s, d), "subject", [Param("code", "token", "temp")]), "Patient", _c(s, d), "patient", [Param("outcome", "token", "error")]).select("id"),
    "search_include": lambda s, d: _ids(S.include(S.search(_o(s, d), [Param("code", "token", "temp")]), "subject", _p(s, d))),
    "search_include_iterate_all": lambda s, d: _ids(S.include_iterate(S.search(_g(s, d), [Param("active", "token", "true")]), "partof", _g(s, d))),
    "search_revinclude": lambda s, d: _ids(S.revinclude(S.search(_p(s, d), [Param("family", "string", "sal")]), _o(s, d), "subject")),
    "compartment_everything": _everything,
    "export_group": _group_export,
}

# One row per fhir_id; live rows.
_ONE = "SELECT * FROM {0} WHERE fhir_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY fhir_id ORDER BY silver_id) = 1"
P = "p AS (SELECT * FROM (" + _ONE.format("patient") + ") WHERE NOT coalesce(deleted, false))"
O = "o AS (SELECT * FROM (" + _ONE.format("observation") + ") WHERE NOT coalesce(deleted, false))"  # noqa: E741
C = "c AS (SELECT * FROM (" + _ONE.format("claimresponse") + ") WHERE NOT coalesce(deleted, false))"
G = "g AS (SELECT * FROM (" + _ONE.format("organization") + ") WHERE NOT coalesce(deleted, false))"
_FAM = "EXISTS (SELECT 1 FROM unnest(p.name) t(n) WHERE {0})"


def _key(ref: str) -> str:
    return f"regexp_extract(split_part(trim({ref}, chr(32) || chr(9) || chr(10) || chr(13)), '/_history/', 1), '([^/]*/[^/]*)$', 1)"


_OKEY, _CKEY = _key("subject.reference"), _key("patient.reference")
_SAL = _FAM.format("starts_with(lower(n.family), 'sal')")
ORACLES = {
    "search_string_prefix": f"WITH {P} SELECT fhir_id AS id FROM p WHERE {_SAL}",
    "search_string_exact": f"WITH {P} SELECT fhir_id AS id FROM p WHERE EXISTS (SELECT 1 FROM (SELECT unnest(n.given) AS x FROM unnest(p.name) t(n)) WHERE lower(x) = 'amin')",
    "search_string_contains": f"WITH {P} SELECT fhir_id AS id FROM p WHERE {_FAM.format("contains(lower(n.family), 'brecht')")}",
    "search_token": f"WITH {P} SELECT fhir_id AS id FROM p WHERE gender = 'female'",
    "search_token_system": f"WITH {O} SELECT fhir_id AS id FROM o WHERE EXISTS (SELECT 1 FROM unnest(o.code.coding) t(k) WHERE k.system = 'urn:codes:vitals' AND k.code = 'temp')",
    "search_token_or": f"WITH {O} SELECT fhir_id AS id FROM o WHERE EXISTS (SELECT 1 FROM unnest(o.code.coding) t(k) WHERE k.code IN ('temp', 'wt'))",
    "search_token_not": f"WITH {P} SELECT fhir_id AS id FROM p WHERE gender IS DISTINCT FROM 'female'",
    "search_missing": f"WITH {P} SELECT fhir_id AS id FROM p WHERE gender IS NULL",
    "search_missing_false": f"WITH {O} SELECT fhir_id AS id FROM o WHERE valueQuantity.value IS NOT NULL",
    "search_date_range": f"WITH {O} SELECT fhir_id AS id FROM o WHERE effectiveInstant >= '2024-06' AND effectiveInstant < '2024-09'",
    "search_date_prefix": f"WITH {P} SELECT fhir_id AS id FROM p WHERE starts_with(birthDate, '1984')",
    "search_number": f"WITH {O} SELECT fhir_id AS id FROM o WHERE valueQuantity.value > 100",
    "search_quantity_system": f"WITH {O} SELECT fhir_id AS id FROM o WHERE valueQuantity.value <= 37 AND valueQuantity.unit = 'Cel'",
    "search_reference_bare": f"WITH {C} SELECT fhir_id AS id FROM c WHERE insurer.reference = 'og-0100edd24c' OR ends_with(insurer.reference, '/og-0100edd24c')",
    "search_reference_full": f"WITH {C} SELECT fhir_id AS id FROM c WHERE insurer.reference = 'Organization/og-0100edd24c'",
    "search_conjunction": f"WITH {P} SELECT fhir_id AS id FROM p WHERE gender = 'male' AND active AND {_FAM.format("starts_with(lower(n.family), 'd')")}",
    "search_ids": f"WITH {P} SELECT fhir_id AS id FROM p WHERE fhir_id IN ('pt-386f13d524', 'pt-4a91872d0e', 'nobody')",
    "search_no_ids": f"WITH {P} SELECT fhir_id AS id FROM p WHERE false",
    "search_total": f"WITH {P} SELECT count(*) AS total FROM p WHERE gender = 'male'",
    "search_sort_param": f"WITH {P} SELECT fhir_id AS id, (SELECT min(lower(n.family)) FROM unnest(p.name) t(n)) AS sort_key FROM p ORDER BY sort_key NULLS LAST, id LIMIT 30 OFFSET 20",
    "search_sort_numeric": f"WITH {O} SELECT fhir_id AS id, valueQuantity.value AS sort_key FROM o ORDER BY sort_key DESC NULLS FIRST, id DESC LIMIT 25 OFFSET 200",
    "search_paging": f"WITH {P} SELECT fhir_id AS id FROM p ORDER BY id LIMIT 50 OFFSET 100",
    "search_chain": f"WITH {P}, {O} SELECT fhir_id AS id FROM o WHERE {_OKEY} IN (SELECT 'Patient/' || fhir_id FROM p WHERE gender = 'female' AND {_FAM.format("starts_with(lower(n.family), 'd')")})",
    "search_has": f"WITH {P}, {O} SELECT fhir_id AS id FROM p WHERE 'Patient/' || fhir_id IN (SELECT {_OKEY} FROM o WHERE subject.reference IS NOT NULL AND EXISTS (SELECT 1 FROM unnest(o.code.coding) t(k) WHERE k.code = 'temp'))",
    "search_has_two": f"""WITH {P}, {O}, {C} SELECT fhir_id AS id FROM p WHERE 'Patient/' || fhir_id IN (SELECT {_OKEY} FROM o WHERE subject.reference IS NOT NULL AND EXISTS (SELECT 1 FROM unnest(o.code.coding) t(k) WHERE k.code = 'temp'))
       AND 'Patient/' || fhir_id IN (SELECT {_CKEY} FROM c WHERE patient.reference IS NOT NULL AND outcome = 'error')""",
    "search_include": f"WITH {P}, {O} SELECT 'Patient' AS resource_type, fhir_id AS id FROM p WHERE 'Patient/' || fhir_id IN (SELECT {_OKEY} FROM o WHERE subject.reference IS NOT NULL AND EXISTS (SELECT 1 FROM unnest(o.code.coding) t(k) WHERE k.code = 'temp'))",
    "search_include_iterate_all": f"""WITH RECURSIVE {G}, start AS (SELECT fhir_id, partOf.reference AS up FROM g WHERE active),
       walk AS (SELECT fhir_id, up, 0 AS k FROM start UNION SELECT g.fhir_id, g.partOf.reference, k + 1 FROM walk JOIN g ON {_key("walk.up")} = 'Organization/' || g.fhir_id WHERE k < 5)
       SELECT DISTINCT 'Organization' AS resource_type, fhir_id AS id FROM walk WHERE k > 0 AND fhir_id NOT IN (SELECT fhir_id FROM start)""",
    "search_revinclude": f"WITH {P}, {O} SELECT 'Observation' AS resource_type, fhir_id AS id FROM o WHERE {_OKEY} IN (SELECT 'Patient/' || fhir_id FROM p WHERE {_SAL})",
    "compartment_everything": f"""WITH {P}, {O}, {C}, few AS (SELECT 'Patient/' || fhir_id AS key, fhir_id FROM p WHERE {_SAL})
       SELECT 'Patient' AS resource_type, fhir_id AS id FROM few UNION ALL SELECT 'Observation', fhir_id FROM o WHERE {_OKEY} IN (SELECT key FROM few) UNION ALL SELECT 'ClaimResponse', fhir_id FROM c WHERE {_CKEY} IN (SELECT key FROM few)""",
    "export_group": f"""WITH {P}, {O}, {C}, few AS (SELECT 'Patient/' || fhir_id AS key, fhir_id FROM p WHERE active = false)
       SELECT 'Patient' AS resource_type, count(*) AS n FROM few UNION ALL SELECT 'Observation', count(*) FROM o WHERE {_OKEY} IN (SELECT key FROM few) UNION ALL SELECT 'ClaimResponse', count(*) FROM c WHERE {_CKEY} IN (SELECT key FROM few)""",
}
