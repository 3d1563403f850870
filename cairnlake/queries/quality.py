"""Data-quality queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnlake.operators import orphans
from cairnlake.operators import quality as Q
from cairnlake.operators import resources as R
from cairnlake.operators.quality import Check
from cairnlake.queries.search import O, P
from cairnlake.sources.tables import table

TODAY = "2025-06-30"
GENDERS = ("male", "female", "other", "unknown")
DATE = r"\d{4}(-\d{2}(-\d{2})?)?$"
PATIENT = [
    Check("must_support", "populated:gender", ("gender",)), Check("must_support", "populated:birthDate", ("birthDate",)), Check("must_support", "populated:name", ("name",)),
    Check("must_support", "populated:address", ("address",)), Check("must_support", "name:family", ("family",), ("name",)), Check("required", "required:identifier.value", ("value",), ("identifier",)),
    Check("binding", "code:gender", ("gender",), codes=GENDERS), Check("format", "lexical:birthDate", ("birthDate",), regex=DATE), Check("date_plausible", "plausible:birthDate", ("birthDate",)),
    Check("max_cardinality", "max:birthDate", ("birthDate",)), Check("max_cardinality", "max:name", ("name",), max=1), Check("max_cardinality", "max:given", ("name", "given"), max=1 + 1),
    Check("reference_target", "target:managingOrganization", ("managingOrganization",), targets=("Organization",)),
]


def _p(s, d):
    return R.patients(table(s, d, "patient")).where("not coalesce(deleted, false)")


def _silver(s, d, n):
    return R.once(table(s, d, n)).where("not coalesce(deleted, false)")


def _exists(s, d):
    refs = orphans.reference_rows(*[table(s, d, n) for n in ("observation", "imagingstudy", "claimresponse")])
    refs = refs.select(F.concat_ws(":", "source_table", "field_path").alias("metric"), "target")
    return Q.reference_exists(refs, orphans.parent_keys(table(s, d, "patient"), table(s, d, "organization")))


def _runs(s, d):
    o = table(s, d, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("resource_type"), F.col("o_orderstatus").alias("tier"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("computed_at")).agg(F.count("*").alias("n"))


QUERIES = {
    "dq_patient_suite": lambda s, d: Q.run_checks(_p(s, d), PATIENT, TODAY),
    "dq_summary": lambda s, d: Q.summary(Q.run_checks(_p(s, d), PATIENT, TODAY)),
    "dq_pass_fail": lambda s, d: Q.passes(Q.run_checks(_p(s, d), PATIENT, TODAY), 0.9),
    "dq_bad_codes": lambda s, d: Q.bad_examples(_p(s, d), PATIENT[6]),
    "dq_plausibility": lambda s, d: Q.run_checks(R.observations(table(s, d, "observation")).where("not coalesce(deleted, false)"), [Check("date_plausible", "effective", ("effectiveInstant",)), Check("must_support", "populated:code", ("coding",), ("code",)), Check("reference_target", "target:subject", ("subject",), targets=("Patient",))], TODAY),
    "dq_ref_exists": _exists,
    "mart_dq_latest": lambda s, d: Q.latest_run(_runs(s, d)),
    "dq_issue_counts": lambda s, d: Q.issue_counts(table(s, d, "events").select(F.expr("case event_id % 7 when 0 then 'error' when 1 then 'warning' else 'information' end").alias("severity"))),
    "profile_counts": lambda s, d: Q.profile_counts(table(s, d, "patient"), "fhir_id"),
    "profile_top5": lambda s, d: Q.top_values(_silver(s, d, "patient"), "gender"),
    "profile_minmax": lambda s, d: Q.bounds(_silver(s, d, "patient"), "birthDate"),
    "profile_positional": lambda s, d: Q.numeric_profile(_silver(s, d, "observation").select(F.col("valueQuantity.value").alias("v")), "v"),
    "profile_top_unit": lambda s, d: Q.top_unit(_silver(s, d, "observation").select(F.col("valueQuantity.value").alias("v"), F.col("valueQuantity.unit").alias("u")), "v", "u"),
}


def _m(dim: str, metric: str, num: str, den: str, source: str = "p") -> str:
    return f"SELECT '{dim}' AS dimension, '{metric}' AS metric, coalesce({num}, 0)::bigint AS numerator, coalesce({den}, 0)::bigint AS denominator FROM {source}"


_NM = "(SELECT unnest(name) AS n FROM p)"
_ID = "(SELECT unnest(identifier) AS i FROM p)"
_KIND = "regexp_extract({0}, '(?:^|/)([A-Z][A-Za-z]+)/[A-Za-z0-9.\\-]+', 1)"
_ORG = _KIND.format("managingOrganization.reference")
_PLAUS = "regexp_matches({0}, '^\\d{{4}}(-\\d{{2}})?(-\\d{{2}})?([T ][^\n]*)?$') AND left({0}, 4) >= '1900' AND left({0}, 10) <= '2026-07-01'"
_SUITE = f"WITH {P}, m AS (" + " UNION ALL ".join([
    _m("completeness", "populated:gender", "count(*) FILTER (gender <> '')", "count(*)"), _m("completeness", "populated:birthDate", "count(*) FILTER (birthDate <> '')", "count(*)"), _m("completeness", "populated:name", "count(*) FILTER (len(name) > 0)", "count(*)"),
    _m("completeness", "populated:address", "count(*) FILTER (len(list_filter(address, lambda a: a.city IS NOT NULL OR a.postalCode IS NOT NULL)) > 0)", "count(*)"), _m("completeness", "name:family", "count(*) FILTER (n.family <> '')", "count(*)", _NM), _m("conformance", "required:identifier.value", "count(*) FILTER (i.value <> '')", "count(*)", _ID),
    _m("conformance", "code:gender", "count(*) FILTER (gender IN ('male', 'female', 'other', 'unknown'))", "count(gender)"), _m("conformance", "lexical:birthDate", "count(*) FILTER (regexp_matches(birthDate, '^\\d{4}(-\\d{2}(-\\d{2})?)?$'))", "count(birthDate)"),
    _m("plausibility", "plausible:birthDate", f"count(*) FILTER ({_PLAUS.format('birthDate')})", "count(birthDate)"), _m("conformance", "max:birthDate", "count(birthDate)", "count(birthDate)"), _m("conformance", "max:name", "0", "count(name)"),
    _m("conformance", "max:given", "count(*) FILTER (len(n.given) <= 2)", "count(n.given)", _NM), _m("conformance", "target:managingOrganization", f"count(*) FILTER ({_ORG} = 'Organization')", f"count(*) FILTER ({_ORG} <> '')"),
]) + "), scores AS (SELECT *, numerator / nullif(denominator, 0) AS score FROM m)"
_SUBJ = _KIND.format("subject.reference")

ORACLES = {
    "dq_patient_suite": f"{_SUITE} SELECT * FROM scores",
    "dq_summary": f"{_SUITE} SELECT count(*) AS metrics, count(*) FILTER (score < 1) AS imperfect, coalesce(min(score), 1.0) AS worst FROM scores",
    "dq_pass_fail": f"{_SUITE} SELECT metric, CASE WHEN score >= 0.9 THEN 'pass' WHEN score IS NULL THEN 'skip' ELSE 'fail' END AS result FROM scores",
    "dq_bad_codes": f"WITH {P} SELECT DISTINCT gender AS value FROM p WHERE gender NOT IN ('male', 'female', 'other', 'unknown') ORDER BY 1 LIMIT 5",
    "dq_plausibility": f"WITH {O}, m AS (" + " UNION ALL ".join([
        _m("plausibility", "effective", f"count(*) FILTER ({_PLAUS.format('effectiveInstant')})", "count(effectiveInstant)", "o"), _m("completeness", "populated:code", "count(*) FILTER (len(code.coding) > 0)", "count(code)", "o"),
        _m("conformance", "target:subject", f"count(*) FILTER ({_SUBJ} = 'Patient')", f"count(*) FILTER ({_SUBJ} <> '')", "o")]) + ") SELECT *, numerator / nullif(denominator, 0) AS score FROM m",
    "dq_ref_exists": r"""WITH refs AS (SELECT 'observation:subject.reference' AS metric, subject.reference AS r FROM observation UNION ALL SELECT 'imagingstudy:subject.reference', subject.reference FROM imagingstudy
       UNION ALL SELECT 'claimresponse:patient.reference', patient.reference FROM claimresponse UNION ALL SELECT 'claimresponse:insurer.reference', insurer.reference FROM claimresponse),
       t AS (SELECT metric, regexp_extract(regexp_replace(regexp_replace(r, '^\s+|\s+$', '', 'g'), '/_history/.*$', ''), '([^/]*/[^/]*)$', 1) AS target FROM refs WHERE r IS NOT NULL AND NOT starts_with(trim(r), '#')),
       k AS (SELECT DISTINCT 'Patient/' || fhir_id AS key FROM patient UNION SELECT DISTINCT 'Organization/' || fhir_id FROM organization)
       SELECT metric, count(key)::bigint AS found, count(*)::bigint AS checked FROM t LEFT JOIN k ON target = key WHERE split_part(target, '/', 1) IN ('Patient', 'Organization') GROUP BY metric""",
    "mart_dq_latest": """WITH r AS (SELECT o_orderpriority AS resource_type, o_orderstatus AS tier, strftime(o_orderdate, '%Y-%m-%d') AS computed_at, count(*) AS n FROM orders GROUP BY ALL)
       SELECT r.* FROM r JOIN (SELECT resource_type, tier, max(computed_at) AS computed_at FROM r GROUP BY ALL) USING (resource_type, tier, computed_at)""",
    "dq_issue_counts": "SELECT CASE event_id % 7 WHEN 0 THEN 'error' WHEN 1 THEN 'warning' ELSE 'information' END AS severity, count(*) AS n FROM events GROUP BY 1",
    "profile_counts": "SELECT count(*) AS count, count(DISTINCT fhir_id) AS distinct_ids, (1 - count(DISTINCT fhir_id) / count(fhir_id)) * 100 AS duplicate_id_pct FROM patient",
    "profile_top5": f"WITH {P} SELECT gender AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, gender)::int AS rank FROM p WHERE gender <> '' GROUP BY gender ORDER BY rank LIMIT 5",
    "profile_minmax": f"WITH {P} SELECT min(birthDate) AS min, max(birthDate) AS max FROM p",
    "profile_positional": f"WITH {O}, v AS (SELECT valueQuantity.value AS v FROM o WHERE valueQuantity.value IS NOT NULL), l AS (SELECT list(v ORDER BY v) AS s, count(*) AS n, min(v) AS a, max(v) AS b, avg(v) AS c FROM v) SELECT n, a AS num_min, b AS num_max, c AS num_mean, s[n // 2 + 1] AS num_p50, s[floor(n * 0.95)::int] AS num_p95 FROM l",
    "profile_top_unit": f"WITH {O} SELECT valueQuantity.unit AS value, count(*) AS n FROM o WHERE valueQuantity.value IS NOT NULL AND valueQuantity.unit <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
}
