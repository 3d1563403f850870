"""Audit, consent, terminology, validation and transaction queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnlake.operators import audit, consent, terminology, validation
from cairnlake.operators import resources as R
from cairnlake.operators.synthetic import PERSONS_SQL, persons
from cairnlake.operators.validation import Element
from cairnlake.queries.search import P
from cairnlake.sources.tables import table


def _records(s, d):
    """Audit records of the events, one chain per user."""
    e = table(s, d, "events")
    return e.select(F.col("user_id").cast("string").alias("chain"), F.lpad(F.col("event_id").cast("string"), 10, "0").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("recorded"), F.col("event_type").alias("action"), F.lit("0").alias("outcome"), F.concat(F.lit("t"), (F.col("event_id") % 5).cast("string")).alias("subtype"), F.lit("svc").alias("agent_who"), F.lit(None).cast("string").alias("entity_ref"), F.concat(F.lit("Patient/"), F.col("user_id").cast("string")).alias("patient"), F.col("props").alias("body_json"))


def _harmed(s, d):
    """Chains with edited records (id % 97 = 5) and lost ones (id % 101 = 7)."""
    c = audit.chain(_records(s, d))
    n = F.col("id").cast("bigint")
    return c.where(n % 101 != 7).withColumn("action", F.when(n % 97 == 5, "edited").otherwise(F.col("action")))


def _issues(s, d):
    return audit.verify(_harmed(s, d)).select("chain", "id", "issue")


def _anchored(s, d):
    whole = audit.chain(_records(s, d))
    return audit.check_anchors(whole.where(F.col("id").cast("bigint") % 101 != 7), audit.anchors(whole))


def _concepts(s, d):
    part = table(s, d, "part").select(F.lit("urn:types").alias("system"), F.col("p_type").alias("code"), F.lower("p_type").alias("display")).distinct()
    nat = table(s, d, "nation").select(F.lit("urn:nations").alias("system"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("display"))
    return part.unionByName(nat)


def _expansion(s, d):
    nat = table(s, d, "nation").select(F.concat(F.lit("vs-region-"), F.col("n_regionkey").cast("string")).alias("valueset"), F.lit("urn:nations").alias("system"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("display"))
    return nat


def _headers(s, d):
    return table(s, d, "region").select(F.concat(F.lit("vs-region-"), F.col("r_regionkey").cast("string")).alias("url"), (F.col("r_regionkey") != 2).alias("complete"))


def _asked(s, d):
    c = table(s, d, "customer")
    return c.select("c_custkey", F.concat(F.lit("vs-region-"), (F.col("c_custkey") % 7).cast("string")).alias("valueset"), F.col("c_nationkey").cast("string").alias("code"))


PATIENT = (Element("active", "boolean"), Element("gender", "code"), Element("birthDate", "date"), Element("name", (Element("use", "code"), Element("family"), Element("given", many=True)), many=True), Element("address", (Element("city", required=True), Element("postalCode")), many=True), Element("identifier", (Element("system"), Element("value", required=True)), many=True))


def _validated(s, d):
    p = R.patients(table(s, d, "patient")).where("not coalesce(deleted, false)")
    v = validation.structure(p, PATIENT, "Patient")
    return v.select("id", F.explode("issues").alias("i")).select("id", "i.path", "i.message")


def _requests(s, d):
    """A request per person: a shared identifier first, then one nobody has, then for every third its own; the others have their birth year or month only."""
    c = persons(table(s, d, "customer")).withColumn("k", F.col("id").cast("bigint"))
    k = F.col("k")
    keys = F.array(F.concat(F.lit("plan|"), (k % 50).cast("string")), F.lit("none|0"), F.when(k % 3 == 0, F.concat(F.lit("mrn|"), F.col("id"))))
    return c.select(F.col("id").alias("request"), F.when(k % 7 != 6, keys).otherwise(F.slice(keys, 2, 2)).alias("keys"), F.upper("family").alias("family"), F.left("birthDate", F.when(k % 2 == 0, 7).otherwise(10)).alias("birth_date"), "gender")


def _members(s, d):
    c = persons(table(s, d, "customer"))
    k = F.col("id").cast("bigint")
    return c.select(F.col("id").alias("member"), F.array(F.concat(F.lit("mrn|"), F.col("id")), F.concat(F.lit("plan|"), (k % 50).cast("string"))).alias("keys"), "family", F.col("birthDate").alias("birth_date"), "gender")


def _gate(s, d):
    e = table(s, d, "events")
    ctx = F.expr("case event_id % 4 when 0 then 'system' when 1 then 'patient' when 2 then 'user' end")
    labels = F.expr("array_compact(array(if(event_id % 5 = 0, 'R', null), if(event_id % 11 = 0, 'PSY', null), if(event_id % 3 = 0, 'N', null)))")
    ok, blocking = consent.decision(ctx, labels, F.col("user_id"), F.when(F.col("event_id") % 8 == 1, F.col("user_id")).otherwise(F.lit(-1)))
    return e.select("event_id", "user_id", ok.alias("allowed"), blocking.alias("blocking"))


def _override(s, d):
    q = _gate(s, d).where(F.size("blocking") > 0).select(F.col("event_id").alias("id"), F.col("user_id").alias("patient"), F.lit("Dr/1").alias("actor"), F.lit("TREAT").alias("purpose"), "blocking")
    c = table(s, d, "events").select("user_id").distinct().select(F.col("user_id").alias("patient"), F.expr("if(user_id % 2 = 0, 'active', 'inactive')").alias("status"), F.expr("array(named_struct('type', if(user_id % 3 = 0, 'deny', 'permit'), 'labels', if(user_id % 5 = 0, cast(array() as array<string>), array('PSY')), 'actors', array('Dr/1'), 'purposes', cast(null as array<string>), 'start', '2024-01-01', 'end', if(user_id % 7 = 0, '2024-06-01', null)))").alias("provisions"))
    return consent.granted(q, c, "2025-01-01").select("id")


def _bundles(s, d):
    li = table(s, d, "orders")
    k = F.col("o_orderkey")
    e = li.select((F.col("o_custkey")).alias("bundle"), F.concat(F.lit("urn:uuid:"), k.cast("string")).alias("full_url"), F.concat(F.lit("Order/"), k.cast("string")).alias("resource_id"), F.when(k % 3 == 0, F.concat(F.lit("urn:uuid:"), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("Customer/"), (k % 200).cast("string"))).alias("reference"))
    stored = table(s, d, "customer").where("c_custkey <= 190").select(F.concat(F.lit("Customer/"), F.col("c_custkey").cast("string")).alias("key"))
    return validation.transaction(e, stored).select("bundle", "resource_id", "resolved", "ok", "commits")


def _bundles_all(s, d):
    """Every order and every customer; an order that refers to a customer names its own number, so numbers above the customers' are missing."""
    k = F.col("o_orderkey")
    e = table(s, d, "orders").select(F.col("o_custkey").alias("bundle"), F.concat(F.lit("urn:uuid:"), k.cast("string")).alias("full_url"), F.concat(F.lit("Order/"), k.cast("string")).alias("resource_id"), F.when(k % 3 == 0, F.concat(F.lit("urn:uuid:"), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("Customer/"), k.cast("string"))).alias("reference"))
    stored = table(s, d, "customer").select(F.concat(F.lit("Customer/"), F.col("c_custkey").cast("string")).alias("key"))
    return validation.transaction(e, stored).select("bundle", "resource_id", "resolved", "ok", "commits")


RULES = {"named": "name.exists() or identifier.exists()", "known": "birthDate.exists() and gender.exists()", "official": "name.where(use = 'official').exists()", "odd": "name.trace('x')"}

QUERIES = {
    "audit_chain": lambda s, d: audit.chain(_records(s, d)).select("chain", "id", "prev_hash", "hash"),
    "audit_verify": _issues,
    "audit_order": lambda s, d: audit.chain_order(audit.chain(_records(s, d))).select("chain", "id", "position"),
    "audit_anchor": _anchored,
    "disclosures": lambda s, d: audit.disclosures(_records(s, d), "Patient/7").select("id", "recorded", "action"),
    "consent_filter": lambda s, d: _gate(s, d).select("event_id", "allowed", F.size("blocking").alias("n_blocking")),
    "consent_override": _override,
    "consent_redact": lambda s, d: consent.redact(persons(table(s, d, "customer")).select("id", "family", "birthDate"), ["birthDate"], F.col("id").cast("bigint") % 23 == 0),
    "member_match": lambda s, d: consent.member_match(_requests(s, d), _members(s, d)),
    "transaction_refs_all": _bundles_all,
    "term_membership3": lambda s, d: terminology.membership(_asked(s, d), _expansion(s, d), _headers(s, d)).select("c_custkey", "status", "display"),
    "term_lookup": lambda s, d: terminology.lookup(table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, "urn:other").otherwise("urn:nations").alias("system"), (F.col("c_nationkey") + F.col("c_custkey") % 3).cast("string").alias("code")), _concepts(s, d)).select("c_custkey", "status", "display"),
    "term_expand_filter": lambda s, d: terminology.expand(_expansion(s, d), "vs-region-1", "a"),
    "term_headers": lambda s, d: terminology.system_headers(_concepts(s, d)),
    "valueset_algebra": lambda s, d: terminology.compose(_concepts(s, d), [_expansion(s, d).where("valueset in ('vs-region-0', 'vs-region-1')"), _expansion(s, d).where("valueset = 'vs-region-3'")], [_expansion(s, d).where("display like '%A'")]),
    "validate_structure": _validated,
    "validate_invariants": lambda s, d: validation.invariants(R.patients(table(s, d, "patient")).where("not coalesce(deleted, false)"), RULES)[0].select("id", F.explode("broken").alias("rule")),
    "validate_required": lambda s, d: validation.required_paths(R.patients(table(s, d, "patient")).where("not coalesce(deleted, false)"), ["gender", "name.given", "address.city"]).select("id", F.explode("missing").alias("path")),
    "validate_slices": lambda s, d: validation.slices(R.patients(table(s, d, "patient")).where("not coalesce(deleted, false)"), "name", {"official": ({"use": "official"}, 1), "maiden": ({"use": "maiden"}, 1)}).select("id", F.explode("slice_issues").alias("i")).select("id", "i.message"),
    "validate_bindings": lambda s, d: validation.bindings(table(s, d, "customer"), ["c_custkey"], F.expr("array(named_struct('system', 'urn:nations', 'code', cast(c_nationkey as string)), named_struct('system', 'urn:x', 'code', 'y'))"), "vs-region-1", _expansion(s, d), _headers(s, d)),
}

_AUD = """a AS (SELECT user_id::varchar AS chain, lpad(event_id::varchar, 10, '0') AS id, event_id AS n, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS recorded, event_type AS action, 'id=' || lpad(event_id::varchar, 10, '0') || chr(10) || 'recorded=' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || chr(10) || 'action=' || event_type || chr(10) || 'outcome=0' || chr(10) || 'subtype=t' || event_id % 5 || chr(10) || 'agent_who=svc' || chr(10) || 'entity_ref=' || chr(10) || 'patient=Patient/' || user_id || chr(10) || 'body_json=' || coalesce(props, '') AS content FROM events)"""
_ISS = """SELECT chain, id, 'content mismatch' AS issue FROM a WHERE n % 101 <> 7 AND n % 97 = 5 AND action <> 'edited'
 UNION ALL SELECT chain, id, 'previous record missing' FROM (SELECT *, lag(n) OVER (PARTITION BY chain ORDER BY recorded, id) AS before FROM a) WHERE n % 101 <> 7 AND before % 101 = 7
 UNION ALL SELECT chain, NULL, 'no first record' FROM (SELECT chain, min(struct_pack(recorded, id, n)) AS f FROM a GROUP BY chain) z WHERE f.n % 101 = 7 AND EXISTS (SELECT 1 FROM a WHERE a.chain = z.chain AND a.n % 101 <> 7)"""
_GATE = """g AS (SELECT event_id, user_id, list_filter([CASE WHEN event_id % 5 = 0 THEN 'R' END, CASE WHEN event_id % 11 = 0 THEN 'PSY' END], lambda x: x IS NOT NULL AND event_id % 4 = 2) AS blocking,
 CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN event_id % 8 = 1 WHEN 2 THEN event_id % 5 <> 0 AND event_id % 11 <> 0 ELSE false END AS allowed FROM events)"""
_CON = f"""WITH c AS (SELECT 'urn:types' AS system, p_type AS code, min(lower(p_type)) AS display FROM part GROUP BY p_type UNION ALL SELECT 'urn:nations', n_nationkey::varchar, n_name FROM nation)"""

ORACLES = {
    "audit_chain": f"""WITH RECURSIVE {_AUD}, o AS (SELECT *, row_number() OVER (PARTITION BY chain ORDER BY recorded, id) AS k FROM a),
       h AS (SELECT chain, id, k, '{audit.GENESIS}' AS prev_hash, sha256('{audit.GENESIS}' || chr(10) || content) AS hash FROM o WHERE k = 1
        UNION ALL SELECT o.chain, o.id, o.k, h.hash, sha256(h.hash || chr(10) || o.content) FROM h JOIN o ON o.chain = h.chain AND o.k = h.k + 1) SELECT chain, id, prev_hash, hash FROM h""",
    "audit_verify": f"WITH {_AUD} {_ISS}",
    "audit_order": f"WITH {_AUD} SELECT chain, id, row_number() OVER (PARTITION BY chain ORDER BY recorded, id) AS position FROM a",
    "audit_anchor": f"WITH {_AUD} SELECT chain, CASE WHEN bool_or(n % 101 = 7) THEN 'truncated' ELSE 'ok' END AS state FROM a GROUP BY chain",
    "disclosures": f"WITH {_AUD} SELECT id, recorded, action FROM a WHERE chain = '7'",
    "consent_filter": f"WITH {_GATE} SELECT event_id, allowed, len(blocking)::int AS n_blocking FROM g",
    "consent_override": f"WITH {_GATE} SELECT event_id AS id FROM g WHERE len(blocking) > 0 AND user_id % 2 = 0 AND user_id % 3 <> 0 AND user_id % 7 <> 0 AND (user_id % 5 = 0 OR list_contains(blocking, 'PSY'))",
    "consent_redact": f"WITH {PERSONS_SQL} SELECT id, family, CASE WHEN k % 23 <> 0 THEN birthDate END AS birthDate, k % 23 = 0 AS redacted FROM persons",
    "member_match": f"""WITH {PERSONS_SQL}, q AS (SELECT *, left(birthDate, CASE WHEN k % 2 = 0 THEN 7 ELSE 10 END) AS b, k % 7 <> 6 AND (SELECT count(*) FROM persons x WHERE x.k % 50 = q0.k % 50) > 1 AS shared, k % 7 <> 6 AND (SELECT count(*) FROM persons x WHERE x.k % 50 = q0.k % 50) = 1 AS alone FROM persons q0),
       dm AS (SELECT q.id AS request, count(*) AS n, min(m.id) AS m FROM q JOIN persons m ON q.family = m.family AND starts_with(m.birthDate, q.b) AND q.gender = m.gender GROUP BY q.id)
       SELECT q.id AS request, CASE WHEN alone OR k % 3 = 0 THEN q.id WHEN dm.n = 1 THEN dm.m END AS member, CASE WHEN alone OR k % 3 = 0 THEN 'identifier' WHEN dm.n = 1 THEN 'demographics' END AS strategy,
       NOT (alone OR k % 3 = 0) AND coalesce(dm.n, 0) <> 1 AND (shared OR coalesce(dm.n, 0) > 1) AS ambiguous FROM q LEFT JOIN dm ON dm.request = q.id""",
    "transaction_refs_all": """WITH r AS (SELECT o_custkey AS bundle, 'Order/' || o_orderkey AS resource_id, CASE WHEN o_orderkey % 3 = 0 THEN 'Order/' || o_orderkey WHEN o_orderkey % 3 = 1 AND c_custkey IS NOT NULL THEN 'Customer/' || c_custkey END AS resolved, o_orderkey % 3 <> 1 OR c_custkey IS NOT NULL AS ok
       FROM orders LEFT JOIN customer ON c_custkey = o_orderkey) SELECT *, bool_and(ok) OVER (PARTITION BY bundle) AS commits FROM r""",
    "term_membership3": """SELECT c_custkey, CASE WHEN n_name IS NOT NULL THEN 'valid' WHEN c_custkey % 7 >= 5 OR c_custkey % 7 = 2 THEN 'unknown' ELSE 'invalid' END AS status, n_name AS display FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey = c_custkey % 7""",
    "term_lookup": "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'unknown' WHEN n_name IS NOT NULL THEN 'valid' ELSE 'invalid' END AS status, n_name AS display FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey + c_custkey % 3 AND c_custkey % 5 <> 0",
    "term_expand_filter": "SELECT 'urn:nations' AS system, n_nationkey::varchar AS code, n_name AS display FROM nation WHERE n_regionkey = 1 AND (contains(lower(n_name), 'a') OR contains(n_nationkey::varchar, 'a'))",
    "term_headers": f"{_CON} SELECT system AS url, count(DISTINCT code) AS count FROM c GROUP BY system",
    "valueset_algebra": "SELECT 'urn:nations' AS system, n_nationkey::varchar AS code, n_name AS display FROM nation WHERE n_regionkey IN (0, 1, 3) AND n_name NOT LIKE '%A'",
    "validate_structure": f"""WITH {P} SELECT fhir_id AS id, 'Patient.managingOrganization' AS path, 'unknown element' AS message FROM p WHERE managingOrganization IS NOT NULL
       UNION ALL SELECT fhir_id, 'Patient.birthDate', 'not a date' FROM p WHERE NOT regexp_matches(birthDate, '^\\d{{4}}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\\d|3[01]))?)?$')
       UNION ALL SELECT fhir_id, 'Patient.address[' || (i - 1) || '].city', 'required element missing' FROM (SELECT fhir_id, unnest(address) AS a, generate_subscripts(address, 1) AS i FROM p) WHERE a IS NOT NULL AND a.city IS NULL
       UNION ALL SELECT fhir_id, 'Patient.identifier[' || (i - 1) || '].value', 'required element missing' FROM (SELECT fhir_id, unnest(identifier) AS a, generate_subscripts(identifier, 1) AS i FROM p) WHERE a IS NOT NULL AND a.value IS NULL
       UNION ALL SELECT fhir_id, 'Patient.gender', 'not a code' FROM p WHERE NOT regexp_matches(gender, '^[^\\s]+(\\s[^\\s]+)*$')""",
    "validate_invariants": f"""WITH {P} SELECT fhir_id AS id, 'named' AS rule FROM p WHERE coalesce(len(name), 0) = 0 AND coalesce(len(identifier), 0) = 0
       UNION ALL SELECT fhir_id, 'known' FROM p WHERE birthDate IS NULL OR gender IS NULL UNION ALL SELECT fhir_id, 'official' FROM p WHERE coalesce(len(list_filter(name, lambda n: n.use = 'official')), 0) = 0""",
    "validate_required": f"""WITH {P} SELECT fhir_id AS id, 'gender' AS path FROM p WHERE gender IS NULL UNION ALL SELECT fhir_id, 'name.given' FROM p WHERE len(list_filter(name, lambda n: n IS NOT NULL AND coalesce(len(list_filter(n.given, lambda g: g IS NOT NULL)), 0) = 0)) > 0
       UNION ALL SELECT fhir_id, 'address.city' FROM p WHERE len(list_filter(address, lambda a: a IS NOT NULL AND a.city IS NULL)) > 0""",
    "validate_slices": f"WITH {P} SELECT fhir_id AS id, 'required slice ' || u || ' not met' AS message FROM p, (SELECT unnest(['official', 'maiden']) AS u) WHERE coalesce(len(list_filter(name, lambda n: n.use = u)), 0) < 1",
    "validate_bindings": "SELECT c_custkey, CASE WHEN n_regionkey = 1 THEN 'valid' ELSE 'invalid' END AS status FROM customer JOIN nation ON n_nationkey = c_nationkey",
}
