"""Decision, provenance, subset and rewriting queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnlake.operators import governance as G
from cairnlake.operators import identity as I
from cairnlake.operators import resources as R
from cairnlake.operators.synthetic import persons
from cairnlake.queries.identity import _BAND, _RES, CFG, WEIGHTS, _records
from cairnlake.queries.search import O
from cairnlake.sources.tables import table

NOW = "2025-01-01T00:00:00Z"


def _log(s, d):
    r = _records(s, d)
    sc = I.scored(I.with_levels(I.blocked_pairs(r, CFG), r), WEIGHTS)
    return sc, I.banded(sc, r, CFG)


def _approved(s, d):
    c = table(s, d, "customer").where("c_custkey % 20 = 1")
    reviews = c.select(F.col("c_custkey").cast("string").alias("review_id"), F.concat_ws(",", F.col("c_custkey").cast("string"), (F.col("c_custkey") + F.when(F.col("c_custkey") % 60 == 1, 10_000_000).otherwise(1)).cast("string")).alias("candidate_ids"))
    p = persons(table(s, d, "customer")).select("id", "last_updated")
    done = c.where("c_custkey % 100 = 21").select(F.col("c_custkey").cast("string").alias("survivor"), (F.col("c_custkey") + 1).cast("string").alias("merged"))
    return G.apply_decisions(reviews, p, done, NOW)


def _approved_all(s, d):
    """A review of every customer with the one as many numbers on as its nation says; those above the customers' are missing, those in debt are merged already."""
    c = table(s, d, "customer").withColumn("other", F.col("c_custkey") + 1 + F.col("c_nationkey"))
    reviews = c.select(F.col("c_custkey").cast("string").alias("review_id"), F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("other").cast("string")).alias("candidate_ids"))
    done = c.where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("survivor"), F.col("other").cast("string").alias("merged"))
    return G.apply_decisions(reviews, persons(table(s, d, "customer")).select("id", "last_updated"), done, NOW)


def _bodies(s, d):
    """Observation bodies with the subjects of even patients led to one survivor; the references of the results."""
    o = R.observations(table(s, d, "observation")).where("not coalesce(deleted, false)").select("id", "body_json")
    p = table(s, d, "patient").where("not active").select(F.col("fhir_id").alias("id")).distinct().withColumn("terminal", F.lit("pt-one"))
    out = G.rewrite_bodies(o, ["id"], p)
    return out.select("id", F.get_json_object("body_json", "$.subject.reference").alias("ref"))


QUERIES = {
    "mdm_decision_log": lambda s, d: G.decision_log(*_log(s, d), "run1", NOW).select("id_l", "id_r", "band", F.get_json_object("contributions", "$.g_birth").cast("int").alias("g_birth")),
    "mdm_review_rows": lambda s, d: G.review_rows(_log(s, d)[1], NOW).select("candidate_ids", "suggested_action", "status"),
    "mdm_apply_decisions_all": lambda s, d: _approved_all(s, d)[0].select("review_id", "survivor", "merged"),
    "mdm_apply_errors_all": lambda s, d: _approved_all(s, d)[1],
    "mdm_provenance": lambda s, d: G.provenance(I.resolve(persons(table(s, d, "customer"))), "merge", "resolver", NOW).select(F.get_json_object("body_json", "$.target[0].reference").alias("survivor"), F.get_json_object("body_json", "$.target[1].reference").alias("merged")),
    "audit_event_class": lambda s, d: table(s, d, "events").select("event_id", *[c.alias(n) for c, n in zip(G.event_class(F.expr("element_at(array('GET', 'POST', 'PUT', 'DELETE', 'TRACE'), cast(event_id % 5 as int) + 1)"), F.expr("cast(200 + 100 * (event_id % 4) as int)")), ("action", "outcome"), strict=True)]),
    "search_elements": lambda s, d: G.subset(R.observations(table(s, d, "observation")).where("not coalesce(deleted, false)").select("id", "body_json"), ["status"]).select("id", F.get_json_object("body_json", "$.status").alias("status"), F.expr("json_object_keys(body_json)").alias("keys")).select("id", "status", F.size("keys").alias("n_keys")),
    "promote_rewrite_bodies": _bodies,
    "package_libraries": lambda s, d: G.package(table(s, d, "orders").select(F.col("o_orderkey").alias("questionnaire"), F.concat(F.lit("http://lib/"), (F.col("o_custkey") % 40).cast("string"), F.lit("|1.0")).alias("canonical")), table(s, d, "nation").select(F.concat(F.lit("http://lib/"), F.col("n_nationkey").cast("string")).alias("url"), F.col("n_name").alias("id"))),
}

ORACLES = {
    "mdm_decision_log": f"WITH {_BAND} SELECT id_l, id_r, band, g_birth FROM bands JOIN lv USING (id_l, id_r)",
    "mdm_review_rows": f"WITH {_BAND} SELECT id_l || ',' || id_r AS candidate_ids, CASE band WHEN 'auto_match' THEN 'merge' ELSE 'inspect' END AS suggested_action, 'pending' AS status FROM bands WHERE band IN ('auto_match', 'review')",
    "mdm_apply_decisions_all": """WITH x AS (SELECT a.c_custkey AS k, b.c_custkey AS o, a.c_acctbal AS debt, '2024-01-' || lpad((a.c_custkey % 28 + 1)::varchar, 2, '0') AS ta, '2024-01-' || lpad((b.c_custkey % 28 + 1)::varchar, 2, '0') AS tb FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1 + a.c_nationkey)
       SELECT k::varchar AS review_id, (CASE WHEN ta >= tb THEN k ELSE o END)::varchar AS survivor, (CASE WHEN ta >= tb THEN o ELSE k END)::varchar AS merged FROM x WHERE NOT (debt < 0 AND ta >= tb)""",
    "mdm_apply_errors_all": "SELECT c_custkey::varchar AS review_id, 'patient missing' AS error FROM customer WHERE c_custkey + 1 + c_nationkey NOT IN (SELECT c_custkey FROM customer)",
    "mdm_provenance": f"{_RES} SELECT 'Patient/' || survivor AS survivor, 'Patient/' || merged AS merged FROM res WHERE survivor IS NOT NULL",
    "audit_event_class": "SELECT event_id, ['R', 'C', 'U', 'D', 'E'][(event_id % 5)::int + 1] AS action, ['0', '0', '4', '8'][(event_id % 4)::int + 1] AS outcome FROM events",
    "search_elements": f"WITH {O} SELECT fhir_id AS id, status, (2 + (status IS NOT NULL)::int)::int AS n_keys FROM o",
    "promote_rewrite_bodies": rf"WITH {O} SELECT fhir_id AS id, CASE WHEN regexp_extract(subject.reference, 'Patient/([A-Za-z0-9.\-]+)', 1) IN (SELECT fhir_id FROM patient WHERE NOT active AND fhir_id IS NOT NULL) THEN regexp_replace(subject.reference, 'Patient/[A-Za-z0-9.\-]+', 'Patient/pt-one') ELSE subject.reference END AS ref FROM o",
    "package_libraries": "SELECT DISTINCT o_orderkey AS questionnaire, n_name AS library FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 40",
}
