"""Queries on the versioned store and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnlake.operators import changefeed, store
from cairnlake.sources.tables import table

HOT = "dv-intake-gateway-01"


def _b(s, d):
    return table(s, d, "bronze")


def _upsert(s, d):
    """Late patient rows (version above 1) merged into the others by fhir_id."""
    p = table(s, d, "patient").select("fhir_id", "version_id", "gender", "birthDate").distinct()
    source = p.where("version_id >= 2").withColumn("gender", F.lit("updated"))
    return store.upsert(p, source, ["fhir_id"])


def _writes(s, d):
    """New versions of every tenth delivery's resource, half of them from an outdated version."""
    b = _b(s, d).select("resource_type", "id", "version_id", "_commit_version", "deleted", "is_current")
    w = changefeed.latest(b).where("_commit_version % 10 < 2").select("resource_type", "id", F.lit(None).cast("bigint").alias("version_id"), (F.col("_commit_version") + 1000000000).alias("_commit_version"), F.lit(False).alias("deleted"), F.lit(True).alias("is_current"), F.when(F.col("_commit_version") % 10 == 0, F.col("version_id")).otherwise(F.col("version_id") - 1).alias("expected_version"))
    return b, w


def _written(s, d):
    b, w = _writes(s, d)
    return store.append_versions(b, w)[0].where("_commit_version > 1000000000").select("resource_type", "id", "version_id", "is_current")


def _refused(s, d):
    b, w = _writes(s, d)
    return store.append_versions(b, w)[1].select("resource_type", "id", "expected_version")


QUERIES = {
    "store_current": lambda s, d: store.current(_b(s, d)).select("resource_type", "id", "version_id", "_commit_version"),
    "store_point_read": lambda s, d: store.point_read(_b(s, d), "Device", HOT).select("id", "version_id", "_commit_version", "state"),
    "store_version_read": lambda s, d: store.version_read(_b(s, d), "Device", HOT, 3).select("id", "version_id", "_commit_version"),
    "store_history_instance": lambda s, d: store.history_instance(_b(s, d), "Device", HOT),
    "store_history_type": lambda s, d: store.history_type(_b(s, d), "Patient"),
    "store_history_system": lambda s, d: store.history_system([_b(s, d).where(F.col("resource_type") == t) for t in ("ClaimResponse", "Device", "Observation", "Patient", "QuestionnaireResponse")]),
    "store_backfill_current": lambda s, d: store.backfill_current(_b(s, d)).select("_commit_version", "is_current"),
    "store_upsert": _upsert,
    "store_append_versions": _written,
    "store_append_conflicts": _refused,
    "store_delete": lambda s, d: store.delete_where(_b(s, d), (F.col("resource_type") == "Device") & F.col("deleted")).select("_commit_version"),
    "store_identifier_search": lambda s, d: _b(s, d).where(F.exists("identifier_index", lambda e: (e["system"] == "urn:ids:pain") & (e["typeCode"] == "MR"))).select("resource_type", "id").distinct(),
}

_ENTRY = """CASE WHEN coalesce(deleted, false) THEN 'DELETE' WHEN version_id = 1 THEN 'POST' ELSE 'PUT' END AS method,
 CASE WHEN coalesce(deleted, false) THEN '204' WHEN version_id = 1 THEN '201' ELSE '200' END AS status, 'W/"' || version_id || '"' AS etag"""
_TIP = """tip AS (SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY resource_type, id ORDER BY version_id DESC NULLS LAST, _commit_version DESC) = 1),
 w AS (SELECT resource_type, id, version_id AS v, CASE WHEN _commit_version % 10 = 0 THEN version_id ELSE version_id - 1 END AS expected_version FROM tip WHERE _commit_version % 10 < 2)"""

ORACLES = {
    "store_current": "SELECT resource_type, id, version_id, _commit_version FROM bronze WHERE is_current AND NOT coalesce(deleted, false)",
    "store_point_read": f"SELECT id, version_id, _commit_version, CASE WHEN deleted THEN 'gone' ELSE 'live' END AS state FROM bronze WHERE resource_type = 'Device' AND id = '{HOT}' ORDER BY version_id DESC, _commit_version DESC LIMIT 1",
    "store_version_read": f"SELECT id, version_id, _commit_version FROM bronze WHERE resource_type = 'Device' AND id = '{HOT}' AND version_id = 3",
    "store_history_instance": f"SELECT id, version_id, _commit_version, {_ENTRY} FROM bronze WHERE resource_type = 'Device' AND id = '{HOT}'",
    "store_history_type": f"SELECT id, version_id, _commit_version, last_updated, {_ENTRY} FROM bronze WHERE resource_type = 'Patient'",
    "store_history_system": f"SELECT resource_type, id, version_id, _commit_version, last_updated, {_ENTRY} FROM bronze",
    "store_backfill_current": "SELECT _commit_version, coalesce(version_id = max(version_id) OVER (PARTITION BY resource_type, id), false) AS is_current FROM bronze",
    "store_upsert": """WITH p AS (SELECT DISTINCT fhir_id, version_id, gender, birthDate FROM patient)
       SELECT fhir_id, version_id, CASE WHEN version_id >= 2 THEN 'updated' ELSE gender END AS gender, birthDate FROM p
       WHERE version_id >= 2 OR fhir_id NOT IN (SELECT fhir_id FROM p WHERE version_id >= 2)""",
    "store_append_versions": f"WITH {_TIP} SELECT resource_type, id, v + 1 AS version_id, true AS is_current FROM w WHERE expected_version = v",
    "store_append_conflicts": f"WITH {_TIP} SELECT resource_type, id, expected_version FROM w WHERE expected_version <> v",
    "store_delete": "SELECT _commit_version FROM bronze WHERE NOT coalesce(resource_type = 'Device' AND deleted, false)",
    "store_identifier_search": "SELECT DISTINCT resource_type, id FROM (SELECT resource_type, id, unnest(identifier_index) AS e FROM bronze) WHERE e.system = 'urn:ids:pain' AND e.typeCode = 'MR'",
}
