"""Queries of the general data problems (1, 2, 3, 5) and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnlake.operators import changefeed, instants, nested, orphans
from cairnlake.sources.tables import table


def _tables(spark, d, names):
    return [table(spark, d, n) for n in names.split()]


def _cells(rows):
    """Child tables with the elements' fields as sorted text."""
    cells = F.transform(F.map_entries("fields"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("_commit_version", "array_path", "node_path", "parent_path", "ordinal", F.array_join(F.array_sort(cells), "\n").alias("cells"))


QUERIES = {
    "p1_found": lambda s, d: instants.found(*_tables(s, d, "bronze observation specimen patient ingest_source")),
    "p2_found": lambda s, d: nested.found(table(s, d, "bronze")),
    "p2_answers": lambda s, d: nested.child_table(table(s, d, "bronze"), "body_json", ["_commit_version"], ["item", "answer"], ["valueBoolean", "valueInteger", "valueString"]),
    "p2_tables": lambda s, d: _cells(nested.child_tables(table(s, d, "bronze"), "body_json", ["_commit_version"])),
    "p2_table_sizes": lambda s, d: nested.element_rows(table(s, d, "bronze"), "body_json", ["_commit_version"]).groupBy("array_path").agg(F.count("*").alias("n"), F.max("ordinal").alias("last"), F.count_distinct("_commit_version", "parent_path").alias("parents")),
    "p3_found": lambda s, d: orphans.found(*_tables(s, d, "observation imagingstudy claimresponse patient organization")),
    "p3_per_month": lambda s, d: orphans.per_month(*_tables(s, d, "observation imagingstudy claimresponse patient organization")),
    "p5_found": lambda s, d: changefeed.found(table(s, d, "bronze")),
    "p5_current_rows": lambda s, d: changefeed.current_rows(table(s, d, "bronze")).select("resource_type", "id", "version_id", "_commit_version", "body_json"),
}

_REFS = """
 refs AS (
  SELECT 'observation' AS source_table, fhir_id, 'subject.reference' AS field_path, governed_at, subject.reference AS ref FROM observation
  UNION ALL SELECT 'imagingstudy', fhir_id, 'subject.reference', governed_at, subject.reference FROM imagingstudy
  UNION ALL SELECT 'claimresponse', fhir_id, 'patient.reference', governed_at, patient.reference FROM claimresponse
  UNION ALL SELECT 'claimresponse', fhir_id, 'insurer.reference', governed_at, insurer.reference FROM claimresponse),
 named AS (SELECT *, regexp_extract(regexp_replace(regexp_replace(ref, '^\\s+|\\s+$', '', 'g'), '/_history/.*$', ''), '([^/]*/[^/]*)$', 1) AS target FROM refs
  WHERE regexp_replace(ref, '^\\s+|\\s+$', '', 'g') <> '' AND NOT starts_with(regexp_replace(ref, '^\\s+|\\s+$', '', 'g'), '#')),
 parents AS (SELECT 'Patient/' || fhir_id AS key, deleted, governed_at AS since FROM patient
  UNION ALL SELECT 'Organization/' || fhir_id, deleted, governed_at FROM organization),
 live AS (SELECT key, max(since) AS since FROM parents GROUP BY key HAVING NOT bool_or(coalesce(deleted, false))),
 bad AS (SELECT DISTINCT source_table, fhir_id, field_path, strftime(n.governed_at AT TIME ZONE 'UTC', '%Y-%m') AS month
  FROM named n LEFT JOIN live l ON n.target = l.key WHERE l.key IS NULL OR l.since > n.governed_at)
"""
_WINNERS = """SELECT resource_type, id, version_id, _commit_version, body_json FROM (
  SELECT *, row_number() OVER (PARTITION BY resource_type, id ORDER BY version_id DESC NULLS LAST, _commit_version DESC) AS r FROM bronze
  WHERE resource_type IS NOT NULL AND id IS NOT NULL) WHERE r = 1 AND NOT coalesce(deleted, false)"""

ORACLES = {
    "p2_answers": r"""SELECT b._commit_version, t.fullkey AS node_path, regexp_extract(t.fullkey, '^(.*\])\.answer\[[0-9]+\]$', 1) AS parent_path, regexp_extract(t.fullkey, '\[([0-9]+)\]$', 1)::int AS ordinal,
       json_extract_string(t.value, '$.valueBoolean') AS valueBoolean, json_extract_string(t.value, '$.valueInteger') AS valueInteger, json_extract_string(t.value, '$.valueString') AS valueString
       FROM (SELECT _commit_version, body_json FROM bronze WHERE json_valid(body_json)) b, json_tree(b.body_json) t
       WHERE t.type = 'OBJECT' AND regexp_matches(t.fullkey, '^\$\.item\[[0-9]+\]\.answer\[[0-9]+\]$')""",
    "p2_tables": r"""SELECT b._commit_version, regexp_replace(t.fullkey, '\[[0-9]+\]', '[]', 'g') AS array_path, t.fullkey AS node_path,
       coalesce(nullif(regexp_extract(regexp_replace(t.fullkey, '\[[0-9]+\]$', ''), '^(.*\])', 1), ''), '$') AS parent_path, regexp_extract(t.fullkey, '\[([0-9]+)\]$', 1)::int AS ordinal,
       array_to_string(list_sort(list_transform(list_filter(json_keys(t.value), lambda k: json_type(t.value, '$."' || k || '"') NOT IN ('OBJECT', 'ARRAY', 'NULL')), lambda k: k || '=' || json_extract_string(t.value, '$."' || k || '"'))), chr(10)) AS cells
       FROM (SELECT _commit_version, body_json FROM bronze WHERE json_valid(body_json)) b, json_tree(b.body_json) t
       WHERE t.type = 'OBJECT' AND ends_with(t.fullkey, ']')""",
    "p2_table_sizes": r"""WITH t AS (SELECT b._commit_version AS c, regexp_replace(t.fullkey, '\[[0-9]+\]', '[]', 'g') AS array_path, regexp_replace(t.fullkey, '\[[0-9]+\]$', '') AS holder, regexp_extract(t.fullkey, '\[([0-9]+)\]$', 1)::int AS ordinal
       FROM (SELECT _commit_version, body_json FROM bronze WHERE json_valid(body_json)) b, json_tree(b.body_json) t WHERE t.type = 'OBJECT' AND ends_with(t.fullkey, ']'))
       SELECT array_path, count(*) AS n, max(ordinal) AS last, count(DISTINCT (c, coalesce(nullif(regexp_extract(holder, '^(.*\])', 1), ''), '$'))) AS parents FROM t GROUP BY array_path""",
    "p2_found": r"""SELECT b._commit_version, t.fullkey AS node_path,
       coalesce(nullif(regexp_extract(regexp_replace(t.fullkey, '\[[0-9]+\]$', ''), '^(.*\])', 1), ''), '$') AS parent_path
       FROM (SELECT _commit_version, body_json FROM bronze WHERE json_valid(body_json)) b, json_tree(b.body_json) t
       WHERE t.type = 'OBJECT' AND ends_with(t.fullkey, ']')""",
    "p3_found": f"WITH {_REFS} SELECT DISTINCT source_table, fhir_id, field_path FROM bad",
    "p3_per_month": f"WITH {_REFS} SELECT source_table, field_path, month, count(*) AS orphans FROM bad GROUP BY ALL",
    "p5_found": f"SELECT resource_type, id, version_id, _commit_version FROM ({_WINNERS})",
    "p5_current_rows": _WINNERS,
}
