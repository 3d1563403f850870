"""Promotion and streaming queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnlake.operators import changefeed, promote
from cairnlake.operators.identity import resolve
from cairnlake.operators.synthetic import persons
from cairnlake.queries.identity import _RES
from cairnlake.session import scratch
from cairnlake.sources.tables import table
from cairnlake.sources.versioned import VersionedTable
from cairnlake.streaming import feed

ELEMENTS = {"status": "code", "resourceType": "code", "item": "json", "meta": "json"}


def _dir(s, name):
    return scratch(s, name)


def _incremental(s, d):
    """The feed in fifteen deliveries, a seventh of it delivered once more three deliveries later."""
    b = table(s, d, "bronze").select("resource_type", "id", "version_id", "_commit_version", "deleted")
    most = b.agg(F.max("_commit_version")).first()[0] or 0
    b = b.withColumn("delivery", F.floor(F.col("_commit_version") * 12 / F.lit(most + 1)).cast("int"))
    again = b.where("_commit_version % 7 = 3").withColumn("delivery", F.col("delivery") + 3)
    at = _dir(s, "feed")
    feed.deliver(b.unionByName(again), at, "delivery")
    target = VersionedTable(s, _dir(s, "current"), buckets=8)
    feed.incremental(feed.read_stream(s, at, b, files=1), target, _dir(s, "cp"))
    return target.read().where("not coalesce(deleted, false)").select("resource_type", "id", "version_id", "_commit_version")


def _events(s, d, late=True):
    """The events as a stream of two days a delivery; of those of the first 22 days, every twentieth comes eight days late."""
    e = table(s, d, "events")
    at = _dir(s, "events")
    own = F.least(F.floor((F.dayofmonth("ts") - 1) / 2), F.lit(14)).cast("int")
    x = e.withColumn("delivery", F.when((F.col("event_id") % 20 == 7) & (own < 11) & late, own + 4).otherwise(own))
    feed.deliver(x, at, "delivery")
    return feed.read_stream(s, at, x, files=1)


def _windowed(query):
    return lambda s, d: feed.collect_stream(query(_events(s, d)), _dir(s, "out"), _dir(s, "cp"))


def _fixed(s, d):
    return feed.collect_stream(feed.fixed_windows(_events(s, d, late=False), 86400), _dir(s, "out"), _dir(s, "cp"), "append")


def _merged(s, d):
    c = persons(table(s, d, "customer"))
    p = c.select("id", "active", F.lit(True).alias("is_current"), F.transform("identifier", lambda i: F.concat_ws("|", i["system"], F.btrim(i["value"]))).alias("index"))
    return promote.apply_merges(p, resolve(c)).where("replaces is not null or not is_current").select("id", "active", "is_current", F.size("index").alias("n_index"), F.coalesce(F.size("replaces"), F.lit(-1)).alias("n_replaces"))


QUERIES = {
    "promote_gold": lambda s, d: promote.gold(table(s, d, "bronze")).select("resource_type", "id", "version_id"),
    "promote_merge_gold": lambda s, d: promote.merge_gold(changefeed.apply_changes(None, table(s, d, "bronze").where("_commit_version % 2 = 0")), table(s, d, "bronze")).select("resource_type", "id", "version_id", "_commit_version"),
    "promote_silver": lambda s, d: promote.silver(table(s, d, "bronze"), "QuestionnaireResponse", ELEMENTS).select("silver_id", "fhir_id", "version_id", "deleted", "status"),
    "promote_silver_nested": lambda s, d: promote.silver_nested(table(s, d, "bronze"), "Patient", {"gender": "code", "name": [{"family": "string", "given": ["string"]}]}).select("id", "deleted", "gender", F.coalesce(F.size("name"), F.lit(-1)).alias("n_names"), F.get("name", 0)["family"].alias("family")),
    "promote_apply_merges": _merged,
    "promote_lineage": lambda s, d: promote.lineage_edges(table(s, d, "customer").select(F.concat(F.lit("t"), (F.col("c_custkey") % 40).cast("string")).alias("name"), F.expr("element_at(array('bronze', 'silver', 'gold'), cast(c_custkey * c_custkey % 3 as int) + 1)").alias("tier"))),
    "promote_schema_drift": lambda s, d: promote.schema_drift(table(s, d, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_brand").alias("hash")).where("key % 10 <> 3"), table(s, d, "part").select(F.col("p_partkey").cast("string").alias("key"), F.expr("if(p_partkey % 7 = 0, 'x', p_brand)").alias("hash")).where("key % 10 <> 4")),
    "stream_incremental_upsert": _incremental,
    "stream_fixed_window": _fixed,
    "stream_tumbling": _windowed(lambda e: feed.tumbling(e, "1 day", "1 hour")),
    "stream_sliding": _windowed(lambda e: feed.sliding(e, "2 days", "1 day", "1 hour")),
    "stream_session": _windowed(lambda e: feed.sessions(e, "12 hours", "1 hour")),
}

_LAST = "last AS (SELECT * FROM bronze WHERE id IS NOT NULL AND resource_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY resource_type, id ORDER BY version_id DESC NULLS LAST, _commit_version DESC) = 1)"
_TIMELY = "WITH mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS t FROM events), e AS (SELECT * FROM events WHERE NOT (event_id % 20 = 7 AND (day(ts) - 1) // 2 < 11))"
ORACLES = {
    "promote_gold": f"WITH {_LAST} SELECT resource_type, id, version_id FROM last WHERE NOT coalesce(deleted, false)",
    "promote_merge_gold": f"WITH {_LAST} SELECT resource_type, id, version_id, _commit_version FROM last WHERE NOT coalesce(deleted, false)",
    "promote_silver": f"WITH {_LAST} SELECT resource_type || '/' || id || '/' || version_id AS silver_id, id AS fhir_id, version_id, coalesce(deleted, false) AS deleted, CASE WHEN json_valid(body_json) THEN json_extract_string(body_json, '$.status') END AS status FROM last WHERE resource_type = 'QuestionnaireResponse'",
    "promote_silver_nested": f"WITH {_LAST} SELECT id, coalesce(deleted, false) AS deleted, json_extract_string(b, '$.gender') AS gender, coalesce(CASE WHEN json_type(b, '$.name') = 'ARRAY' THEN json_array_length(b, '$.name') END, -1)::int AS n_names, json_extract_string(b, '$.name[0].family') AS family FROM (SELECT *, CASE WHEN json_valid(body_json) THEN body_json END AS b FROM last WHERE resource_type = 'Patient')",
    "promote_apply_merges": f"""{_RES}, ix AS (SELECT id, trim(i) AS e FROM (SELECT id, unnest([(CASE WHEN k % 2 = 0 THEN 'http://hosp.example.org/mrn|' ELSE 'HTTP://Hosp.Example.org/mrn/|' END) || CASE WHEN k % 50 < 2 THEN k - k % 50 ELSE k END,
         CASE WHEN (k + 20) % 90 < 3 THEN 'urn:ins|' || (k + 20 - (k + 20) % 90) END, CASE WHEN k % 150 < 2 OR k % 9 = 4 THEN 'http://hl7.org/fhir/sid/us-ssn|9-' || k END]) AS i FROM persons) WHERE i IS NOT NULL),
       w AS (SELECT p.id, p.active, r.survivor, r.merged FROM persons p JOIN res r ON decision = 'merge' AND p.id IN (r.survivor, r.merged))
       SELECT id, CASE WHEN id = merged THEN false ELSE active END AS active, id <> merged AS is_current, (SELECT count(DISTINCT e) FROM ix WHERE ix.id = w.id OR (w.id = w.survivor AND ix.id = w.merged))::int AS n_index, CASE WHEN id = survivor THEN 1 ELSE -1 END AS n_replaces FROM w""",
    "promote_lineage": "WITH t AS (SELECT DISTINCT 't' || c_custkey % 40 AS name, ['bronze', 'silver', 'gold'][(c_custkey * c_custkey % 3)::int + 1] AS tier FROM customer) SELECT a.name, a.tier AS from_tier, b.tier AS to_tier FROM t a JOIN t b ON a.name = b.name AND (a.tier, b.tier) IN (('bronze', 'silver'), ('silver', 'gold'))",
    "promote_schema_drift": "SELECT p_partkey::varchar AS key, CASE WHEN p_partkey % 10 = 3 THEN 'added' WHEN p_partkey % 10 = 4 THEN 'removed' ELSE 'changed' END AS drift FROM part WHERE p_partkey % 10 IN (3, 4) OR (p_partkey % 7 = 0 AND p_brand <> 'x')",
    "stream_incremental_upsert": f"WITH {_LAST} SELECT resource_type, id, version_id, _commit_version FROM last WHERE NOT coalesce(deleted, false)",
    "stream_fixed_window": """WITH RECURSIVE e AS (SELECT user_id, epoch(ts)::bigint AS t, row_number() OVER (PARTITION BY user_id ORDER BY epoch(ts)::bigint) AS k FROM (SELECT user_id, date_trunc('second', ts) AS ts FROM events)),
       w AS (SELECT user_id, t, k, t AS window_start, 1::bigint AS hits FROM e WHERE k = 1 UNION ALL SELECT e.user_id, e.t, e.k, CASE WHEN e.t >= w.window_start + 86400 THEN e.t ELSE w.window_start END, CASE WHEN e.t >= w.window_start + 86400 THEN 1 ELSE w.hits + 1 END FROM w JOIN e ON e.user_id = w.user_id AND e.k = w.k + 1)
       SELECT user_id, t, window_start, hits FROM w""",
    # Windows that ended an hour before the newest event, without the late events.
    "stream_tumbling": f"{_TIMELY} SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, sum(value) AS total FROM e GROUP BY date_trunc('day', ts), event_type HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT t FROM mark)",
    "stream_sliding": f"{_TIMELY} SELECT date_trunc('day', ts) - to_days(k::int) AS start, count(*) AS n FROM e, (SELECT unnest([0, 1]) AS k) GROUP BY date_trunc('day', ts) - to_days(k::int) HAVING date_trunc('day', ts) - to_days(k::int) + INTERVAL 2 DAY <= (SELECT t FROM mark)",
    "stream_session": f"{_TIMELY}, b AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS s FROM e), g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, s ROWS UNBOUNDED PRECEDING) AS n FROM b) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, g.n HAVING max(ts) + INTERVAL 12 HOUR <= (SELECT t FROM mark)",
}
