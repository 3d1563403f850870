"""Identity queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnlake.operators import identity as I
from cairnlake.operators.synthetic import PERSONS_SQL, SSN, persons
from cairnlake.sources.tables import table

KEY = b"rotating key 1"
CFG = I.MatchConfig()
# Fixed weights, so that SQL can recompute the bands.
WEIGHTS = {"g_given": [-3.0, 3.0, 6.0], "g_family": [-3.0, 3.0, 6.0], "g_birth": [-3.0, 8.0], "g_gender": [-2.0, 1.0], "g_postal": [-1.0, 5.0], "prior": [-8.0]}


def _c(s, d):
    return persons(table(s, d, "customer"))


def _records(s, d):
    r = table(s, d, "linkage_record").distinct()
    return r.select("unique_id", F.upper(F.btrim("given_name")).alias("given"), F.upper(F.btrim("family_name")).alias("family"), "birth_date", "gender", "postal_code", "identifier_systems", "identifier_keys", "active", "deceased_datetime")


def _bands(s, d):
    r = _records(s, d)
    pairs = I.scored(I.with_levels(I.blocked_pairs(r, CFG), r), WEIGHTS)
    return I.banded(pairs, r, CFG).select("id_l", "id_r", "band", "reason")


def _fitted(s, d):
    r = _records(s, d)
    lv = I.with_levels(I.blocked_pairs(r, CFG), r)
    return I.scored(lv, I.fit_weights(lv)).select("id_l", "id_r", "match_weight", "match_probability")


def _reviews(s, d):
    """Review rows from orders: a candidate set per customer, one row per order."""
    o = table(s, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("review_id"), F.col("o_custkey").cast("string").alias("candidate_ids"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"), F.expr("case o_orderstatus when 'O' then 'pending' when 'F' then 'escalated' else 'approved' end").alias("status"))


def _chains(s, d):
    """Merged -> survivor edges over customers: k to k - 1 within runs of five, and two cycles."""
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"))
    return c.where("k % 5 <> 0 or k in (10, 20)").select(F.lpad(F.col("k").cast("string"), 9, "0").alias("merged"), F.lpad(F.when(F.col("k").isin(10, 20), F.col("k") + 4).otherwise(F.col("k") - 1).cast("string"), 9, "0").alias("survivor"))


def _rewritten(s, d):
    e = table(s, d, "orders").select("o_orderkey", F.concat(F.lit("https://h/Patient/"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("/_history/2")).otherwise("")).alias("ref"))
    return I.rewrite_references(e, "ref", I.survivor_chains(_chains(s, d)))


QUERIES = {
    "mpi_identifier_keys": lambda s, d: I.identifier_keys(_c(s, d)),
    "mpi_components": lambda s, d: I.components(_c(s, d)),
    "mpi_resolution": lambda s, d: I.resolve(_c(s, d)),
    "mpi_links": lambda s, d: I.link_table(_c(s, d), I.resolve(_c(s, d))),
    "mdm_pair_volume": lambda s, d: I.pair_volume(_records(s, d), CFG.rules),
    "mdm_blocked_pairs": lambda s, d: I.blocked_pairs(_records(s, d), CFG),
    "mdm_levels": lambda s, d: I.with_levels(I.blocked_pairs(_records(s, d), CFG), _records(s, d)),
    "mdm_bands": _bands,
    "mdm_band_counts": lambda s, d: _bands(s, d).groupBy("band").agg(F.count("*").alias("n")),
    "mdm_fitted_scores": _fitted,
    "mdm_queue_latest": lambda s, d: I.latest_reviews(_reviews(s, d)),
    "mdm_queue_ageing": lambda s, d: I.age_reviews(_reviews(s, d), "1998-06-01T00:00:00Z"),
    "mart_review_open": lambda s, d: I.open_reviews(_reviews(s, d)),
    "survivor_terminal": lambda s, d: I.survivor_chains(_chains(s, d)),
    "promote_rewrite_refs": _rewritten,
    "pprl_hmac": lambda s, d: I.hmac_tokens(_records(s, d), ["given", "family", "birth_date"], KEY, "1"),
    "pprl_clk": lambda s, d: I.clk_bits(_records(s, d), ["given", "family", "birth_date"], KEY),
}

_COMP = f"""WITH RECURSIVE {PERSONS_SQL},
 act AS (SELECT * FROM persons WHERE coalesce(active, true)), live AS (SELECT * FROM keys WHERE id IN (SELECT id FROM act)),
 ssn AS (SELECT id, min(key) AS s FROM live WHERE starts_with(key, '{SSN}') GROUP BY id),
 kk AS (SELECT live.*, s FROM live LEFT JOIN ssn USING (id)),
 pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM kk a JOIN kk b ON a.key = b.key AND a.id <> b.id AND (a.s IS NULL OR b.s IS NULL OR a.s = b.s)),
 reach AS (SELECT id AS a, id AS b FROM act UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
 comp AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"""
_RES = f"""{_COMP}, sized AS (SELECT component, count(*) AS size, min(id) AS lo, max(id) AS hi FROM comp GROUP BY component HAVING count(*) > 1),
 j AS (SELECT z.*, l.last_updated AS ul, r.last_updated AS ur, CASE WHEN size > 2 THEN 'multi_match' WHEN sl.s <> sr.s THEN 'distinct'
   WHEN l.gender <> r.gender AND l.gender <> 'unknown' AND r.gender <> 'unknown' THEN 'sex_mismatch'
   WHEN abs(epoch(l.deceased::timestamptz) - epoch(r.deceased::timestamptz)) > 14 * 86400 THEN 'date_of_death_mismatch'
   WHEN NOT l.active OR NOT r.active THEN 'inactive_candidate' END AS reason
  FROM sized z JOIN persons l ON l.id = lo JOIN persons r ON r.id = hi LEFT JOIN ssn sl ON sl.id = lo LEFT JOIN ssn sr ON sr.id = hi),
 res AS (SELECT component, size, CASE WHEN reason IS NULL THEN 'merge' ELSE 'review' END AS decision, reason,
  CASE WHEN reason IS NULL THEN CASE WHEN ul >= ur THEN lo ELSE hi END END AS survivor, CASE WHEN reason IS NULL THEN CASE WHEN ul >= ur THEN hi ELSE lo END END AS merged FROM j)"""
_REC = """rec AS (SELECT DISTINCT unique_id, upper(trim(given_name)) AS given, upper(trim(family_name)) AS family, birth_date, gender, postal_code, identifier_systems, identifier_keys, active, deceased_datetime FROM linkage_record),
 pr AS (SELECT l.unique_id AS id_l, r.unique_id AS id_r FROM rec l JOIN rec r ON l.unique_id < r.unique_id AND l.family = r.family AND l.birth_date = r.birth_date
  UNION SELECT l.unique_id, r.unique_id FROM rec l JOIN rec r ON l.unique_id < r.unique_id AND l.given = r.given AND l.birth_date = r.birth_date
  UNION SELECT l.unique_id, r.unique_id FROM rec l JOIN rec r ON l.unique_id < r.unique_id AND l.postal_code = r.postal_code AND l.family = r.family)"""


def _lv(c: str, name: bool) -> str:
    near = f"WHEN levenshtein(l.{c}, r.{c}) <= 2 THEN 1 " if name else ""
    return f"CASE WHEN l.{c} IS NULL OR r.{c} IS NULL THEN -1 WHEN l.{c} = r.{c} THEN {2 if name else 1} {near}ELSE 0 END::int"


_LEV = f"""{_REC}, lv AS (SELECT id_l, id_r, {_lv('given', True)} AS g_given, {_lv('family', True)} AS g_family, {_lv('birth_date', False)} AS g_birth, {_lv('gender', False)} AS g_gender, {_lv('postal_code', False)} AS g_postal
 FROM pr JOIN rec l ON l.unique_id = id_l JOIN rec r ON r.unique_id = id_r)"""


def _w(c: str) -> str:
    return "CASE " + c + " " + " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(WEIGHTS[c])) + " ELSE 0 END"


_BAND = f"""{_LEV}, sc AS (SELECT *, 1 / (1 + pow(2.0, -({WEIGHTS['prior'][0]} + {' + '.join(_w(c) for c in I.LEVELS)}))) AS p FROM lv),
 gr AS (SELECT id_l, id_r, p, CASE WHEN l.gender <> r.gender AND l.gender <> 'unknown' AND r.gender <> 'unknown' THEN 'sex_mismatch'
   WHEN abs(epoch(l.deceased_datetime::timestamptz) - epoch(r.deceased_datetime::timestamptz)) > 14 * 86400 THEN 'date_of_death_mismatch' WHEN NOT l.active OR NOT r.active THEN 'inactive_candidate' END AS block,
   CASE WHEN coalesce(list_has_any(l.identifier_systems, r.identifier_systems), false) THEN 0.95 ELSE 0.97 END AS need
  FROM sc JOIN rec l ON l.unique_id = id_l JOIN rec r ON r.unique_id = id_r WHERE NOT coalesce(list_has_any(l.identifier_keys, r.identifier_keys), false)),
 bands AS (SELECT id_l, id_r, CASE WHEN p >= need AND block IS NOT NULL THEN 'review' WHEN p >= need THEN 'auto_match' WHEN p >= 0.70 THEN 'review' ELSE 'new' END AS band,
  CASE WHEN p >= need AND block IS NOT NULL THEN 'safety_override:' || block ELSE block END AS reason FROM gr)"""
_REV = """rev AS (SELECT o_orderkey::varchar AS review_id, o_custkey::varchar AS candidate_ids, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_at, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'escalated' ELSE 'approved' END AS status FROM orders),
 last AS (SELECT * FROM rev QUALIFY row_number() OVER (PARTITION BY candidate_ids ORDER BY created_at DESC, review_id DESC) = 1)"""
_TERM = """t AS (SELECT lpad(c_custkey::varchar, 9, '0') AS id, lpad((CASE WHEN c_custkey BETWEEN 10 AND 14 THEN 10 WHEN c_custkey BETWEEN 20 AND 24 THEN 20 ELSE c_custkey - c_custkey % 5 END)::varchar, 9, '0') AS terminal
 FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey IN (10, 20))"""

_IPAD, _OPAD = ("".join(f"\\x{b ^ p:02X}" for b in KEY.ljust(64, b"\0")) for p in (0x36, 0x5C))


def _hmac(text: str) -> str:
    return f"sha256('{_OPAD}'::BLOB || unhex(sha256('{_IPAD}'::BLOB || encode({text}))))"


def _tok(c: str) -> str:
    return f"regexp_replace(upper(strip_accents(coalesce({c}, ''))), '[^A-Z0-9]', '', 'g')"


_GRAMS = """g AS (SELECT unique_id, unnest(list_transform(range(1, length(t) + 2), lambda i: substr('_' || t || '_', i, 2))) AS gram FROM (SELECT unique_id, unnest([{0}]) AS t FROM rec) WHERE t <> '')"""

ORACLES = {
    "pprl_hmac": f"WITH {_REC} SELECT unique_id, '1' AS key_version, {_hmac(" || '|' || ".join(_tok(c) for c in ("given", "family", "birth_date")))} AS token FROM rec",
    "pprl_clk": f"""WITH {_REC}, {_GRAMS.format(", ".join(_tok(c) for c in ("given", "family", "birth_date")))},
       b AS (SELECT DISTINCT unique_id, (('0x' || left({_hmac("gram || '|' || k")}, 8))::BIGINT % 1024) AS pos FROM g, (SELECT unnest([0, 1, 2, 3]) AS k)),
       l AS (SELECT unique_id, list(pos ORDER BY pos) AS bits FROM b GROUP BY unique_id) SELECT r.unique_id, coalesce(l.bits, []) AS bits FROM rec r LEFT JOIN l USING (unique_id)""",
    "mpi_identifier_keys": f"WITH {PERSONS_SQL} SELECT id, key FROM keys",
    "mpi_components": f"{_COMP} SELECT id, component FROM comp",
    "mpi_resolution": f"{_RES} SELECT component, size, decision, reason, survivor, merged FROM res",
    "mpi_links": f"{_RES} SELECT key, coalesce(min(res.survivor), min(live.id)) AS id FROM live LEFT JOIN res ON res.merged = live.id GROUP BY key",
    "mdm_pair_volume": f"WITH {_REC} " + " UNION ALL ".join(f"SELECT '{'+'.join(r)}' AS rule, coalesce(sum(n * (n - 1) // 2), 0)::bigint AS pairs FROM (SELECT count(*) AS n FROM rec WHERE {' AND '.join(f'{c} IS NOT NULL' for c in r)} GROUP BY {', '.join(r)})" for r in CFG.rules),
    "mdm_blocked_pairs": f"WITH {_REC} SELECT id_l, id_r FROM pr",
    "mdm_levels": f"WITH {_LEV} SELECT * FROM lv",
    "mdm_bands": f"WITH {_BAND} SELECT * FROM bands",
    "mdm_band_counts": f"WITH {_BAND} SELECT band, count(*) AS n FROM bands GROUP BY band",
    "mdm_queue_latest": f"WITH {_REV} SELECT * FROM last",
    "mdm_queue_ageing": f"WITH {_REV} SELECT candidate_ids, status AS from_status, CASE status WHEN 'pending' THEN 'escalated' ELSE 'auto_aged_out' END AS to_status FROM last WHERE status IN ('pending', 'escalated') AND epoch(timestamp '1998-06-01') - epoch(created_at::timestamp) > CASE status WHEN 'pending' THEN 7 ELSE 14 END * 86400",
    "mart_review_open": f"WITH {_REV} SELECT * FROM last WHERE status = 'pending'",
    "survivor_terminal": f"WITH {_TERM} SELECT * FROM t",
    "promote_rewrite_refs": f"WITH {_TERM} SELECT o_orderkey, 'https://h/Patient/' || coalesce(terminal, lpad(o_custkey::varchar, 9, '0')) || CASE WHEN o_orderkey % 2 = 0 THEN '/_history/2' ELSE '' END AS ref FROM orders LEFT JOIN t ON t.id = lpad(o_custkey::varchar, 9, '0')",
}
