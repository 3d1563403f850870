"""Identity resolution by shared identifiers and by scored pairs.

Deterministic: normalised identifiers make components; a component of two is a
merge (the latest write survives) or, if a guardrail speaks against it, a
review; a larger one is always a review. Members of an identifier are joined
to one of them, never to each other in all pairs: where a member has no
authoritative number, everyone may be joined to it; where all have one, those
with equal numbers are. That gives the components that all compatible pairs
would give, so an identifier shared by a third of all records costs no more
than its rows.

Probabilistic: one equi-join per blocking rule (refused above a stated number
of pairs, counted beforehand without joining), agreement levels, weights by
expectation-maximisation over pattern counts, three bands with guardrails.

Odd cases: records without identifiers are components of their own; null or
blank identifier values are no identifiers; ties between writes go to the
smaller id; cycles of survivors end at their smallest id.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnlake.operators.components import connected_components
from cairnlake.operators.synthetic import SSN


def normalize_identifier(system: Column, value: Column) -> Column:
    """``system|value``: lower-case scheme and host, no trailing slashes, single spaces, digits only for the national number; null without a value."""
    s = F.btrim(F.coalesce(system, F.lit("")))
    host = F.regexp_extract(s, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    s = F.rtrim(F.when(host != "", F.concat(F.lower(host), F.substr(s, F.length(host) + 1))).otherwise(s), F.lit("/"))
    v = F.btrim(F.regexp_replace(value, r"\s+", " "))
    v = F.when(s == SSN, F.regexp_replace(v, r"\D", "")).otherwise(v)
    return F.when(F.btrim(F.coalesce(value, F.lit(""))) != "", F.concat_ws("|", s, v))


def identifier_keys(df: DataFrame) -> DataFrame:
    """(id, key) of every distinct normalised identifier."""
    x = df.select("id", F.explode("identifier").alias("i"))
    return x.select("id", normalize_identifier(F.col("i.system"), F.col("i.value")).alias("key")).where("key is not null").distinct()


def links(df: DataFrame) -> DataFrame:
    """Edges (a, b, key) between records that share a key and have no conflicting national numbers; see the module's text."""
    keys = identifier_keys(df)
    ssn = keys.where(F.col("key").startswith(SSN + "|")).groupBy("id").agg(F.min("key").alias("ssn"))
    k = keys.join(ssn, "id", "left")
    hubs = k.groupBy("key").agg(F.min(F.when(F.col("ssn").isNull(), F.col("id"))).alias("free"), F.count("*").alias("n"))
    own = k.groupBy("key", "ssn").agg(F.min("id").alias("first"))
    j = k.join(hubs.where("n > 1"), "key").join(own.where("ssn is not null"), ["key", "ssn"], "left")
    return j.select("key", F.coalesce("free", "first").alias("a"), F.col("id").alias("b")).where("a <> b").select("a", "b", "key")


def candidates(df: DataFrame) -> DataFrame:
    """Records that take part in resolution: not inactive. A merged-away record must not join others."""
    return df.where(F.coalesce("active", F.lit(True)))


def components(df: DataFrame) -> DataFrame:
    """(id, component) of every record that isn't inactive."""
    df = candidates(df)
    nodes = connected_components(links(df).select("a", "b"))
    return df.select("id").distinct().join(nodes.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def guardrail(a: str, b: str, days: int = 14) -> Column:
    """Why a pair may not be merged, or null; columns of the two sides are ``{a}.x`` and ``{b}.x``."""
    col = lambda s, c: F.col(f"{s}.{c}")
    sex = [col(s, "gender") for s in (a, b)]
    dead = [F.try_to_timestamp(col(s, "deceased")) for s in (a, b)]
    return (
        F.when(col(a, "ssn") != col(b, "ssn"), "distinct")
        .when((sex[0] != sex[1]) & (sex[0] != "unknown") & (sex[1] != "unknown"), "sex_mismatch")
        .when(F.abs(F.unix_seconds(dead[0]) - F.unix_seconds(dead[1])) > days * 86400, "date_of_death_mismatch")
        .when((col(a, "active") == F.lit(False)) | (col(b, "active") == F.lit(False)), "inactive_candidate")
    )


def resolve(df: DataFrame, days: int = 14) -> DataFrame:
    """One row per component of several: members' count, decision, reason, survivor and merged id.

    Members are joined to their component's smallest record; only pairs decide, so no list of members is built.
    """
    df = candidates(df)
    keys = identifier_keys(df)
    ssn = keys.where(F.col("key").startswith(SSN + "|")).groupBy("id").agg(F.min("key").alias("ssn"))
    c = components(df)
    sized = c.groupBy("component").agg(F.count("*").alias("size"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("size > 1")
    rec = df.select("id", "gender", "deceased", "active", "last_updated").join(ssn, "id", "left")
    two = sized.join(rec.alias("l"), F.col("lo") == F.col("l.id")).join(rec.alias("r"), F.col("hi") == F.col("r.id"))
    block = guardrail("l", "r", days)
    reason = F.when(F.col("size") > 2, "multi_match").otherwise(block)
    first = F.col("l.last_updated") >= F.col("r.last_updated")
    merge = reason.isNull()
    return two.select(
        "component", "size", F.when(merge, "merge").otherwise("review").alias("decision"), reason.alias("reason"),
        F.when(merge, F.when(first, F.col("lo")).otherwise(F.col("hi"))).alias("survivor"),
        F.when(merge, F.when(first, F.col("hi")).otherwise(F.col("lo"))).alias("merged"),
    )


def link_table(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """Identifier to record: the survivor after a merge, else the first writer (smallest id) of the identifier."""
    merged = decisions.where("decision = 'merge'").select(F.col("merged").alias("id"), "survivor")
    k = identifier_keys(candidates(df)).join(merged, "id", "left")
    return k.groupBy("key").agg(F.coalesce(F.min("survivor"), F.min("id")).alias("id"))


def survivor_chains(edges: DataFrame) -> DataFrame:
    """(id, terminal) of merged -> survivor edges, followed to the end; a cycle ends at its smallest id."""
    from cairnlake.session import shared_dir

    shared_dir(edges.sparkSession)
    e = edges.select("merged", "survivor").where("merged <> survivor").groupBy("merged").agg(F.min("survivor").alias("survivor"))
    cur = e.select(F.col("merged").alias("id"), F.col("survivor").alias("at"), F.least("merged", "survivor").alias("low")).checkpoint()
    # Each round doubles the steps taken; no chain is longer than there are edges.
    for _ in range(max(1, cur.count()).bit_length() + 1):
        nxt = cur.select(F.col("id").alias("at"), F.col("at").alias("to"), F.col("low").alias("low2"))
        new = cur.join(nxt, "at", "left").select("id", F.coalesce("to", "at").alias("at"), F.least("low", F.coalesce("low2", "low")).alias("low"), F.col("to").isNotNull().alias("moved")).checkpoint()
        cur = new.select("id", "at", "low")
        if new.where("moved").isEmpty():
            break
    # What hasn't come to an end by then goes round in a cycle.
    ends = cur.select(F.col("id").alias("at"), F.lit(True).alias("inside"))
    return cur.join(ends, "at", "left").select("id", F.when(F.col("inside"), F.col("low")).otherwise(F.col("at")).alias("terminal"))


def rewrite_reference(ref: Column, survivor: Column, kind: str = "Patient") -> Column:
    """A reference with its exact id token replaced; history and base stay."""
    return F.when(survivor.isNotNull(), F.regexp_replace(ref, F.lit(rf"{kind}/[A-Za-z0-9.\-]+(?=/|$)"), F.concat(F.lit(kind + "/"), survivor))).otherwise(ref)


def rewrite_references(df: DataFrame, column: str, survivors: DataFrame, kind: str = "Patient") -> DataFrame:
    """``df`` with the references of merged records led to their terminal survivor.

    The map's size is Catalyst's to check: broadcast if small, else a shuffle join.
    """
    key = F.regexp_extract(F.col(column), rf"{kind}/([A-Za-z0-9.\-]+)(?:/|$)", 1)
    m = survivors.select(F.col("id").alias("_m"), F.col("terminal").alias("_t"))
    return df.withColumn("_k", key).join(m, F.col("_k") == F.col("_m"), "left").withColumn(column, rewrite_reference(F.col(column), F.col("_t"), kind)).drop("_k", "_m", "_t")


@dataclass(frozen=True)
class MatchConfig:
    """Thresholds and blocking rules; ``check`` refuses unsafe ones."""

    auto: float = 0.95
    cross_authority: float = 0.97
    review: float = 0.70
    days: int = 14
    max_pairs: int = 25_000_000
    rules: tuple[tuple[str, ...], ...] = (("family", "birth_date"), ("given", "birth_date"), ("postal_code", "family"))
    acknowledged: bool = False
    levels: dict[str, str] = field(default_factory=dict)

    def check(self) -> None:
        if self.auto < 0.90:
            raise ValueError("the automatic threshold has a floor of 0.90")
        if self.auto < 0.95 and not self.acknowledged:
            raise ValueError("an automatic threshold below 0.95 must be acknowledged")
        if not self.review < self.auto <= self.cross_authority:
            raise ValueError("thresholds must rise: review, auto, cross authority")


def pair_volume(records: DataFrame, rules: tuple[tuple[str, ...], ...]) -> DataFrame:
    """Pairs that each blocking rule would compare, by counting only."""
    out = None
    for rule in rules:
        n = records.dropna(subset=list(rule)).groupBy(*rule).agg(F.count("*").alias("n"))
        part = n.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("pairs")).select(F.lit("+".join(rule)).alias("rule"), "pairs")
        out = part if out is None else out.unionByName(part)
    assert out is not None
    return out


def blocked_pairs(records: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Distinct pairs l < r that any rule brings together; refused above ``max_pairs``."""
    total = pair_volume(records, cfg.rules).agg(F.sum("pairs")).first()[0] or 0
    if total > cfg.max_pairs:
        raise ValueError(f"{total} candidate pairs; at most {cfg.max_pairs} are allowed: tighten the blocking rules")
    out = None
    for rule in cfg.rules:
        part = records.alias("l").join(records.alias("r"), [F.col(f"l.{c}") == F.col(f"r.{c}") for c in rule] + [F.col("l.unique_id") < F.col("r.unique_id")]).select(F.col("l.unique_id").alias("id_l"), F.col("r.unique_id").alias("id_r"))
        out = part if out is None else out.unionByName(part)
    assert out is not None
    return out.distinct()


def name_level(a: Column, b: Column) -> Column:
    """2 equal, 1 within two edits, 0 else, -1 unknown."""
    return F.when(a.isNull() | b.isNull(), -1).when(a == b, 2).when(F.levenshtein(a, b, 2) >= 0, 1).otherwise(0)


def exact_level(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), -1).when(a == b, 1).otherwise(0)


def with_levels(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Agreement levels of each pair."""
    r = records.select("unique_id", "given", "family", "birth_date", "gender", "postal_code")
    j = pairs.join(r.alias("l"), F.col("id_l") == F.col("l.unique_id")).join(r.alias("r"), F.col("id_r") == F.col("r.unique_id"))
    c = lambda n: (F.col(f"l.{n}"), F.col(f"r.{n}"))
    return j.select("id_l", "id_r", name_level(*c("given")).alias("g_given"), name_level(*c("family")).alias("g_family"), exact_level(*c("birth_date")).alias("g_birth"), exact_level(*c("gender")).alias("g_gender"), exact_level(*c("postal_code")).alias("g_postal"))


LEVELS = {"g_given": 3, "g_family": 3, "g_birth": 2, "g_gender": 2, "g_postal": 2}


def fit_weights(levelled: DataFrame, rounds: int = 25, prior: float = 0.05) -> dict[str, list[float]]:
    """log2 Bayes factors per level by expectation-maximisation.

    Only the counts of level patterns reach the driver: at most the product of
    the levels (with unknown: 4 * 4 * 3 * 3 * 3 = 432 rows).
    """
    pats = [(tuple(r[c] for c in LEVELS), r["n"]) for r in levelled.groupBy(*LEVELS).agg(F.count("*").alias("n")).collect()]
    total = sum(n for _, n in pats) or 1
    m = {c: [(k + 1) / sum(range(1, s + 1)) for k in range(s)] for c, s in LEVELS.items()}
    u = {c: [(s - k) / sum(range(1, s + 1)) for k in range(s)] for c, s in LEVELS.items()}
    lam = prior
    for _ in range(rounds):
        post = []
        for p, _n in pats:
            a, b = lam, 1 - lam
            for c, x in zip(LEVELS, p, strict=True):
                if x >= 0:
                    a, b = a * m[c][x], b * u[c][x]
            post.append(a / (a + b) if a + b else 0.0)
        lam = min(0.999, max(1e-6, sum(w * n for w, (_, n) in zip(post, pats, strict=True)) / total))
        for i, (c, s) in enumerate(LEVELS.items()):
            mm, uu = [1e-3] * s, [1e-3] * s
            for w, (p, n) in zip(post, pats, strict=True):
                if p[i] >= 0:
                    mm[p[i]] += w * n
                    uu[p[i]] += (1 - w) * n
            m[c], u[c] = [x / sum(mm) for x in mm], [x / sum(uu) for x in uu]
    weights = {c: [math.log2(a / b) for a, b in zip(m[c], u[c], strict=True)] for c in LEVELS}
    weights["prior"] = [math.log2(lam / (1 - lam))]
    return weights


def scored(levelled: DataFrame, weights: dict[str, list[float]]) -> DataFrame:
    """``match_weight`` (bits) and ``match_probability`` of each pair."""
    total = F.lit(weights.get("prior", [0.0])[0])
    for c in LEVELS:
        expr = F.lit(0.0)
        for k, w in enumerate(weights[c]):
            expr = F.when(F.col(c) == k, F.lit(float(w))).otherwise(expr)
        total = total + expr
    return levelled.withColumn("match_weight", total).withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))


def banded(pairs: DataFrame, records: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Band and reason of scored pairs: guardrails first, a tighter threshold where no authority is shared."""
    cfg.check()
    r = records.select("unique_id", "gender", "active", F.col("deceased_datetime").alias("deceased"), "identifier_systems", "identifier_keys", F.get(F.filter("identifier_keys", lambda k: k.startswith(SSN + "|")), 0).alias("ssn"))
    j = pairs.join(r.alias("l"), F.col("id_l") == F.col("l.unique_id")).join(r.alias("r"), F.col("id_r") == F.col("r.unique_id"))
    # A pair that shares an identifier is the deterministic stage's to decide.
    j = j.where(~F.coalesce(F.arrays_overlap("l.identifier_keys", "r.identifier_keys"), F.lit(False)))
    block = guardrail("l", "r", cfg.days)
    need = F.when(F.coalesce(F.arrays_overlap("l.identifier_systems", "r.identifier_systems"), F.lit(False)), cfg.auto).otherwise(cfg.cross_authority)
    p = F.col("match_probability")
    band = F.when(block == "distinct", "hard_deny").when((p >= need) & block.isNotNull(), "review").when(p >= need, "auto_match").when(p >= cfg.review, "review").otherwise("new")
    reason = F.when(block == "distinct", "conflicting_authoritative_identifier").when((p >= need) & block.isNotNull(), F.concat(F.lit("safety_override:"), block)).otherwise(block)
    return j.select("id_l", "id_r", "match_probability", band.alias("band"), reason.alias("reason"))


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The newest row of each candidate set; ties by review id."""
    w = Window.partitionBy("candidate_ids").orderBy(F.col("created_at").desc_nulls_last(), F.col("review_id").desc())
    return reviews.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def open_reviews(reviews: DataFrame) -> DataFrame:
    return latest_reviews(reviews).where("status = 'pending'")


def age_reviews(reviews: DataFrame, now: str, pending_days: int = 7, escalated_days: int = 14) -> DataFrame:
    """Transitions that are due: (candidate_ids, from_status, to_status). A time without zone is UTC; an unreadable one never expires."""
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.try_to_timestamp("created_at"))
    to = F.when((F.col("status") == "pending") & (age > pending_days * 86400), "escalated").when((F.col("status") == "escalated") & (age > escalated_days * 86400), "auto_aged_out")
    return latest_reviews(reviews).withColumn("to_status", to).where("to_status is not null").select("candidate_ids", F.col("status").alias("from_status"), "to_status")


def queue_new(candidates: DataFrame, queued: DataFrame, key: str = "candidate_ids") -> DataFrame:
    """Candidates whose key isn't queued yet."""
    return candidates.join(queued.select(key).distinct(), key, "left_anti")


def _based(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compatibility decomposition (NFKD), of which the ASCII characters are kept."""
    for s in texts:
        yield s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def token_text(field: Column) -> Column:
    """A field as it is tokenised: base letters and digits only, upper case; empty if null.

    Spark can't decompose letters, so that one step is a vectorised function in Python; what is ASCII already passes it as it is.
    """
    based = F.pandas_udf(_based, "string")(F.coalesce(field.cast("string"), F.lit("")))
    return F.upper(F.regexp_replace(based, "[^A-Za-z0-9]", ""))


def hmac_sha256(key: bytes, message: Column) -> Column:
    """HMAC-SHA-256 in hex, by two hashes over the padded key; no Python per row."""
    import hashlib

    k = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in k))
    outer = F.lit(bytearray(b ^ 0x5C for b in k))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))), 256)


def hmac_tokens(records: DataFrame, fields: list[str], key: bytes, version: str) -> DataFrame:
    """A keyed token per record over normalised fields."""
    msg = F.concat_ws("|", *[token_text(F.col(f)) for f in fields])
    return records.select("unique_id", F.lit(version).alias("key_version"), hmac_sha256(key, msg).alias("token"))


def clk_bits(records: DataFrame, fields: list[str], key: bytes, bits: int = 1024, hashes: int = 4) -> DataFrame:
    """A keyed Bloom filter per record: the sorted positions set by the fields' padded bigrams."""
    # The texts are a step of their own: what runs in Python may not stand inside a lambda.
    records = records.select("unique_id", *[token_text(F.col(f)).alias(f) for f in fields])
    grams = F.flatten(F.array(*[_bigrams(F.col(f)) for f in fields]))
    pos = F.flatten(F.array(*[F.transform("_g", _position(key, k, bits)) for k in range(hashes)]))
    return records.select("unique_id", grams.alias("_g")).select("unique_id", F.array_sort(F.array_distinct(pos)).alias("bits"))


def _bigrams(text: Column) -> Column:
    padded = F.concat(F.lit("_"), text, F.lit("_"))
    made = F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substr(padded, i, F.lit(2)))
    return F.when(text != "", made).otherwise(F.expr("cast(array() as array<string>)"))


def _position(key: bytes, k: int, bits: int):
    return lambda g: F.conv(F.left(hmac_sha256(key, F.concat(g, F.lit(f"|{k}"))), F.lit(8)), 16, 10).cast("bigint") % bits


def dice(a: Column, b: Column) -> Column:
    """Dice similarity of two position sets; null if both are empty."""
    return F.try_divide(2 * F.size(F.array_intersect(a, b)), F.size(a) + F.size(b))
