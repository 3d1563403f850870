"""Record search over an index of (code, system, value) entries.

Predicates are higher-order ``exists`` on the index column, so a search is one
filter over indexed rows, without explode or shuffle (making the index from
repeated deliveries takes one aggregate, see ``resources``). Chains are semi-joins,
includes are joins. A conjunction is the conjunction of its ``exists`` (two
conditions may be met by one entry, as in a two-sided range). Values compare as
text; numbers by ``try_cast``, so what isn't a number never matches. A null
index matches nothing but ``missing``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.session import shared_dir

PREFIXES = ("gt", "ge", "lt", "le", "ne", "eq", "ap", "sa", "eb")
TYPES = ("string", "token", "date", "number", "quantity", "uri", "reference")


class UnsupportedSearch(ValueError):
    """A parameter that can't be answered and was asked for strictly."""


@dataclass(frozen=True)
class Param:
    """One search condition: code, type and the value as written, with its modifier."""

    code: str
    kind: str
    value: str
    modifier: str | None = None


def parse_range(value: str) -> tuple[str, str]:
    """(operator, rest): gt ge lt le ne as such; sa and eb as gt and lt; eq, ap and none as prefix match."""
    p = value[:2]
    if p in PREFIXES and value[2:3] and (value[2:3].isdigit() or value[2:3] in "-."):
        return {"sa": "gt", "eb": "lt", "eq": "sw", "ap": "sw"}.get(p, p), value[2:]
    return "sw", value


def check_supported(params: list[tuple[str, str]], known: set[str], strict: bool) -> None:
    """Composite and special parameters are always refused; unknown ones and modifiers only strictly."""
    for name, _ in params:
        base, _, mod = name.partition(":")
        if base.startswith("$") or base in ("composite", "special"):
            raise UnsupportedSearch(name)
        if strict and (base not in known or mod and mod not in ("exact", "contains", "not", "missing")):
            raise UnsupportedSearch(name)


def _text_op(value: Column, op: str, to: str) -> Column:
    if op == "sw":
        return value.startswith(to)
    return {"gt": value > to, "ge": value >= to, "lt": value < to, "le": value <= to, "ne": value != to}[op]


def _entry_test(p: Param):
    """A test of one index entry."""
    if p.kind == "string":
        v = p.value.lower().replace("%", "").replace("_", "")
        how = {"exact": lambda x: x == v, "contains": lambda x: F.contains(x, F.lit(v))}.get(p.modifier or "", lambda x: x.startswith(v))
        return lambda e: how(e["value"])
    if p.kind in ("token", "uri"):
        if "|" in p.value and p.kind == "token":
            system, _, code = p.value.partition("|")
            return lambda e: (e["value"] == code) & (e["system"] == system if system else F.lit(True))
        options = p.value.split(",")
        return lambda e: e["value"].isin(options)
    if p.kind == "date":
        op, to = parse_range(p.value)
        return lambda e: _text_op(e["value"], op, to)
    if p.kind in ("number", "quantity"):
        number, _, system = p.value.partition("|")
        op, to = parse_range(number)
        n = float(to)

        def test(e: Column) -> Column:
            x = e["value"].try_cast("double")
            hit = {"sw": x == n, "gt": x > n, "ge": x >= n, "lt": x < n, "le": x <= n, "ne": x != n}[op]
            return hit & (e["system"] == system.strip("|") if system.strip("|") else F.lit(True))

        return test
    if p.kind == "reference":
        if "/" in p.value or ":" in p.value:
            return lambda e: e["value"] == p.value
        return lambda e: (e["value"] == p.value) | e["value"].endswith("/" + p.value)
    raise UnsupportedSearch(p.kind)


def condition(p: Param, index: str = "index") -> Column:
    """The filter of one condition."""
    if p.modifier == "missing":
        has = F.coalesce(F.exists(index, lambda e: e["code"] == p.code), F.lit(False))
        return has if p.value == "false" else ~has
    test = _entry_test(p)
    hit = F.coalesce(F.exists(index, lambda e: (e["code"] == p.code) & F.coalesce(test(e), F.lit(False))), F.lit(False))
    return ~hit if p.modifier == "not" else hit


def live(df: DataFrame) -> DataFrame:
    """Rows that can be found: not deleted."""
    return df.where(~F.coalesce("deleted", F.lit(False)))


def search(df: DataFrame, params: list[Param], ids: list[str] | None = None, updated: str | None = None) -> DataFrame:
    """Live rows that meet all conditions. An empty id list finds nothing."""
    out = live(df)
    if ids is not None:
        out = out.where(F.col("id").isin(ids) if ids else F.lit(False))
    if updated:
        op, to = parse_range(updated)
        out = out.where(_text_op(F.col("last_updated"), op, to))
    for p in params:
        out = out.where(condition(p))
    return out


def sorted_page(df: DataFrame, code: str | None, descending: bool, offset: int, limit: int, numeric: bool = False) -> DataFrame:
    """A page ordered by the smallest indexed value of ``code`` (or the id), id breaking ties; nulls last ascending, first descending."""
    limit = max(0, min(limit, 1000))
    if code is None:
        return df.orderBy(F.col("id").desc() if descending else F.col("id")).offset(offset).limit(limit)
    values = F.transform(F.filter("index", lambda e: e["code"] == code), lambda e: e["value"].try_cast("double") if numeric else e["value"])
    k = F.array_min(values)
    key = F.col("sort_key")
    order = [key.desc_nulls_first(), F.col("id").desc()] if descending else [key.asc_nulls_last(), F.col("id")]
    return df.withColumn("sort_key", k).orderBy(*order).offset(offset).limit(limit)


def reference_keys(df: DataFrame, code: str) -> DataFrame:
    """(source_type, source_id, target ``Type/id``) of an indexed reference, history and base left out."""
    refs = df.select(F.col("resource_type").alias("source_type"), F.col("id").alias("source_id"), F.explode(F.filter("index", lambda e: e["code"] == code)).alias("e"))
    ref = F.substring_index(F.btrim("e.value", F.lit(" \t\r\n")), "/_history/", 1)
    return refs.select("source_type", "source_id", F.substring_index(ref, "/", -2).alias("target"))


def chained(df: DataFrame, code: str, target: DataFrame, target_type: str, params: list[Param]) -> DataFrame:
    """Rows whose reference leads to a target that meets the conditions; there is no cap on targets."""
    hits = search(target, params).select(F.concat(F.lit(target_type + "/"), "id").alias("target"))
    sources = reference_keys(live(df), code).join(hits, "target", "left_semi").select(F.col("source_id").alias("id")).distinct()
    return live(df).join(sources, "id", "left_semi")


def reverse_chained(df: DataFrame, df_type: str, source: DataFrame, code: str, params: list[Param]) -> DataFrame:
    """Rows that a source meeting the conditions refers to. Several are applied one after the other."""
    hits = reference_keys(search(source, params), code).select("target").distinct()
    return live(df).join(hits, F.concat(F.lit(df_type + "/"), F.col("id")) == F.col("target"), "left_semi")


def include(matches: DataFrame, code: str, targets: DataFrame) -> DataFrame:
    """Live targets that the matches refer to by ``code``, once each, without the matches themselves."""
    wanted = reference_keys(matches, code).select("target").distinct()
    got = live(targets).withColumn("target", F.concat_ws("/", "resource_type", "id")).join(wanted, "target", "left_semi").drop("target")
    return got.join(matches.select("resource_type", "id"), ["resource_type", "id"], "left_anti")


def include_iterate(matches: DataFrame, code: str, targets: DataFrame, depth: int = 5) -> DataFrame:
    """Includes followed from what was included, up to ``depth`` steps."""
    shared_dir(matches.sparkSession)
    seen = matches.select("resource_type", "id").distinct().checkpoint()
    new, out = matches, None
    for _ in range(depth):
        new = include(new, code, targets).join(seen, ["resource_type", "id"], "left_anti").checkpoint()  # read three times
        if new.isEmpty():
            break
        out = new if out is None else out.unionByName(new)
        seen = seen.unionByName(new.select("resource_type", "id"))
    return targets.limit(0) if out is None else out.dropDuplicates(["resource_type", "id"])


def revinclude(matches: DataFrame, sources: DataFrame, code: str) -> DataFrame:
    """Live sources that refer to a match by ``code``."""
    keys = matches.select(F.concat_ws("/", "resource_type", "id").alias("target"))
    hit = reference_keys(live(sources), code).join(keys, "target", "left_semi").select(F.col("source_id").alias("id")).distinct()
    return live(sources).join(hit, "id", "left_semi")


def compartment(patient: DataFrame, parts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """The patients and, of each part, the rows that refer to one by any of the codes; once each."""
    keys = live(patient).select(F.concat(F.lit("Patient/"), "id").alias("target"))
    out = live(patient).select("resource_type", "id", "body_json")
    for df, codes in parts:
        refs = None
        for c in codes:
            k = reference_keys(live(df), c)
            refs = k if refs is None else refs.unionByName(k)
        assert refs is not None
        hit = refs.join(keys, "target", "left_semi").select(F.col("source_id").alias("id")).distinct()
        out = out.unionByName(live(df).join(hit, "id", "left_semi").select("resource_type", "id", "body_json"))
    return out


def export(df: DataFrame, path: str) -> DataFrame:
    """NDJSON files, one folder per type, and the manifest of counts."""
    live(df).select("resource_type", F.col("body_json").alias("value")).write.mode("overwrite").partitionBy("resource_type").text(path)
    return live(df).groupBy("resource_type").agg(F.count("*").alias("count"))


def page_links(base: str, params: list[tuple[str, str]], offset: int, limit: int, total: int) -> dict[str, str]:
    """Self and, if there are more hits, next links of a page."""
    from urllib.parse import urlencode

    own = [(k, v) for k, v in params if k not in ("_offset", "_count")]
    link = lambda at: f"{base}?{urlencode([*own, ('_count', str(limit)), ('_offset', str(at))])}"
    return {"self": link(offset)} | ({"next": link(offset + limit)} if offset + limit < total else {})
