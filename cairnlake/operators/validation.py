"""Structure, bindings and slices of JSON resources, as arrays of issues.

A schema is a small tree of elements: name, type (a primitive's name, or a
list of elements), whether it is required and whether it repeats. Issues are
(path, message) structs built by expressions on the parsed body; one pass, no
shuffle. A broken body has the single issue ``not valid JSON``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.plans.views import _get, _text

ISSUE = "array<struct<path:string,message:string>>"
# Elements that any object may have.
BASE = ("resourceType", "id", "meta", "implicitRules", "language", "text", "contained", "extension", "modifierExtension", "fhir_comments")
# Written forms of primitive types, by the standard.
FORMATS = {
    "date": r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?\z",
    "instant": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?(Z|[+-]((0\d|1[0-3]):[0-5]\d|14:00))\z",
    "dateTime": r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01])(T([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?(Z|[+-]((0\d|1[0-3]):[0-5]\d|14:00)))?)?)?\z",
    "time": r"^([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?\z",
    "code": r"^[^\s]+(\s[^\s]+)*\z",
    "id": r"^[A-Za-z0-9\-.]{1,64}\z",
}
_BOOL, _NUM = ("boolean",), ("integer", "positiveInt", "unsignedInt", "decimal")


@dataclass(frozen=True)
class Element:
    """An element of a schema; ``type`` is a primitive's name or a tuple of elements."""

    name: str
    type: str | tuple[Element, ...] = "string"
    required: bool = False
    many: bool = False


def _issue(path: Column, message: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(message).alias("message")))


def _none() -> Column:
    return F.expr(f"cast(array() as {ISSUE})")


def _value(v: Column, e: Element, path: Column) -> Column:
    kind = F.schema_of_variant(v)
    if isinstance(e.type, tuple):
        return F.when(F.try_variant_get(v, "$", "map<string,variant>").isNull(), _issue(path, "expected an object")).otherwise(_object(v, e.type, path))
    if e.type in _BOOL:
        return F.when(kind != "BOOLEAN", _issue(path, "expected a boolean")).otherwise(_none())
    if e.type in _NUM:
        return F.when(~(kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT", "INT")), _issue(path, "expected a number")).otherwise(_none())
    bad = F.when(kind != "STRING", _issue(path, "expected a string"))
    if e.type in FORMATS:
        bad = bad.when(~_text(v).rlike(FORMATS[e.type]), _issue(path, f"not a {e.type}"))
    return bad.otherwise(_none())


def _object(node: Column, elements: tuple[Element, ...], path: Column) -> Column:
    known = [e.name for e in elements] + list(BASE)
    keys = F.map_keys(F.try_variant_get(node, "$", "map<string,variant>"))
    odd = F.filter(keys, lambda k: ~k.isin(known) & ~(k.startswith("_") & F.substr(k, F.lit(2)).isin(known)))
    parts = [F.transform(odd, lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), F.lit("unknown element").alias("message")))]
    for e in elements:
        at = F.concat(path, F.lit("." + e.name))
        v, many = F.try_variant_get(node, f"$.{e.name}", "variant"), F.try_variant_get(node, f"$.{e.name}", "array<variant>")
        absent = v.isNull() | F.is_variant_null(v)
        missing = _issue(at, "required element missing") if e.required else _none()
        if e.many:
            inner = F.flatten(F.transform(many, _item(e, at)))
            empty = F.when(F.size(many) == 0, _issue(at, "required element is empty")).otherwise(_none()) if e.required else _none()
            parts.append(F.when(absent, missing).when(many.isNull(), _issue(at, "expected an array")).otherwise(F.concat(empty, inner)))
        else:
            parts.append(F.when(absent, missing).when(many.isNotNull(), _issue(at, "expected a single value")).otherwise(_value(v, e, at)))
    return F.concat(*parts)


def _item(e: Element, at: Column):
    return lambda x, i: _value(x, e, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")))


def structure(df: DataFrame, elements: tuple[Element, ...], root: str, body: str = "body_json") -> DataFrame:
    """``df`` with ``issues``: unknown and missing elements, wrong shapes, kinds and written forms."""
    parsed = df.withColumn("_v", F.try_parse_json(body))
    out = F.when(F.col("_v").isNull(), _issue(F.lit(root), "not valid JSON")).otherwise(_object(F.col("_v"), elements, F.lit(root)))
    return parsed.withColumn("issues", out).drop("_v")


def slices(df: DataFrame, path: str, wanted: dict[str, tuple[dict[str, str], int]], body: str = "body_json") -> DataFrame:
    """``df`` with ``slice_issues``: required slices (name: discriminator values and least count) that are not met."""
    parsed = df.withColumn("_v", F.try_parse_json(body))
    items = None
    for name in path.split("."):
        items = _get(F.col("_v"), name) if items is None else F.flatten(F.transform(items, _step(name)))
    assert items is not None
    parts = []
    for name, (values, least) in wanted.items():
        parts.append(F.when(F.size(F.filter(items, _matches(values))) < least, _issue(F.lit(path), f"required slice {name} not met")).otherwise(_none()))
    return parsed.withColumn("slice_issues", F.concat(*parts)).drop("_v")


def _step(name: str):
    return lambda x: _get(x, name)


def _matches(values: dict[str, str]):
    def test(x: Column) -> Column:
        out = F.lit(True)
        for p, v in values.items():
            out = out & F.coalesce(F.try_variant_get(x, "$." + p, "string") == v, F.lit(False))
        return out

    return test


def bindings(df: DataFrame, key: list[str], codings: Column, valueset: str, expansion: DataFrame, headers: DataFrame) -> DataFrame:
    """``key`` and status of each row's codings: valid if any is, unknown if any is unknown, else invalid."""
    from cairnlake.operators.terminology import membership

    asked = df.select(*key, F.lit(valueset).alias("valueset"), F.explode(codings).alias("c")).select(*key, "valueset", F.col("c.system").alias("system"), F.col("c.code").alias("code"))
    st = membership(asked, expansion, headers)
    return st.groupBy(*key).agg(F.when(F.bool_or(F.col("status") == "valid"), "valid").when(F.bool_or(F.col("status") == "unknown"), "unknown").otherwise("invalid").alias("status"))


def transaction(entries: DataFrame, stored: DataFrame) -> DataFrame:
    """Entries of bundles with references resolved: within the bundle, else stored, else unresolved; and whether the bundle may commit.

    ``entries``: bundle, full_url, resource_id, reference (null for none). ``stored``: key ``Type/id``.
    A reference must name exactly one; a bundle commits only if all of its entries are resolved.
    """
    local = entries.where("full_url is not null").groupBy("bundle", F.col("full_url").alias("reference")).agg(F.count("*").alias("_n"), F.min("resource_id").alias("_id"))
    known = stored.select(F.col("key").alias("reference")).distinct().withColumn("_s", F.lit(True))
    j = entries.join(local, ["bundle", "reference"], "left").join(known, "reference", "left")
    to = F.when(F.col("_n") == 1, F.col("_id")).when(F.col("_s"), F.col("reference"))
    ok = F.col("reference").isNull() | to.isNotNull()
    state = j.select("bundle", "full_url", "resource_id", "reference", to.alias("resolved"), ok.alias("ok"))
    commits = state.groupBy("bundle").agg(F.bool_and("ok").alias("commits"))
    return state.join(commits, "bundle")


def invariants(df: DataFrame, rules: dict[str, str], body: str = "body_json") -> tuple[DataFrame, list[str]]:
    """(``df`` with ``broken``, the names of its broken rules; the rules that can't be evaluated).

    Rules are path expressions that must be true or empty. One outside the view language passes and is listed.
    """
    from cairnlake.plans.fhirpath import CompileError, parse
    from cairnlake.plans.views import _bool, _Context, _Paths

    parsed = df.withColumn("_v", F.try_parse_json(body))
    ctx = _Context(F.col("_v"), F.try_variant_get("_v", "$.id", "string"), F.lit(0))
    tests, skipped = [], []
    for name, path in rules.items():
        try:
            holds = _bool(_Paths().value(parse(path), ctx))
        except CompileError:
            skipped.append(name)
            continue
        tests.append(F.when(F.col("_v").isNotNull() & ~F.coalesce(holds, F.lit(True)), F.array(F.lit(name))).otherwise(F.expr("cast(array() as array<string>)")))
    broken = F.concat(*tests) if tests else F.expr("cast(array() as array<string>)")
    return parsed.withColumn("broken", broken).drop("_v"), skipped


def required_paths(df: DataFrame, paths: list[str], body: str = "body_json") -> DataFrame:
    """``df`` with ``missing``: profile paths that a resource lacks; a nested one binds only where its parent is."""
    parsed = df.withColumn("_v", F.try_parse_json(body))
    tests = []
    for path in paths:
        *above, last = path.split(".")
        parents = F.array(F.col("_v"))
        for name in above:
            parents = F.flatten(F.transform(parents, _step(name)))
        lacks = F.exists(parents, _lacks(last))
        tests.append(F.when(F.col("_v").isNotNull() & lacks, F.array(F.lit(path))).otherwise(F.expr("cast(array() as array<string>)")))
    return parsed.withColumn("missing", F.concat(*tests)).drop("_v")


def _lacks(name: str):
    return lambda p: F.size(_get(p, name)) == 0
