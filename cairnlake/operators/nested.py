"""Deeply nested records to flat tables that keep parent-child links.

The merged schema of all bodies is inferred first (``schema_of_variant_agg``,
a map-side combined aggregate; only the schema reaches the driver). It is
pruned to the keys that lead to an array of objects and each body is read once
by that schema. Then the array levels are exploded one after the other, each from
the rows of the level above: their elements become the rows of child tables, one table for each array path of the schema, which carry the
row's key, their own path (the surrogate key within the row), the path of the
nearest enclosing element (the parent's surrogate key) and their ordinal. Each
level is a narrow pass, written to the shared folder: nothing is shuffled. What
is still to be exploded below an element is written with it as pruned JSON text.

Where bodies disagree on a key's layout (object here, array or scalar there)
the merged schema says VARIANT. Such places are kept as variants and walked
generically, level by level, until nothing is left.

Odd cases: a null, empty or broken body has no rows (also one with text after
its end, or with a key twice in one object); so has a body without an array of
objects. A body that is itself an array has the paths ``$[i]``. Elements that
are not objects count in the ordinals but give no row. Repeated rows give
their rows again; an empty table gives an empty result. Columns of the input
named like the output's are not read, only ``key`` and ``body`` are.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.session import scratch

_ROWS = "array<struct<node_path:string,parent_path:string>>"
_NONE = "\x01"  # a field that no record has: a struct needs at least one
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _wrapped(body: str) -> Column:
    """The body as the one element of an array, so that text after its end is an error."""
    text = F.concat(F.lit("["), F.col(body), F.lit("]"))
    return F.when(F.try_parse_json(text).isNotNull(), text)


def merged_schema(df: DataFrame, body: str) -> str:
    """The merged schema of all valid bodies, as Spark's type text."""
    row = df.select(F.try_parse_json(F.col(body)).alias("v")).agg(F.expr("schema_of_variant_agg(v)").alias("s")).first()
    return row["s"] or "VOID"


def _skip_type(s: str, i: int) -> tuple[object, int]:
    """Parse a type text: dict for OBJECT, one-item list for ARRAY, else its name."""
    if s.startswith("OBJECT<", i):
        i += 7
        out: dict[str, object] = {}
        while s[i] != ">":
            if s[i] == "`":
                j = i + 1
                name = ""
                while True:
                    k = s.index("`", j)
                    name += s[j:k]
                    if s[k + 1 : k + 2] != "`":
                        break
                    name += "`"
                    j = k + 2
                i = k + 1
            else:
                k = s.index(":", i)
                name, i = s[i:k], k
            out[name], i = _skip_type(s, i + 2)
            if s.startswith(", ", i):
                i += 2
        return out, i + 1
    if s.startswith("ARRAY<", i):
        inner, i = _skip_type(s, i + 6)
        return [inner], i + 1
    m = re.compile(r"\w+(?:\(\d+,\s*\d+\))?").match(s, i)
    assert m, s[i : i + 40]
    return m[0], m.end()


def parse_schema(text: str) -> object:
    """The tree of a schema text of ``merged_schema``."""
    return _skip_type(text, 0)[0]


def leads(tree: object) -> bool:
    """Whether an array of objects, or a place without a shape, is at or below."""
    if isinstance(tree, dict):
        return any(map(leads, tree.values()))
    if isinstance(tree, list):
        return isinstance(tree[0], dict) or leads(tree[0])
    return tree == "VARIANT"


def _ddl(tree: object, scalars: bool = False) -> str:
    """The type to read by: what leads to objects and, with ``scalars``, plain fields as text."""
    if isinstance(tree, dict):
        fields = [f"{_tick(k)}: {_ddl(v, scalars)}" for k, v in tree.items() if leads(v) or scalars and not isinstance(v, (dict, list))]
        return f"struct<{', '.join(fields or [_tick(_NONE) + ': string'])}>"
    if isinstance(tree, list):
        return f"array<{_ddl(tree[0], scalars)}>"
    return "variant" if tree == "VARIANT" else "string"


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _none() -> Column:
    return F.expr(f"cast(array() as {_ROWS})")


def _row(path: Column, owner: Column) -> Column:
    return F.array(F.struct(path.alias("node_path"), owner.alias("parent_path")))


def _node(path: Column, owner: Column, element: Column, v: Column) -> Column:
    return F.struct(
        path.alias("path"), owner.alias("owner"), element.alias("element"),
        F.try_variant_get(v, "$", "map<string,variant>").alias("m"),
        F.try_variant_get(v, "$", "array<variant>").alias("a"),
    )


def _own(v: Column, path: Column, owner: Column) -> Column:
    """The row of an array's element of unknown shape, if it is an object."""
    return F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), _row(path, owner)).otherwise(_none())


def _below(nodes: Column) -> Column:
    """Values of objects and elements of arrays, without scalars."""

    def one(n: Column) -> Column:
        owner = F.when(n["element"] & n["m"].isNotNull(), n["path"]).otherwise(n["owner"])
        values = F.transform(F.map_entries(n["m"]), lambda e: _node(F.concat(n["path"], F.lit("."), e["key"]), owner, F.lit(False), e["value"]))
        items = F.transform(n["a"], lambda v, i: _node(F.concat(n["path"], F.lit("["), i.cast("string"), F.lit("]")), owner, F.lit(True), v))
        return F.filter(F.coalesce(values, items), lambda x: x["m"].isNotNull() | x["a"].isNotNull())

    return F.flatten(F.transform(nodes, one))


def _variant(v: Column, path: Column, owner: Column) -> Column:
    """Rows below a place of unknown shape. Levels are a fold, so the plan doesn't grow with them.

    The fold has as many steps as the text of the place holds opening brackets; a step without open
    nodes hands on what it got, so the work is that of the nodes.
    """
    text = v.cast("string")
    steps = F.greatest(F.lit(0), F.length(text) - F.length(F.translate(text, "[{", "")))
    start = F.struct(F.array(_node(path, owner, F.endswith(path, F.lit("]")), v)).alias("nodes"), _none().alias("rows"))

    def step(acc: Column, _: Column) -> Column:
        nodes = _below(acc["nodes"])
        rows = F.transform(F.filter(nodes, lambda n: n["element"] & n["m"].isNotNull()), lambda n: F.struct(n["path"].alias("node_path"), n["owner"].alias("parent_path")))
        return F.when(F.size(acc["nodes"]) == 0, acc).otherwise(F.struct(nodes.alias("nodes"), F.concat(acc["rows"], rows).alias("rows")))

    return F.when(v.isNull() | (steps == 0), _none()).otherwise(F.reduce(F.sequence(F.lit(1), F.greatest(F.lit(1), steps)), start, step, lambda acc: acc["rows"]))


def _arrays(tree: object, at: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], object]]:
    """Arrays that lead to objects, and places without a shape, that are reached through objects alone: (keys, tree)."""
    if isinstance(tree, dict):
        return [x for k, v in tree.items() if leads(v) for x in _arrays(v, (*at, k))]
    return [(at, tree)] if isinstance(tree, list) and leads(tree) or tree == "VARIANT" else []


def _kind(tree: object) -> str:
    return "dict" if isinstance(tree, dict) else "list" if isinstance(tree, list) else tree if tree in ("VARIANT", "VOID") else "scalar"  # type: ignore[return-value]


def _merged(a: object, b: object) -> object | None:
    """One tree for two that nowhere say different kinds of value; else None."""
    ka, kb = _kind(a), _kind(b)
    if "VOID" in (ka, kb):
        return b if ka == "VOID" else a
    if ka != kb:
        return None
    if ka == "dict":
        out = dict(a)  # type: ignore[call-overload]
        for k, v in b.items():  # type: ignore[attr-defined]
            out[k] = _merged(out[k], v) if k in out else v
            if out[k] is None:
                return None
        return out
    if ka == "list":
        inner = _merged(a[0], b[0])  # type: ignore[index]
        return None if inner is None else [inner]
    return a if ka == "VARIANT" or a == b else "STRING"


def _alike(tree: object) -> object:
    """The tree with one type for all arrays of one key and level, where they don't contradict one another.

    Records that nest the same kinds of item in each other have as many array paths as there are ways
    down; with one type a level and key the plan grows with the levels only. Absent keys read as null.
    """
    tree = json.loads(json.dumps(tree))
    now: list[object] = [tree]
    while now:
        groups: dict[str, list[object]] = {}
        below: list[object] = []
        for above in now:
            for holder, at, key in _holders(above):
                same = groups.setdefault(key, [])
                for k, t in enumerate(same):
                    both = _merged(t, holder[at][0])
                    if both is not None:
                        same[k] = both
                        break
                else:
                    same.append(holder[at][0])
        for above in now:
            for holder, at, key in _holders(above):
                holder[at][0] = next(t for t in groups[key] if _merged(t, holder[at][0]) == t)
        for same in groups.values():
            below += same
        now = below
    return tree


def _holders(tree: object, key: str = "") -> list[tuple]:
    """Where arrays of the next level hang: (dict or list, key or index, name)."""
    if isinstance(tree, dict):
        out = []
        for k, v in tree.items():
            if isinstance(v, list) and leads(v) and v[0] != "VARIANT":
                out.append((tree, k, k))
            elif isinstance(v, dict):
                out += _holders(v, k)
        return out
    return [(tree, 0, key)] if isinstance(tree, list) and isinstance(tree[0], list) and leads(tree) else []


class _Level:
    """Rows of one array level: what they say of themselves, and what is below them as text.

    The types of a level have as many leaves as there are ways down, and a table has a column for each;
    the text has only what an element holds: the keys that lead to arrays.
    """

    def __init__(self, width: list[object], extra=None):
        self.width, self.extra = width, extra
        self.types = [_ddl(t, extra is not None) for t in width]
        self.none = F.lit(None).cast("map<string,string>" if extra is not None else "string")

    def row(self, path: Column, owner: Column, is_object: bool, said: Column | None = None, e: Column | None = None) -> Column:
        return F.struct(path.alias("node_path"), owner.alias("parent_path"), F.lit(is_object).alias("_object"), (self.none if said is None else said).alias("_extra"), (F.lit(None).cast("string") if e is None else e).alias("_e"))

    def closed(self):
        return lambda r: self.row(r["node_path"], r["parent_path"], True)

    def opened(self, lead: Column, own: Column, k: int):
        """Makes the row of an element (i, x) of the k-th table of this level."""
        tree = self.width[k]
        is_object = isinstance(tree, dict)
        below = [keys for keys, _ in _arrays(tree)]

        def one(n: Column) -> Column:
            said = self.extra(n["x"], tree) if self.extra is not None and is_object else None
            is_open = reduce(Column.__or__, [_at(n["x"], keys).isNotNull() for keys in below], F.lit(False))
            e = F.when(is_open, F.to_json(F.struct(n["x"].alias(f"c{k}")))) if below else None
            return self.row(F.concat(lead, F.lit("["), n["i"].cast("string"), F.lit("]")), own, is_object, said, e)

        return one

    def read(self, e: Column) -> Column:
        """The element: field k is that of the k-th table, the others are null."""
        return F.from_json(e, f"struct<{', '.join(f'c{k}: {t}' for k, t in enumerate(self.types))}>")


def _at(x: Column, keys: tuple[str, ...]) -> Column:
    for name in keys:
        x = x[name]
    return x


def _exploded(df: DataFrame, key: list[str], tree: object, extra=None) -> DataFrame:
    """Every level's elements as rows: ``key``, node_path, parent_path and, with ``extra``, what it says of an element.

    Level by level: the elements of the arrays in the rows of one level become the rows of the next, which
    is written to the shared folder. So each body is read once, each element is made from its parent's row
    and carries that row's path as its key, and rows without arrays go no further.
    """
    spark = df.sparkSession
    where, here, parts = scratch(spark, "levels"), _Level([tree], extra), []
    rows = df.select(*key, F.lit("$").alias("node_path"), F.lit("$").alias("parent_path"), F.lit(False).alias("_object"), F.struct(F.col("_root").alias("c0")).alias("_e"))
    while here.width:
        reached = [(i, keys, t) for i, above in enumerate(here.width) for keys, t in _arrays(above)]
        width: list[object] = []
        for _, _, t in reached:
            if isinstance(t, list) and t[0] != "VARIANT" and t[0] not in width:
                width.append(t[0])
        new = _Level(width, extra)
        own = F.when(F.col("_object"), F.col("node_path")).otherwise(F.col("parent_path"))
        grown = []
        for i, keys, t in reached:
            x = _at(F.col("_e")[f"c{i}"], keys)
            lead = F.concat(F.col("node_path"), F.lit("".join("." + name for name in keys)))
            if t == "VARIANT":
                grown.append(F.transform(_variant(x, lead, own), new.closed()))
            elif t[0] == "VARIANT":
                grown.append(F.transform(F.flatten(F.transform(x, _shapeless(lead, own))), new.closed()))
            else:
                grown.append(F.transform(F.filter(_numbered(x), lambda n: n["x"].isNotNull()), new.opened(lead, own, width.index(t[0]))))
        if not grown:
            break
        found = rows.select(*key, F.inline(F.flatten(F.array_compact(F.array(*grown)))))
        if new.width:
            at = f"{where}/{len(parts)}"
            found.write.parquet(at)
            found = spark.read.schema(found.schema).parquet(at)
        parts.append(found.where("_object").select(*key, "node_path", "parent_path", *(["_extra"] if extra is not None else [])))
        here = new
        if here.width:
            rows = found.where(F.col("_e").isNotNull()).withColumn("_e", here.read(F.col("_e")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _numbered(x: Column) -> Column:
    return F.transform(x, lambda e, i: F.struct(i.alias("i"), e.alias("x")))


def _shapeless(lead: Column, own: Column):
    def one(v: Column, i: Column) -> Column:
        at = F.concat(lead, F.lit("["), i.cast("string"), F.lit("]"))
        return F.concat(_own(v, at, own), _variant(v, at, own))

    return one


def _parsed(df: DataFrame, body: str, keep: list[Column], tree: object, scalars: bool = False) -> DataFrame:
    """``keep`` and the body by the merged schema as ``_root``; null if it isn't valid JSON."""
    if isinstance(tree, str):  # bodies that agree on nothing
        arr = F.try_variant_get(F.try_parse_json(_wrapped(body)), "$", "array<variant>")
    else:
        arr = F.from_json(_wrapped(body), _ddl([tree], scalars), _STRICT)
    # A column that is read more than once stays a step of its own; a filter on it would parse each body again.
    return df.select(*keep, arr.alias("_a")).select(*keep, F.when(F.size("_a") == 1, F.get("_a", 0)).alias("_root"))


def element_rows(df: DataFrame, body: str, key: list[str]) -> DataFrame:
    """One row for each object that is an element of an array in a valid ``body``: the union of all child tables' keys.

    Columns: ``key``, node_path (its key), parent_path (its parent's), array_path (the name of its child
    table: indexes left out) and ordinal.
    """
    tree = _alike(parse_schema(merged_schema(df, body)))
    keep = [F.col(k) for k in key]
    if not leads(tree):
        rows = df.select(*keep, F.inline(_none()))
    else:
        rows = _exploded(_parsed(df, body, keep, tree), key, tree)
    return rows.withColumns({
        "array_path": F.regexp_replace("node_path", r"\[[0-9]+\]", "[]"),
        "ordinal": F.regexp_extract("node_path", r"\[([0-9]+)\]$", 1).cast("int"),
    })


def _scalars(x: Column, tree: object) -> Column:
    """The element's fields that the merged schema knows as scalars, as text; absent and null ones left out."""
    assert isinstance(tree, dict)
    names = [k for k, v in tree.items() if not isinstance(v, (dict, list)) and v not in ("VARIANT", "VOID")]
    if not names:
        return F.expr("cast(map() as map<string,string>)")
    made = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[x[n].cast("string") for n in names]))
    return F.map_filter(made, lambda _, v: v.isNotNull())


def child_tables(df: DataFrame, body: str, key: list[str]) -> DataFrame:
    """All child tables of the merged schema in one: ``key``, array_path, node_path, parent_path, ordinal and ``fields``.

    ``fields`` maps the element's scalar fields to their text; elements in places without one shape have null there.
    """
    tree = _alike(parse_schema(merged_schema(df, body)))
    keep = [F.col(k) for k in key]
    if not leads(tree):
        rows = df.select(*keep, F.inline(_none())).withColumn("_extra", F.expr("cast(null as map<string,string>)"))
    else:
        rows = _exploded(_parsed(df, body, keep, tree, scalars=True), key, tree, _scalars)
    return rows.select(*keep, F.regexp_replace("node_path", r"\[[0-9]+\]", "[]").alias("array_path"), "node_path", "parent_path", F.regexp_extract("node_path", r"\[([0-9]+)\]$", 1).cast("int").alias("ordinal"), F.col("_extra").alias("fields"))


def child_table(df: DataFrame, body: str, key: list[str], steps: list[str], fields: list[str] | None = None) -> DataFrame:
    """The flat child table of one array path, given as its keys in order.

    ``["item", "answer"]`` is ``$.item[].answer[]``; a step may name a path of
    objects (``code.coding``). Each level is exploded with its ordinal. Columns: ``key``,
    ``node_path``, ``parent_path``, ``ordinal`` and the elements' scalar fields (as text): those
    that the merged schema has, or ``fields``, null where an element hasn't one.
    """
    tree = parse_schema(merged_schema(df, body))
    cols = [F.col(k) for k in key]
    at: object = tree
    for step in steps:
        for name in step.split("."):
            at = at.get(name) if isinstance(at, dict) else None
        at = at[0] if isinstance(at, list) else None
    if fields is None:
        fields = [k for k, v in at.items() if not isinstance(v, (dict, list))] if isinstance(at, dict) else []

    def ddl(i: int) -> str:
        if i == len(steps):
            return f"struct<{', '.join(f'{_tick(k)}: string' for k in fields or [_NONE])}>"
        inner = f"array<{ddl(i + 1)}>"
        for name in reversed(steps[i].split(".")):
            inner = f"struct<{_tick(name)}: {inner}>"
        return inner

    arr = F.from_json(_wrapped(body), f"array<{ddl(0)}>", _STRICT)
    out = df.select(*cols, arr.alias("_a")).where(F.size("_a") == 1).select(*cols, F.get("_a", 0).alias("_e"), F.lit("$").alias("node_path"), F.lit(None).cast("string").alias("parent_path"))
    for step in steps:
        x = F.col("_e")
        for name in step.split("."):
            x = x[name]
        out = out.select(*cols, "node_path", F.posexplode(x).alias("_i", "_e")).where(F.col("_e").isNotNull())
        out = out.select(*cols, F.concat(F.col("node_path"), F.lit(f".{step}["), F.col("_i").cast("string"), F.lit("]")).alias("node_path"), F.col("node_path").alias("parent_path"), F.col("_i").alias("ordinal"), "_e")
    return out.select(*cols, "node_path", "parent_path", "ordinal", *[F.col("_e")[k].alias(k) for k in fields if k not in key])


def found(bronze: DataFrame) -> DataFrame:
    """``_commit_version``, ``node_path``, ``parent_path`` of every element object."""
    return element_rows(bronze, "body_json", ["_commit_version"]).select("_commit_version", "node_path", "parent_path")
