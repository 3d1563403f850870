"""Declarative tabular views over JSON resources, compiled to one projection.

A view definition (resource, constants, where, nested selects with forEach,
forEachOrNull, repeat, unionAll) becomes a single expression: an array of row
structs built by transform / flatten / concat over the parsed variant, and one
``inline``. There is no join and no shuffle; a row's cost is its own nodes.
Collections are ``array<variant>``; absent and JSON null are both empty.

``typed=False`` renders every cell as JSON text; ``typed=True`` casts columns
by their declared type (booleans, integers, decimals as double, dates; other
primitives as text; complex and undeclared values as JSON text). A column with
more than one value needs ``collection``; otherwise the row raises an error.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.plans.fhirpath import CompileError, parse

# The type names of the view standard and their Spark types.
TYPES = {"boolean": "boolean", "integer": "int", "unsignedInt": "int", "positiveInt": "int", "integer64": "bigint", "decimal": "double", "date": "date"}
_DECIMAL = "\x02"  # marks decimals kept in their written form, where boundaries need the digits
_WRITTEN = r'\G((?:"(?:[^"\\]|\\.)*"|[^"0-9\-]|-?[0-9]+(?![0-9.])|-(?![0-9]))*)(-?[0-9]+\.[0-9]+(?![0-9eE]))'


@dataclass(frozen=True)
class _Value:
    """A compiled expression: a collection of variants, or a scalar (bool, num, str) that may be null."""

    kind: str
    col: Column
    hint: str | None = None  # type name where known: of a constant, or by ofType


@dataclass(frozen=True)
class _Context:
    node: Column
    key: Column
    index: Column
    consts: dict[str, tuple[str, str]] = field(default_factory=dict)
    hint: str | None = None


def _empty() -> Column:
    return F.expr("cast(array() as array<variant>)")


def _null() -> Column:
    return F.lit(None).cast("variant")


def _get(node: Column, name: str) -> Column:
    """The collection at a field of a node."""
    at = "$['" + name.replace("'", "\\'") + "']" if not re.fullmatch(r"\w+", name) else "$." + name
    one = F.try_variant_get(node, at, "variant")
    many = F.filter(F.try_variant_get(node, at, "array<variant>"), lambda x: x.isNotNull() & ~F.is_variant_null(x))
    return F.coalesce(many, F.when(one.isNotNull() & ~F.is_variant_null(one), F.array(one)), _empty())


def _getter(name: str):
    return lambda x: _get(x, name)


def _text(v: Column) -> Column:
    return F.translate(F.try_variant_get(v, "$", "string"), _DECIMAL, "")


def _single(v: _Value, what: str = "string") -> Column:
    """The one value of a collection as a scalar; null if empty."""
    if v.kind != "coll":
        return v.col.cast(what)
    x = _text(F.get(v.col, 0))
    if what == "double":
        return x.try_cast("double")
    return x.try_cast(what) if what != "string" else x


def _coll(v: _Value) -> Column:
    return v.col if v.kind == "coll" else F.when(v.col.isNull(), _empty()).otherwise(F.array(v.col.cast("variant")))


def _bool(v: _Value) -> Column:
    """A boolean, null if empty."""
    return v.col if v.kind == "bool" else F.try_variant_get(F.get(_coll(v), 0), "$", "boolean")


class _Paths:
    """Compiles path trees to columns in a context."""

    def value(self, tree: tuple, ctx: _Context) -> _Value:
        head = tree[0]
        if head == "lit":
            _, kind, text = tree
            if kind == "num":
                return _Value("num", F.lit(float(text)))
            if kind == "bool":
                return _Value("bool", F.lit(text == "true"))
            return _Value("str", F.lit(text), "dateTime" if kind == "date" else None)
        if head == "const":
            if tree[1] == "rowIndex":
                return _Value("num", ctx.index.cast("int"))
            if tree[1] not in ctx.consts:
                raise CompileError(f"undefined constant %{tree[1]}")
            kind, text = ctx.consts[tree[1]]
            if kind in ("integer", "positiveInt", "unsignedInt", "integer64", "decimal"):
                return _Value("num", F.lit(float(text)))
            return _Value("bool", F.lit(text in ("true", "True"))) if kind == "boolean" else _Value("str", F.lit(text), kind)
        if head == "bin":
            return self.binary(tree[1], tree[2], tree[3], ctx)
        return self.path(tree, ctx)

    def binary(self, op: str, left: tuple, right: tuple, ctx: _Context) -> _Value:
        a, b = self.value(left, ctx), self.value(right, ctx)
        if op in ("and", "or"):
            x, y = _bool(a), _bool(b)
            return _Value("bool", x & y if op == "and" else x | y)
        if op in ("+", "-", "*", "/"):
            x, y = _single(a, "double"), _single(b, "double")
            return _Value("num", {"+": lambda: x + y, "-": lambda: x - y, "*": lambda: x * y, "/": lambda: F.try_divide(x, y)}[op]())
        if op in ("=", "!=", "<", ">", "<=", ">="):
            what = "double" if "num" in (a.kind, b.kind) else "string"
            x, y = _single(a, what), _single(b, what)
            return _Value("bool", {"=": x == y, "!=": x != y, "<": x < y, ">": x > y, "<=": x <= y, ">=": x >= y}[op])
        raise CompileError(f"operator {op} isn't part of the view language")

    def path(self, tree: tuple, ctx: _Context) -> _Value:
        _, base, steps = tree
        steps = list(steps)
        if base is not None:
            v = self.value(base, ctx)
            cur: Column | None = _coll(v)
            hint = v.hint
        else:
            cur, hint = None, ctx.hint
        if base is None and steps and steps[0][0] == "field" and steps[0][1][:1].isupper():
            steps = steps[1:]  # a path may begin with the resource's type
        out = _Value("coll", cur if cur is not None else F.array(ctx.node), hint)
        fresh = cur is None
        i = 0
        while i < len(steps):
            s = steps[i]
            if s[0] == "field":
                name, hint = s[1], None
                if i + 1 < len(steps) and steps[i + 1][:2] == ("call", "ofType"):
                    kind = self.type_name(steps[i + 1])
                    name, hint = name + kind[:1].upper() + kind[1:], kind
                    i += 1
                node = ctx.node
                col = _get(node, name) if fresh else F.flatten(F.transform(_coll(out), _getter(name)))
                out = _Value("coll", col, hint or self.guess(name))
            elif s[0] == "index":
                at = s[1]
                if isinstance(at, str):
                    if ctx.consts.get(at, ("",))[0] not in ("integer", "positiveInt", "unsignedInt"):
                        raise CompileError(f"index %{at}")
                    at = int(ctx.consts[at][1])
                out = _Value("coll", F.slice(_coll(out), at + 1, 1), out.hint)
            elif s[0] == "call":
                out = self.call(s[1], s[2], out, ctx, fresh)
            fresh = False
            i += 1
        return out

    @staticmethod
    def type_name(step: tuple) -> str:
        arg = step[2][0] if step[2] else None
        if not arg or arg[0] != "path" or arg[1] is not None or len(arg[2]) != 1:
            raise CompileError("ofType needs a type name")
        return arg[2][0][1]

    @staticmethod
    def guess(name: str) -> str | None:
        """The type of a choice field by its name, for boundaries."""
        if name == "birthDate":
            return "date"
        m = re.search(r"(DateTime|Date|Time|Instant)$", name)
        return {"DateTime": "dateTime", "Date": "date", "Time": "time", "Instant": "dateTime"}[m[1]] if m else None

    def call(self, name: str, args: list, v: _Value, ctx: _Context, fresh: bool) -> _Value:
        def inside(x: Column) -> _Context:
            return replace(ctx, node=x)

        def need(n: int, most: int | None = None) -> None:
            if not n <= len(args) <= (n if most is None else most):
                raise CompileError(f"{name} takes {n} argument(s)")

        if name == "where":
            need(1)
            return _Value("coll", F.filter(_coll(v), lambda x: F.coalesce(_bool(self.value(args[0], inside(x))), F.lit(False))), v.hint)
        if name in ("exists", "empty"):
            need(0, 1 if name == "exists" else 0)
            c = _coll(self.call("where", args, v, ctx, fresh)) if args else _coll(v)
            return _Value("bool", F.size(c) > 0 if name == "exists" else F.size(c) == 0)
        if name == "first":
            need(0)
            return _Value("coll", F.slice(_coll(v), 1, 1), v.hint)
        if name == "not":
            need(0)
            return _Value("bool", ~_bool(v))
        if name == "join":
            need(0, 1)
            sep = args[0][2] if args and args[0][0] == "lit" else ""
            return _Value("str", F.when(F.size(_coll(v)) > 0, F.array_join(F.transform(_coll(v), _text), sep)))
        if name == "extension":
            need(1)
            url = _single(self.value(args[0], ctx))
            found = F.flatten(F.transform(_coll(v), lambda x: _get(x, "extension")))
            return _Value("coll", F.filter(found, lambda x: F.try_variant_get(x, "$.url", "string") == url))
        if name == "getResourceKey":
            need(0)
            return _Value("str", ctx.key)
        if name == "getReferenceKey":
            need(0, 1)
            ref = F.try_variant_get(F.get(_coll(v), 0), "$.reference", "string")
            kind = self.type_name(("call", name, args)) if args else r"[A-Za-z]+"
            return _Value("str", F.nullif(F.regexp_extract(ref, rf"(?:^|/){kind}/([A-Za-z0-9.\-]+)(?:/_history/[^\n]*)?\z", 1), F.lit("")))
        if name == "ofType":
            raise CompileError("ofType must follow a field")
        if name in ("lowBoundary", "highBoundary"):
            need(0)
            return _Value("str" if v.hint in ("date", "dateTime", "instant", "time") else "num", boundary(_single(v), name == "lowBoundary", v.hint), v.hint)
        raise CompileError(f"function {name} isn't part of the view language")


_DATE = r"\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?"
_CLOCK = r"([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d(\.\d+)?)?)?"
# The standard's forms of dates and times.
BOUNDED = {"date": rf"^{_DATE}$", "time": rf"^{_CLOCK}$", "dateTime": rf"^{_DATE}(T{_CLOCK}(Z|[+-]\d\d:\d\d)?)?$"}


def boundary(text: Column, low: bool, kind: str | None) -> Column:
    """The least or greatest value that a value of its written precision can stand for; null if it has no form of its type."""
    form = BOUNDED.get("dateTime" if kind == "instant" else kind or "")
    text = F.when(text.rlike(form), text) if form else text
    n = F.length(text)
    if kind == "time":
        rest = ["00", "00", "000"] if low else ["59", "59", "999"]
        return F.when(n == 2, F.concat(text, F.lit(f":{rest[0]}:{rest[1]}.{rest[2]}"))).when(n == 5, F.concat(text, F.lit(f":{rest[1]}.{rest[2]}"))).when(n == 8, F.concat(text, F.lit(f".{rest[2]}"))).otherwise(text)
    if kind in ("date", "dateTime", "instant"):
        last = F.date_format(F.last_day(F.try_to_date(F.concat(F.left(text, F.lit(7)), F.lit("-01")))), "yyyy-MM-dd")
        day = F.when(n == 4, F.concat(text, F.lit("-01-01" if low else "-12-31"))).when(n == 7, F.concat(text, F.lit("-01")) if low else last).otherwise(text)
        if kind == "date":
            return F.left(day, F.lit(10))
        time, zone = ("T00:00:00.000", "+14:00") if low else ("T23:59:59.999", "-12:00")
        zoned = text.rlike(r"(Z|[+-]\d\d:\d\d)$")
        clock = F.regexp_replace(text, r"(Z|[+-]\d\d:\d\d)$", "")
        m = F.length(clock)
        fill = F.when(m == 16, F.concat(clock, F.lit(":00.000" if low else ":59.999"))).when(m == 19, F.concat(clock, F.lit(".000" if low else ".999"))).otherwise(clock)
        return F.when(n <= 10, F.concat(day, F.lit(time + zone))).otherwise(F.concat(fill, F.when(zoned, F.regexp_extract(text, r"(Z|[+-]\d\d:\d\d)$", 1)).otherwise(F.lit(zone))))
    digits = F.length(F.regexp_extract(text, r"\.(\d+)$", 1))
    half = F.pow(F.lit(10.0), -digits) / 2
    value = text.try_cast("double")
    exact = value - half if low else value + half
    return F.round(exact, 9)


class View:
    """A compiled view; ``apply`` runs it on a DataFrame of resources."""

    def __init__(self, definition: dict, typed: bool = True):
        if not isinstance(definition.get("resource"), str) or not definition["resource"]:
            raise CompileError("a view needs a resource")
        if not definition.get("select"):
            raise CompileError("a view needs a select")
        self.definition, self.typed, self.paths = definition, typed, _Paths()
        self.consts: dict[str, tuple[str, str]] = {}
        for c in definition.get("constant", []):
            values = [k for k in c if k.startswith("value")]
            if len(values) != 1 or not c.get("name"):
                raise CompileError(f"constant {c.get('name')!r} needs exactly one value")
            kind = values[0][5:6].lower() + values[0][6:]
            v = c[values[0]]
            self.consts[c["name"]] = (kind, str(v).lower() if isinstance(v, bool) else str(v))
        self.columns: list[str] = []
        self.lexical = "Boundary" in str(definition)
        self._declared: dict[str, dict] = {}
        ctx = self._root()
        names = self._names(definition["select"])
        if len(names) != len(set(names)):
            raise CompileError("two columns have one name")
        self.columns = names
        self.rows = self._items(definition["select"], ctx)
        self.filters = [self._where(w, ctx) for w in definition.get("where", [])]

    def _root(self) -> _Context:
        return _Context(F.col("_v"), F.try_variant_get(F.col("_v"), "$.id", "string"), F.lit(0), self.consts)

    def _where(self, w: dict, ctx: _Context) -> Column:
        v = self.paths.value(parse(w["path"]), ctx)
        if v.kind == "bool":
            return F.coalesce(v.col, F.lit(False))
        if v.kind != "coll":
            raise CompileError(f"where must be a boolean: {w['path']}")
        kind = F.schema_of_variant(F.get(v.col, 0))
        return F.when(F.size(v.col) == 0, F.lit(False)).when(kind == "BOOLEAN", _bool(v)).otherwise(F.raise_error(F.lit(f"where is no boolean: {w['path']}")).cast("boolean"))

    def _names(self, items: list[dict]) -> list[str]:
        out: list[str] = []
        for it in items:
            out += [c["name"] for c in it.get("column", [])]
            out += self._names(it.get("select", []))
            if it.get("unionAll"):
                branches = [self._names([b]) for b in it["unionAll"]]
                if any(b != branches[0] for b in branches):
                    raise CompileError("the branches of a unionAll have different columns")
                out += branches[0]
        return out

    def _cell(self, c: dict, ctx: _Context) -> Column:
        if not isinstance(c.get("name"), str) or not re.fullmatch(r"[A-Za-z_]\w*", c["name"]):
            raise CompileError(f"column name {c.get('name')!r}")
        v = self.paths.value(parse(c["path"]), ctx)
        kind = c.get("type")
        if c.get("collection"):
            return self._json(F.to_json(_coll(v)))
        if v.kind == "coll":
            many = F.raise_error(F.lit(f"column {c['name']} has several values"))
            one = F.when(F.size(v.col) > 1, many.cast("variant")).otherwise(F.get(v.col, 0))
            if self.typed and kind in TYPES:
                return _text(one).try_cast(TYPES[kind])
            if self.typed and kind and kind[:1].islower():
                return _text(one)
            return self._json(F.to_json(one))
        if not self.typed:
            return self._json(F.to_json(v.col.cast("variant")))
        return v.col.cast(TYPES.get(kind or "", "string"))

    def _json(self, text: Column) -> Column:
        return F.regexp_replace(text, r'"(?:\\u0002|' + _DECIMAL + r')([^"]*)"', "$1") if self.lexical else text

    def _items(self, items: list[dict], ctx: _Context) -> Column:
        """Row structs of sibling selects: their cross product."""
        rows: tuple[Column, list[str]] | None = None
        for it in items:
            part = (self._item(it, ctx), self._names([it]))
            rows = part if rows is None else (self._cross(rows, part), rows[1] + part[1])
        assert rows is not None
        return rows[0]

    @staticmethod
    def _cross(a: tuple[Column, list[str]], b: tuple[Column, list[str]]) -> Column:
        def both(x: Column, y: Column) -> Column:
            return F.struct(*[x[n].alias(n) for n in a[1]], *[y[n].alias(n) for n in b[1]])

        return F.flatten(F.transform(a[0], lambda x: F.transform(b[0], lambda y: both(x, y))))

    def _item(self, it: dict, ctx: _Context) -> Column:
        loops = [k for k in ("forEach", "forEachOrNull", "repeat") if it.get(k)]
        if len(loops) > 1:
            raise CompileError(f"{' and '.join(loops)} in one select")
        if not loops:
            return self._body(it, ctx)
        if loops[0] == "repeat":
            nodes = self._descend([parse(p) for p in it["repeat"]], ctx)
        else:
            nodes = _coll(self.paths.value(parse(it[loops[0]]), ctx))
        inner = F.flatten(F.transform(nodes, lambda x, i: self._body(it, replace(ctx, node=x, index=i))))
        if loops[0] == "forEachOrNull":
            return F.when(F.size(nodes) > 0, inner).otherwise(self._body(it, replace(ctx, node=_null(), index=F.lit(0))))
        return inner

    def _descend(self, trees: list[tuple], ctx: _Context) -> Column:
        """Nodes below the context by any of the paths at any depth, in document order.

        A fold over the levels: each step replaces the nodes of the last level by their children, which
        carry the ordinals that lead to them; the ordinals' order is the document's. There are as many
        steps as the text can hold objects, but a step without open nodes hands on what it got.
        """
        level = "array<struct<at:string,node:variant>>"

        def children(at: Column, x: Column) -> Column:
            found = F.concat(*[_coll(self.paths.value(t, replace(ctx, node=x))) for t in trees])
            return F.transform(found, lambda n, i: F.struct(F.concat(at, F.lpad(F.hex(i), 8, "0")).alias("at"), n.alias("node")))

        def step(acc: Column, _: Column) -> Column:
            new = F.flatten(F.transform(acc["open"], lambda e: children(e["at"], e["node"])))
            return F.when(F.size(acc["open"]) == 0, acc).otherwise(F.struct(new.alias("open"), F.concat(acc["done"], acc["open"]).alias("done")))

        text = ctx.node.cast("string")
        steps = F.length(text) - F.length(F.translate(text, "{", ""))
        start = F.struct(children(F.lit(""), ctx.node).alias("open"), F.expr(f"cast(array() as {level})").alias("done"))
        found = F.reduce(F.sequence(F.lit(0), F.coalesce(steps, F.lit(0))), start, step, lambda acc: acc["done"])
        ordered = F.array_sort(found, lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0))
        return F.when(ctx.node.isNull(), _empty()).otherwise(F.transform(ordered, lambda e: e["node"]))

    def _body(self, it: dict, ctx: _Context) -> Column:
        parts: list[tuple[Column, list[str]]] = []
        if it.get("column"):
            parts.append((F.array(F.struct(*[self._cell(c, ctx).alias(c["name"]) for c in it["column"]])), [c["name"] for c in it["column"]]))
        for sub in it.get("select", []):
            parts.append((self._item(sub, ctx), self._names([sub])))
        if it.get("unionAll"):
            branches = [self._item(b, ctx) for b in it["unionAll"]]
            parts.append((F.concat(*branches) if len(branches) > 1 else branches[0], self._names([it["unionAll"][0]])))
        if not parts:
            raise CompileError("a select without columns")
        rows = parts[0]
        for p in parts[1:]:
            rows = (self._cross(rows, p), rows[1] + p[1])
        return rows[0]

    def apply(self, resources: DataFrame, body: str = "body_json", keep: list[str] | None = None) -> DataFrame:
        """Rows of the view over JSON resources; those of other types and broken bodies give none."""
        text = F.regexp_replace(F.col(body), _WRITTEN, '$1"' + 2 * chr(92) + 'u0002$2"') if self.lexical else F.col(body)
        df = resources.select(*(keep or []), F.try_parse_json(text).alias("_v"))
        df = df.where(F.try_variant_get("_v", "$.resourceType", "string") == self.definition["resource"])
        for w in self.filters:
            df = df.where(w)
        return df.select(*(keep or []), F.inline(self.rows))
