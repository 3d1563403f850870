"""Data-quality checks, population scores and profiles over JSON resources.

All checks of a suite are one pass: each becomes a numerator and a denominator
expression, the sums are one map-side combined aggregate, and the wide row is
turned into long form. Nothing is null-dropped: absent, null, ``""``, ``[]``
and ``{}`` all count as not present. A check with no applicable value has a
denominator of 0 and a null score; an empty table gives all of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnlake.plans.views import _get, _text  # the same path navigation as views


@dataclass(frozen=True)
class Check:
    """One check: its kind, metric name, path (keys from the context) and parameters.

    Kinds: required, must_support, binding, format, max_cardinality, date_plausible, reference_target.
    ``parent`` is the path of the objects that are its contexts (the resource if empty).
    """

    kind: str
    metric: str
    path: tuple[str, ...]
    parent: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    regex: str = ""
    max: int = 1
    targets: tuple[str, ...] = field(default=())

    @property
    def dimension(self) -> str:
        return {"must_support": "completeness", "date_plausible": "plausibility"}.get(self.kind, "conformance")


def navigate(node: Column, path: tuple[str, ...]) -> Column:
    """Values at a path with lists flattened."""
    out: Column | None = None
    for name in path:
        out = _get(node, name) if out is None else F.flatten(F.transform(out, _step(name)))
    return F.array(node) if out is None else out


def _step(name: str):
    return lambda x: _get(x, name)


def is_present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v) & ~F.to_json(v).isin('""', "[]", "{}")


def _strings(values: Column) -> Column:
    """The values that are JSON strings, as text."""
    return F.transform(F.filter(values, lambda v: F.schema_of_variant(v) == "STRING"), _text)


def _contexts(check: Check) -> Column:
    objects = F.filter(navigate(F.col("_v"), check.parent), lambda x: F.try_variant_get(x, "$", "map<string,variant>").isNotNull())
    return objects


def _values(check: Check) -> Column:
    return F.flatten(F.transform(_contexts(check), lambda c: navigate(c, check.path)))


def _count(items: Column, test) -> Column:
    return F.size(F.filter(items, lambda x: F.coalesce(test(x), F.lit(False))))


def terms(check: Check, today: str) -> tuple[Column, Column]:
    """Numerator and denominator of a check on one resource."""
    if check.kind in ("required", "must_support"):
        ctx = _contexts(check)
        return _count(ctx, lambda c: F.exists(navigate(c, check.path), is_present)), F.size(ctx)
    if check.kind == "max_cardinality":
        *above, last = check.path
        holders = _contexts(Check("", "", (), (*check.parent, *above)))
        raw = lambda h: F.try_variant_get(h, f"$.{last}", "variant")
        many = lambda h: F.try_variant_get(h, f"$.{last}", "array<variant>")
        has = F.filter(holders, lambda h: raw(h).isNotNull() & ~F.is_variant_null(raw(h)))
        return _count(has, lambda h: many(h).isNull() if check.max == 1 else F.coalesce(F.size(many(h)), F.lit(1)) <= check.max), F.size(has)
    if check.kind == "reference_target":
        refs = F.transform(_values(check), lambda r: F.try_variant_get(r, "$.reference", "string"))
        kinds = F.filter(F.transform(refs, lambda r: F.regexp_extract(r, r"(?:^|/)([A-Z][A-Za-z]+)/[A-Za-z0-9.\-]+", 1)), lambda k: k != "")
        return (_count(kinds, lambda k: k.isin(*check.targets)) if check.targets else F.size(kinds)), F.size(kinds)
    vals = _strings(_values(check))
    if check.kind == "binding":
        return _count(vals, lambda v: v.isin(*check.codes)), F.size(vals)
    if check.kind == "format":
        return _count(vals, lambda v: v.rlike("^(?:" + check.regex + ")")), F.size(vals)
    if check.kind == "date_plausible":
        hi = F.date_format(F.date_add(F.lit(today).cast("date"), 366), "yyyy-MM-dd")
        return _count(vals, lambda v: v.rlike(r"^\d{4}(-\d{2})?(-\d{2})?([T ][^\n]*)?\z") & (F.left(v, F.lit(4)) >= "1900") & (F.left(v, F.lit(10)) <= hi)), F.size(vals)
    raise ValueError(f"unknown check kind {check.kind!r}")


def run_checks(resources: DataFrame, checks: list[Check], today: str, body: str = "body_json") -> DataFrame:
    """dimension, metric, numerator, denominator and score of each check, in one pass."""
    df = resources.select(F.try_parse_json(body).alias("_v")).where("_v is not null")
    per = df.select(*[t.alias(f"{p}{i}") for i, c in enumerate(checks) for p, t in zip("nd", terms(c, today), strict=True)])
    wide = per.agg(*[F.coalesce(F.sum(f"{p}{i}"), F.lit(0)).alias(f"{p}{i}") for i in range(len(checks)) for p in "nd"])
    rows = F.array(*[F.struct(F.lit(c.dimension).alias("dimension"), F.lit(c.metric).alias("metric"), F.col(f"n{i}").alias("numerator"), F.col(f"d{i}").alias("denominator")) for i, c in enumerate(checks)])
    return wide.select(F.inline(rows)).withColumn("score", F.try_divide("numerator", "denominator"))


def bad_examples(resources: DataFrame, check: Check, body: str = "body_json", n: int = 5) -> DataFrame:
    """The smallest values outside a binding's codes: a distributed distinct, then the top."""
    df = resources.select(F.try_parse_json(body).alias("_v")).where("_v is not null")
    return df.select(F.explode(_strings(_values(check))).alias("value")).where(~F.col("value").isin(*check.codes)).distinct().orderBy("value").limit(n)


def reference_exists(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """metric, found and checked of references (metric, target) whose type is among the loaded parents (key ``Type/id``)."""
    kind = lambda c: F.substring_index(c, "/", 1)
    loaded = parents.select(kind("key").alias("type")).distinct()
    known = parents.select("key").distinct().withColumn("hit", F.lit(1))
    asked = refs.where(F.col("target").contains("/")).withColumn("type", kind("target")).join(loaded, "type", "left_semi")
    # One row per distinct target before the join, so a hot target is one row in it.
    per = asked.groupBy("metric", "target").agg(F.count("*").alias("n")).join(known, F.col("target") == F.col("key"), "left")
    return per.groupBy("metric").agg(F.sum(F.when(F.col("hit") == 1, F.col("n")).otherwise(0)).alias("found"), F.sum("n").alias("checked"))


def summary(scores: DataFrame) -> DataFrame:
    """Metrics, imperfect ones and the worst score (1 if there is none)."""
    return scores.agg(F.count("*").alias("metrics"), F.count_if(F.col("score") < 1).alias("imperfect"), F.coalesce(F.min("score"), F.lit(1.0)).alias("worst"))


def passes(scores: DataFrame, least: float) -> DataFrame:
    return scores.select("metric", F.when(F.col("score") >= least, "pass").when(F.col("score").isNull(), "skip").otherwise("fail").alias("result"))


def latest_run(scores: DataFrame) -> DataFrame:
    """Rows of the newest run of each (resource_type, tier), by one window."""
    w = Window.partitionBy("resource_type", "tier")
    return scores.withColumn("_m", F.max("computed_at").over(w)).where(F.col("computed_at") == F.col("_m")).drop("_m")


def issue_counts(issues: DataFrame) -> DataFrame:
    """Issues by severity."""
    return issues.groupBy("severity").agg(F.count("*").alias("n"))


def profile_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct ids and the share of duplicate ids in percent."""
    return df.agg(F.count("*").alias("count"), F.count_distinct(key).alias("distinct_ids"), F.count(key).alias("_n")).select("count", "distinct_ids", (F.coalesce(1 - F.try_divide(F.col("distinct_ids"), F.col("_n")), F.lit(0.0)) * 100).alias("duplicate_id_pct"))


def top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The most frequent values, ties by value, with their rank."""
    c = df.where(F.col(column).isNotNull() & (F.col(column).cast("string") != "")).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    top = c.orderBy(F.col("n").desc(), "value").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), "value")))  # of k rows


def bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def at_position(df: DataFrame, column: str, k: int, small: int = 100_000) -> float | None:
    """The value at 0-based position ``k`` of the sorted non-null values, exactly.

    Approximate quantiles bracket it, again within the bracket until that is small; only then values are sorted.
    """
    part = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    n = part.count()
    if not 0 <= k < n:
        return None
    eps = 0.001
    while n > small:
        lo, hi = part.approxQuantile("x", [max(0.0, k / n - 3 * eps), min(1.0, (k + 1) / n + 3 * eps)], eps)
        if lo == hi:
            return lo
        k -= part.where(F.col("x") < lo).count()
        part = part.where(F.col("x").between(lo, hi))
        before, n = n, part.count()
        if n == before:  # few distinct values: counting them is enough
            break
    at = part.groupBy("x").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)))
    row = at.where(F.col("upto") > k).orderBy("x").limit(1).first()
    return row["x"] if row else None


def numeric_profile(df: DataFrame, column: str) -> DataFrame:
    """min, max, mean and the values at positions n // 2 and int(n * 0.95) - 1 (from the end if negative)."""
    spark = df.sparkSession
    n, lo, hi, mean = df.agg(F.count(column), F.min(column), F.max(column), F.mean(column)).first()
    p95 = int(n * 0.95) - 1
    return spark.createDataFrame([(n, lo, hi, mean, at_position(df, column, n // 2), at_position(df, column, p95 % n if n else 0))], "n bigint, num_min double, num_max double, num_mean double, num_p50 double, num_p95 double")


def top_unit(df: DataFrame, value: str, unit: str) -> DataFrame:
    """The most common unit of populated quantities."""
    return top_values(df.where(F.col(value).isNotNull()), unit, 1).select("value", "n")
