"""A versioned store of JSON resources: append-only versions, current flags, history.

All operations are set-based plans over a DataFrame of versions (resource_type,
id, version_id, last_updated, deleted, is_current, body_json, ...). Nulls in
the key columns are kept as a resource of their own group by the window
operations and never match a point read; repeated rows are repeated versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnlake.operators.changefeed import KEY, latest


def current(df: DataFrame) -> DataFrame:
    """Flagged current and not deleted; a null flag is not current."""
    return df.where(F.coalesce("is_current", F.lit(False)) & ~F.coalesce("deleted", F.lit(False)))


def point_read(df: DataFrame, resource_type: str, rid: str) -> DataFrame:
    """The latest version of one resource with its ``state`` (live or gone); no row if it never was."""
    one = df.where((F.col("resource_type") == resource_type) & (F.col("id") == rid))
    cols = [F.col(c) for c in one.columns]
    order = F.struct(F.coalesce("version_id", F.lit(-1)), F.coalesce("_commit_version", F.lit(-1)))
    got = one.agg(F.max_by(F.struct(*cols), order).alias("r")).where("r is not null").select("r.*")
    return got.withColumn("state", F.when(F.coalesce("deleted", F.lit(False)), "gone").otherwise("live"))


def version_read(df: DataFrame, resource_type: str, rid: str, version: int) -> DataFrame:
    """All deliveries of one version."""
    return df.where((F.col("resource_type") == resource_type) & (F.col("id") == rid) & (F.col("version_id") == version))


def history_entry() -> list[Column]:
    """Method, status and etag of a version as a history bundle shows them."""
    method = F.when(F.coalesce("deleted", F.lit(False)), "DELETE").when(F.col("version_id") == 1, "POST").otherwise("PUT")
    status = F.when(method == "DELETE", "204").when(method == "POST", "201").otherwise("200")
    return [method.alias("method"), status.alias("status"), F.concat(F.lit('W/"'), F.col("version_id").cast("string"), F.lit('"')).alias("etag")]


def history_instance(df: DataFrame, resource_type: str, rid: str) -> DataFrame:
    return df.where((F.col("resource_type") == resource_type) & (F.col("id") == rid)).select("id", "version_id", "_commit_version", *history_entry()).orderBy(F.col("version_id").desc_nulls_last(), F.col("_commit_version").desc())


def history_type(df: DataFrame, resource_type: str) -> DataFrame:
    return df.where(F.col("resource_type") == resource_type).select("id", "version_id", "_commit_version", "last_updated", *history_entry()).orderBy(F.col("last_updated").desc_nulls_first(), F.col("version_id").desc_nulls_first(), "_commit_version")


def history_system(tables: list[DataFrame]) -> DataFrame:
    """Versions of all types, newest first."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.select("resource_type", "id", "version_id", "_commit_version", "last_updated", *history_entry()).orderBy(F.col("last_updated").desc_nulls_first(), F.col("id").desc_nulls_first(), "_commit_version")


#: Resources that may be joined by broadcast because they have so many rows.
HOT_KEYS = 500


def backfill_current(df: DataFrame) -> DataFrame:
    """``is_current`` set from the data: the highest version of each resource; null keys are a resource of their own.

    The highest versions are a map-side combined aggregate. Rows of the at most ``HOT_KEYS`` resources
    that have more than a thousandth of all rows get theirs by broadcast and aren't shuffled.
    """
    tips = df.groupBy(*KEY).agg(F.max("version_id").alias("_tip"), F.count("*").alias("_n")).persist()
    enough = tips.agg(F.sum("_n")).first()[0] or 0
    hot = tips.where(F.col("_n") > enough // 1000 + 1000).orderBy(F.col("_n").desc()).limit(HOT_KEYS)
    keys = hot.collect()

    def tipped(rows: DataFrame, tip: DataFrame) -> DataFrame:
        cond = F.lit(True)
        for k in KEY:
            cond = cond & rows[k].eqNullSafe(tip[f"_{k}"])
        return rows.join(tip, cond).withColumn("is_current", F.coalesce(F.col("version_id") == F.col("_tip"), F.lit(False))).select(*df.columns)

    named = tips.select(*[F.col(k).alias(f"_{k}") for k in KEY], "_tip")
    if not keys:
        return tipped(df, named)
    few = df.sparkSession.createDataFrame([tuple(r[k] for k in KEY) + (r["_tip"],) for r in keys], named.schema)
    flag = F.broadcast(few.select(*[F.col(f"_{k}").alias(f"h_{k}") for k in KEY], F.lit(True).alias("_hot")))
    cond = F.lit(True)
    for k in KEY:
        cond = cond & df[k].eqNullSafe(flag[f"h_{k}"])
    return tipped(df, F.broadcast(few)).unionByName(tipped(df.join(flag, cond, "left_anti"), named))


def upsert(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """MERGE with update-all and insert-all: source rows replace target rows of their key.

    Keys are compared null-safe. A key that the source has twice is an error when the result is computed.
    """
    cond = F.lit(True)
    t, s = target.alias("t"), source.select(*key).distinct().alias("s")
    for k in key:
        cond = cond & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    twice = F.raise_error(F.concat_ws(" ", F.lit("several source rows for the key"), *[F.col(k).cast("string") for k in key]))
    w = Window.partitionBy(*key)
    single = source.withColumn("_n", F.count(F.lit(1)).over(w)).where(F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(True)).drop("_n")
    return t.join(s, cond, "left_anti").unionByName(single, allowMissingColumns=True)


def append_versions(df: DataFrame, writes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A batch of version writes: (store after them, writes refused as conflicts).

    A write names ``expected_version``, the version it was made from (null or 0
    for a new resource). It is refused if that isn't the stored latest one, or
    if another write of the batch (in commit order) came first.
    """
    tip = latest(df).select(*KEY, F.col("version_id").alias("_tip"))
    w = Window.partitionBy(*KEY).orderBy("_commit_version")
    checked = writes.join(tip, KEY, "left").withColumn("_turn", F.row_number().over(w))
    ok = (F.coalesce("expected_version", F.lit(0)) == F.coalesce("_tip", F.lit(0))) & (F.col("_turn") == 1)
    refused = checked.where(~ok).select(*writes.columns)
    new = checked.where(ok).withColumns({"version_id": F.coalesce("_tip", F.lit(0)) + 1, "is_current": F.lit(True)}).drop("_tip", "_turn", "expected_version")
    old = df.join(new.select(*KEY).distinct().withColumn("_written", F.lit(True)), KEY, "left").withColumn("is_current", F.col("is_current") & F.col("_written").isNull()).drop("_written")
    return old.unionByName(new, allowMissingColumns=True), refused


def delete_where(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Rows left after a predicate delete; without predicate none; null predicates delete nothing."""
    return df.limit(0) if predicate is None else df.where(~F.coalesce(predicate, F.lit(False)))
