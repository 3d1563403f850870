"""References to records that don't exist (or not yet), by as-of matching into key runs.

Every id is split into a stem and a trailing run of at most 15 hex digits. The
stem with the type and the digits' count names a key space, the digits are an
integer in it; together they are the id again, so equality of (space, integer)
is equality of ids. Parents and the *distinct* referenced keys are partitioned
by space and block of 4096 integers together and sorted. The live parents'
integers are compressed into contiguous runs (start, end, place of the first
one's time); each referenced key is as-of matched to the preceding run's start
and has no parent if it lies beyond that run's end. Equal keys always meet in
one block and a run that a block's bounds cut is two runs, so nothing is
carried between partitions; within one, rows stream by in batches.

Skew: references are counted per key before any shuffle of rows, so a key that
holds a third of them is one row in the match. Rows get their key's verdict
back by a join, of which the hot keys (at least 1/500 of all references, hence
at most 500) are taken out and broadcast.

Odd cases: null, blank and contained (``#...``) references are no cases; a
reference without any ``Type/id`` has no parent; types and ids compare exactly
with their case; a null ``deleted`` counts as false; referrers without id are
kept under a null id; repeated referrers count once; empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.session import scratch

#: Keys with at least 1/HOT of all references are hot; there can't be more than HOT.
HOT = 500
#: Integers that share a partition: 2 ** BLOCK_BITS.
BLOCK_BITS = 12
_SPACE = " \t\n\r\f\v\u00a0"


def target(reference: Column) -> Column:
    """``Type/id`` a reference leads to; without a slash the bare text; null if it is no case."""
    ref = F.substring_index(F.btrim(reference, F.lit(_SPACE)), "/_history/", 1)
    return F.when((ref != "") & ~ref.startswith("#"), F.substring_index(ref, "/", -2))


def _keyed(df: DataFrame, key: str) -> DataFrame:
    """Adds ``space`` and ``num``, which together are the key."""
    tail = F.regexp_extract(key, r"[0-9a-f]{0,15}$", 0)
    stem = F.expr(f"left(`{key}`, length(`{key}`) - length(regexp_extract(`{key}`, '[0-9a-f]{{0,15}}$', 0)))")
    return df.withColumns({
        "space": F.concat(F.length(tail).cast("string"), F.lit(":"), stem),
        "num": F.coalesce(F.conv(tail, 16, 10).cast("bigint"), F.lit(0)),
    })


_ROWS = pa.schema([("target", pa.string()), ("n", pa.int64()), ("since", pa.int64()), ("parent", pa.bool_()), ("space", pa.string()), ("num", pa.int64())])


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a partition's parents, and its referenced keys matched to them.

    Rows come sorted by key, a parent before its references, so a batch and the last parent before it
    are all that is held: a run that goes on in the next batch ends, for this one's references, where
    it has come to.
    """
    last: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        own = pa.Table.from_batches([b]).select(_ROWS.names).cast(_ROWS)
        t = (pa.concat_tables([last, own]) if last is not None else own).combine_chunks()
        space = t["space"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        num, since = t["num"].to_numpy(), t["since"].to_numpy()
        parent = t["parent"].to_numpy(zero_copy_only=False)
        p, r = np.flatnonzero(parent), np.flatnonzero(~parent)
        before = (np.cumsum(parent) - 1)[~parent]  # as-of: the preceding parent of each reference
        born = np.full(len(r), -1, np.int64)
        if len(p) and len(r):
            keys = num[p]
            first = np.flatnonzero(np.r_[True, (np.diff(keys) != 1) | (np.diff(space[p]) != 0)])  # where a run begins
            run_of = np.cumsum(np.isin(np.arange(len(p)), first)) - 1
            start, end = keys[first], keys[np.r_[first[1:] - 1, len(keys) - 1]]
            run = run_of[np.maximum(before, 0)]
            inside = (before >= 0) & (space[p[np.maximum(before, 0)]] == space[r]) & (num[r] <= end[run])
            at = first[run[inside]] + (num[r[inside]] - start[run[inside]])
            born[inside] = since[p[at]]
        if len(p):
            last = t.slice(int(p[-1]), 1)
        take = pa.array(r)
        out = pa.table({"target": t["target"].take(take), "n": t["n"].take(take), "born": pa.array(born)})
        yield from out.to_batches(max_chunksize=50_000)


def verdicts(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Per distinct ``target`` of ``refs``: its count ``n`` and ``born``, the microsecond its parent was governed.

    ``born`` is -1 where there is no live parent. ``parents`` has key, deleted, governed_at.
    """
    live = parents.groupBy("key").agg(F.bool_or(F.coalesce("deleted", F.lit(False))).alias("gone"), F.max(F.unix_micros("governed_at")).alias("since"))
    live = live.where(~F.col("gone")).select(F.col("key").alias("target"), F.lit(0).cast("bigint").alias("n"), F.coalesce("since", F.lit(0)).alias("since"), F.lit(True).alias("parent"))
    asked = refs.groupBy("target").agg(F.count("*").alias("n")).select("target", "n", F.lit(0).cast("bigint").alias("since"), F.lit(False).alias("parent"))
    both = _keyed(live.unionByName(asked), "target")
    placed = both.repartition("space", F.shiftright("num", BLOCK_BITS)).sortWithinPartitions("space", "num", F.col("parent").desc())
    return placed.mapInArrow(_match, "target string, n bigint, born bigint")


def orphans(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Rows of ``refs`` (with target and governed_at) whose target is missing, deleted or governed later."""
    spark = refs.sparkSession
    at = scratch(spark, "verdicts")
    verdicts(refs, parents).write.parquet(at)  # read three times below; one row per distinct key
    v = spark.read.parquet(at)
    total = v.agg(F.sum("n")).first()[0] or 0
    hot_at = max(1, -(-total // HOT))
    late = (F.col("born") < 0) | (F.col("born") > F.unix_micros("governed_at"))
    hot_keys = F.broadcast(v.where(F.col("n") >= hot_at).select("target", "born"))  # at most HOT rows
    marked = refs.join(hot_keys, "target", "left")
    from_hot = marked.where(F.col("born").isNotNull() & late)
    rest = marked.where(F.col("born").isNull()).drop("born").join(v.where(F.col("n") < hot_at).select("target", "born"), "target").where(late)
    return from_hot.unionByName(rest).drop("born")


def reference_rows(observation: DataFrame, imagingstudy: DataFrame, claimresponse: DataFrame) -> DataFrame:
    """All references of the three tables that are cases: source_table, fhir_id, field_path, governed_at, target."""
    out = None
    for df, name, field in (
        (observation, "observation", "subject.reference"), (imagingstudy, "imagingstudy", "subject.reference"),
        (claimresponse, "claimresponse", "patient.reference"), (claimresponse, "claimresponse", "insurer.reference"),
    ):
        part = df.select(F.lit(name).alias("source_table"), "fhir_id", F.lit(field).alias("field_path"), "governed_at", target(F.col(field)).alias("target"))
        out = part if out is None else out.unionByName(part)
    return out.where(F.col("target").isNotNull())


def parent_keys(patient: DataFrame, organization: DataFrame) -> DataFrame:
    """The rows that references may lead to: key ``Type/id``, deleted, governed_at."""
    one = lambda df, kind: df.select(F.concat(F.lit(kind + "/"), "fhir_id").alias("key"), "deleted", "governed_at").where(F.col("fhir_id").isNotNull())
    return one(patient, "Patient").unionByName(one(organization, "Organization"))


def found(observation: DataFrame, imagingstudy: DataFrame, claimresponse: DataFrame, patient: DataFrame, organization: DataFrame) -> DataFrame:
    """source_table, fhir_id, field_path of each referrer without a usable target, once."""
    rows = orphans(reference_rows(observation, imagingstudy, claimresponse), parent_keys(patient, organization))
    return rows.select("source_table", "fhir_id", "field_path").distinct()


def per_month(observation: DataFrame, imagingstudy: DataFrame, claimresponse: DataFrame, patient: DataFrame, organization: DataFrame) -> DataFrame:
    """Orphan referrers per table, field and month of the referrer's ``governed_at``."""
    rows = orphans(reference_rows(observation, imagingstudy, claimresponse), parent_keys(patient, organization))
    rows = rows.select("source_table", "field_path", "fhir_id", F.date_format("governed_at", "yyyy-MM").alias("month")).distinct()
    return rows.groupBy("source_table", "field_path", "month").agg(F.count("*").alias("orphans"))
