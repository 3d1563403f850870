"""Hash-chained audit records: assignment, verification, order, anchors.

One chain per key (``chain``), so chains are assigned and followed in parallel.
The hash of a record is SHA-256 over the previous hash and its content. Hashes
need the one before, so assignment is the one ordered fold here; the records
of a chain stream through it sorted, in Arrow batches, and are never held as a
group. Verification is set-based: recomputed hashes, an anti-join for missing
predecessors, a count of first records.

Null content fields hash as empty text. An empty table is a valid chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GENESIS = "0" * 64
CONTENT = ("id", "recorded", "action", "outcome", "subtype", "agent_who", "entity_ref", "patient", "body_json")


def content(fields: tuple[str, ...] = CONTENT) -> Column:
    """A record's content as it is hashed."""
    return F.concat_ws("\n", *[F.concat(F.lit(f + "="), F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields])


def record_hash(prev: Column, text: Column) -> Column:
    return F.sha2(F.concat(prev, F.lit("\n"), text), 256)


def chain(records: DataFrame, key: str = "chain", order: tuple[str, ...] = ("recorded", "id"), fields: tuple[str, ...] = CONTENT) -> DataFrame:
    """``records`` with prev_hash and hash assigned along each chain."""
    cols = records.columns
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        at, prev = object(), GENESIS
        for pdf in batches:
            prevs, hashes = [], []
            for k, text in zip(pdf[key], pdf["_content"], strict=True):
                if k != at:
                    at, prev = k, GENESIS
                prevs.append(prev)
                prev = hashlib.sha256(f"{prev}\n{text}".encode()).hexdigest()
                hashes.append(prev)
            yield pdf[cols].assign(prev_hash=prevs, hash=hashes)

    ready = records.withColumn("_content", content(fields)).repartition(key).sortWithinPartitions(key, *order)
    return ready.mapInPandas(fold, types + ", prev_hash string, hash string")


def verify(records: DataFrame, key: str = "chain", fields: tuple[str, ...] = CONTENT) -> DataFrame:
    """Issues: (chain, id, issue) of tampered records, missing predecessors, and chains without or with several first records."""
    bad = records.where(record_hash(F.col("prev_hash"), content(fields)) != F.col("hash")).select(key, "id", F.lit("content mismatch").alias("issue"))
    known = records.select(F.col(key), F.col("hash").alias("prev_hash"))
    lost = records.where(F.col("prev_hash") != GENESIS).join(known, [key, "prev_hash"], "left_anti").select(key, "id", F.lit("previous record missing").alias("issue"))
    first = records.groupBy(key).agg(F.count_if(F.col("prev_hash") == GENESIS).alias("n"))
    heads = first.where("n <> 1").select(key, F.lit(None).cast(records.schema["id"].dataType).alias("id"), F.when(F.col("n") == 0, "no first record").otherwise("several first records").alias("issue"))
    return bad.unionByName(lost).unionByName(heads)


def chain_order(records: DataFrame, key: str = "chain") -> DataFrame:
    """(chain, id, hash, position) following the hashes from the first record.

    Pointers are doubled: after k rounds every record knows how many of 2**k steps
    lead back to the first one, so long chains take few rounds. Records that
    don't lead there have no position; a record that its own hash leads back to has none either.
    """
    from cairnlake.session import shared_dir

    shared_dir(records.sparkSession)
    cur = records.select(key, "id", "hash", F.col("prev_hash").alias("at"), F.lit(1).cast("bigint").alias("steps")).checkpoint()
    for _ in range(max(1, cur.count()).bit_length() + 1):
        nxt = cur.select(key, F.col("hash").alias("at"), F.col("at").alias("to"), F.col("steps").alias("more"))
        new = cur.join(nxt, [key, "at"], "left").select(key, "id", "hash", F.coalesce("to", "at").alias("at"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("to").isNotNull().alias("moved")).checkpoint()
        cur = new.drop("moved")
        if new.where("moved").isEmpty():
            break
    return cur.where(F.col("at") == GENESIS).select(key, "id", "hash", F.col("steps").alias("position"))


def anchors(records: DataFrame, key: str = "chain") -> DataFrame:
    """(chain, count, tip): the length and last hash of each chain."""
    o = chain_order(records, key)
    return o.groupBy(key).agg(F.max("position").alias("count"), F.max_by("hash", "position").alias("tip"))


def check_anchors(records: DataFrame, anchored: DataFrame, key: str = "chain") -> DataFrame:
    """State of each anchored chain: ok, truncated, or rewritten before its anchor."""
    o = chain_order(records, key)
    length = o.groupBy(key).agg(F.max("position").alias("now"))
    at = o.select(key, F.col("position").alias("count"), F.col("hash").alias("there"))
    j = anchored.join(length, key, "left").join(at, [key, "count"], "left")
    return j.select(key, F.when(F.coalesce("now", F.lit(0)) < F.col("count"), "truncated").when(F.col("there") != F.col("tip"), "rewritten").otherwise("ok").alias("state"))


def disclosures(records: DataFrame, patient: str) -> DataFrame:
    """Accesses to a patient's records, newest first."""
    return records.where(F.col("patient") == patient).orderBy(F.col("recorded").desc(), F.col("id").desc())
