"""Incremental application of a change feed, and event-time windows.

``incremental`` reads an append-only folder a few files at a time and merges
each micro-batch into a versioned table by buckets: data first, then the
table's log with the batch's number, then the stream's own checkpoint. Rows
compete by version and delivery, not by arrival. ``fixed_windows`` counts
per key in windows anchored at the key's first event. Event-time windows with
a watermark are extensions beyond what the reference system has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.operators import changefeed
from cairnlake.sources.versioned import VersionedTable


def read_stream(spark: SparkSession, path: str, like: DataFrame, files: int = 4) -> DataFrame:
    """A parquet folder as a stream, ``files`` files a batch, oldest first."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)


def deliver(df: DataFrame, path: str, order: str) -> None:
    """Rows as a folder of one file for each value of ``order``, which is also the order of the files' times."""
    spark = df.sparkSession
    df.repartition(order).write.partitionBy(order).parquet(path)
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((int(s.getPath().getName().split("=")[1]), s.getPath()) for s in fs.listStatus(top) if "=" in s.getPath().getName())
    for k, part in parts:
        for f in fs.listStatus(part):
            if f.getPath().getName().endswith(".parquet"):
                fs.setTimes(f.getPath(), 1_600_000_000_000 + 1000 * k, -1)


def incremental(stream: DataFrame, target: VersionedTable, checkpoint: str, key: list[str] = changefeed.KEY, version: str = "version_id", sequence: str = "_commit_version", keep: int = 2) -> int:
    """Apply all there is of a feed to ``target`` (tombstones are kept there); returns the batches it took.

    Each micro-batch reads and rewrites the buckets that it touches and no others. The batch's number is
    committed with its rows, so a batch that is replayed after a failure changes nothing.
    """
    done = 0

    def winner(rows: DataFrame, by: list[str]) -> DataFrame:
        return changefeed.latest(rows, by, version, sequence)

    def merge(batch: DataFrame, number: int) -> None:
        nonlocal done
        target.merge(batch, key, winner, transaction=(checkpoint, number))
        target.vacuum(keep=keep)
        done += 1

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return done


def collect_stream(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming query over all there is into a folder, and read that."""
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Events with their watermark; times without a zone are UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def tumbling(events: DataFrame, size: str, late: str) -> DataFrame:
    """Counts and sums per type and window; events of windows that ended ``late`` before the newest event are dropped."""
    w = _timed(events, late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str, step: str, late: str) -> DataFrame:
    """Counts per overlapping window."""
    w = _timed(events, late).groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    """Sessions of a user: events no further apart than ``gap``."""
    w = _timed(events, late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return w.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def _count_windows(seconds: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        start, n = state.get if state.exists else (None, 0)
        rows = []
        for t in sorted(t for pdf in batches for t in pdf["t"].tolist()):
            if start is None or t >= start + seconds:
                start, n = t, 0
            n += 1
            rows.append((key[0], t, start, n))
        if start is not None:
            state.update((start, n))
        yield pd.DataFrame(rows, columns=["user_id", "t", "window_start", "hits"])

    return step


def fixed_windows(stream: DataFrame, seconds: int) -> DataFrame:
    """Each event's place in its key's window; a window starts at the first event after the last one ended.

    The state of a key is two numbers. Events of a key within one batch are put in order first.
    """
    x = stream.select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"))
    return x.groupBy("user_id").applyInPandasWithState(_count_windows(seconds), "user_id bigint, t bigint, window_start bigint, hits bigint", "start bigint, n bigint", "append", "NoTimeout")
