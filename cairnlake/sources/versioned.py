"""Tables in a folder with a commit log: atomic versions, appends without copying, bucketed merges.

Layout: ``<path>/data-<random>/...`` holds parquet files, ``<path>/_log/<number>.json``
one commit each, with all parts that make up the version. Data is written
first, then the log entry is moved into place under the next number; a mover
who finds the number taken has lost the race. So a reader always sees whole
versions, keeps the one it began with, and the newest version is the largest
number, whatever vacuum has removed.

* ``write(mode="append")`` adds a part; nothing that is stored is read.
* ``merge`` keeps one row per key. Rows lie in ``buckets`` parts by a hash of
  the key, and only buckets that the batch touches are read and rewritten.
* ``transaction`` names a stream and its batch number; a batch that is
  replayed changes nothing.

Odd cases: an empty table reads as None until the first write; parts of
different schemas are read merged; null keys are a key of their own in a
bucket; a merge of an empty batch commits nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ConcurrentWrite(RuntimeError):
    """Another writer committed first."""


class VersionedTable:
    """One table; ``buckets`` is fixed by the first merge."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._p = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(self._conf)

    # The log

    def versions(self) -> list[int]:
        """Numbers of the versions that are still kept."""
        log = self._p(f"{self.path}/_log")
        if not self._fs.exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")

    def entry(self, version: int | None = None) -> dict | None:
        """The log entry of a version (the newest)."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        stream = self._fs.open(self._p(f"{self.path}/_log/{version:020d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, base: dict | None, parts: list[dict], transaction: tuple[str, int] | None) -> int:
        number = 0 if base is None else base["version"] + 1
        done = dict(base["transactions"]) if base else {}
        if transaction:
            done[transaction[0]] = transaction[1]
        text = json.dumps({"version": number, "buckets": self.buckets, "parts": parts, "transactions": done})
        final, own = self._p(f"{self.path}/_log/{number:020d}.json"), self._p(f"{self.path}/_log/.{uuid.uuid4().hex}")
        out = self._fs.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        try:
            files.rename(own, final, self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as e:
            self._fs.delete(own, False)
            if "FileAlreadyExists" in str(e):
                raise ConcurrentWrite(f"version {number} of {self.path} was committed by another writer") from e
            raise
        return number

    def _retried(self, attempt: Callable[[], int | None], tries: int) -> int | None:
        for k in range(tries):
            try:
                return attempt()
            except ConcurrentWrite:
                if k + 1 == tries:
                    raise
                time.sleep(0.05 * 2**k)
        return None

    def _replayed(self, base: dict | None, transaction: tuple[str, int] | None) -> bool:
        return bool(base and transaction and base["transactions"].get(transaction[0], -1) >= transaction[1])

    # Reading

    def _load(self, parts: list[dict]) -> DataFrame | None:
        if not parts:
            return None
        many = len({p["schema"] for p in parts}) > 1
        return self.spark.read.option("mergeSchema", many).parquet(*[f"{self.path}/{p['dir']}" for p in parts])

    def read(self, version: int | None = None) -> DataFrame | None:
        """The newest version or one by its number (from the end, if negative); None if nothing was written yet."""
        known = self.versions()
        if not known:
            return None
        number = known[-1] if version is None else known[version] if version < 0 else version
        entry = self.entry(number)
        return self._load(entry["parts"]) if entry else None

    # Writing

    def write(self, df: DataFrame, mode: str = "overwrite", sort_by: str | list[str] | None = None, transaction: tuple[str, int] | None = None, tries: int = 5) -> int | None:
        """Append or overwrite (which also replaces the schema); the version's number.

        ``sort_by`` clusters the files: by one column's ranges, or by a curve through several.
        """
        if self._replayed(self.entry(), transaction):
            return None
        keys = [sort_by] if isinstance(sort_by, str) else sort_by or []
        if keys:
            df = clustered(df, keys)
        part = {"dir": f"data-{uuid.uuid4().hex}", "bucket": None, "schema": df.schema.json()}
        df.write.parquet(f"{self.path}/{part['dir']}")

        def attempt() -> int | None:
            base = self.entry()
            if self._replayed(base, transaction):
                return None
            return self._commit(base, [*(base["parts"] if base and mode == "append" else []), part], transaction)

        return self._retried(attempt, tries)

    def merge(self, batch: DataFrame, key: list[str], winner: Callable[[DataFrame, list[str]], DataFrame], transaction: tuple[str, int] | None = None, tries: int = 5) -> int | None:
        """Stored rows and the batch's compete per key; ``winner(rows, key)`` leaves one row of each key.

        ``winner`` is applied to the batch by itself first, so a key with many changes in a batch doesn't
        travel with all of them. Returns the version's number, None if there was nothing to do.
        """

        def attempt() -> int | None:
            base = self.entry()
            if self._replayed(base, transaction):
                return None
            if base:
                self.buckets = base["buckets"]
            parts = base["parts"] if base else []
            if any(p["bucket"] is None for p in parts):
                raise ValueError("a table that was appended to has no buckets to merge into")
            bucket = F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")
            new = winner(batch, key).withColumn("_bucket", bucket).persist()
            try:
                touched = {r[0] for r in new.select("_bucket").distinct().collect()}  # at most `buckets` numbers
                if not touched:
                    return None
                now = self._load([p for p in parts if p["bucket"] in touched])
                both = new if now is None else now.withColumn("_bucket", bucket).unionByName(new, allowMissingColumns=True)
                # Buckets are part of the key here, so that the one shuffle serves the ranking and the files.
                out = winner(both.repartition(len(touched), "_bucket"), ["_bucket", *key])
                where = f"data-{uuid.uuid4().hex}"
                out.write.partitionBy("_bucket").parquet(f"{self.path}/{where}")
            finally:
                new.unpersist()
            schema = out.drop("_bucket").schema.json()
            fresh = [{"dir": f"{where}/_bucket={b}", "bucket": b, "schema": schema} for b in sorted(touched)]
            return self._commit(base, [p for p in parts if p["bucket"] not in touched] + fresh, transaction)

        return self._retried(attempt, tries)

    # Upkeep

    def compact(self, sort_by: str | list[str] = "id") -> int | None:
        """Rewrite the newest version clustered, so that scans skip files by their bounds; a merged table bucket by bucket is left as it is."""
        base = self.entry()
        if base is None or any(p["bucket"] is not None for p in base["parts"]):
            return None
        now = self._load(base["parts"])
        return None if now is None else self.write(now, sort_by=sort_by)

    def vacuum(self, keep: int = 1, hours: float = 0.0) -> int:
        """Drop log entries but the newest ``keep``, and data that no kept entry names and that is older than ``hours``; the number of entries dropped."""
        known = self.versions()
        gone = known[: max(0, len(known) - max(1, keep))]
        for n in gone:
            self._fs.delete(self._p(f"{self.path}/_log/{n:020d}.json"), False)
        used = {p["dir"] for n in self.versions() for p in (self.entry(n) or {"parts": []})["parts"]}
        roots = {d.split("/")[0] for d in used}
        before = time.time() * 1000 - hours * 3.6e6
        for s in self._fs.listStatus(self._p(self.path)):
            name = s.getPath().getName()
            if not name.startswith("data-") or s.getModificationTime() > before:
                continue
            if name not in roots:
                self._fs.delete(s.getPath(), True)
                continue
            for b in self._fs.listStatus(s.getPath()):
                if b.getPath().getName().startswith("_bucket=") and f"{name}/{b.getPath().getName()}" not in used:
                    self._fs.delete(b.getPath(), True)
        return len(gone)


def _as_number(name: str, type_name: str) -> Column:
    """A number in the order of the column's values; of texts the first six bytes count."""
    if type_name == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(name, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if type_name in ("timestamp", "date", "timestamp_ntz"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def _upto(edges: Column, at: Column) -> Column:
    return F.filter(edges, lambda b: b <= at)


def clustered(df: DataFrame, keys: list[str], cuts: int = 64) -> DataFrame:
    """Rows range partitioned and sorted by one column, or by the interleaved bits of several columns' ranks.

    Ranks are among ``cuts`` approximate quantiles a column (a bounded number of values in the driver).
    """
    if len(keys) == 1:
        return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    types = dict(df.dtypes)
    numbers = df.select(*[_as_number(k, types[k]).alias(f"_{i}") for i, k in enumerate(keys)])
    bounds = numbers.approxQuantile([f"_{i}" for i in range(len(keys))], [j / cuts for j in range(1, cuts)], 0.005)
    bits, z = (cuts - 1).bit_length(), F.lit(0).cast("bigint")
    for i, k in enumerate(keys):
        edges = F.lit(sorted(set(bounds[i]))) if bounds[i] else F.expr("cast(array() as array<double>)")
        at = _as_number(k, types[k])
        rank = F.coalesce(F.size(_upto(edges, at)), F.lit(0)).cast("bigint")
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint")), b * len(keys) + i))
    return df.withColumn("_z", z).repartitionByRange("_z").sortWithinPartitions("_z", *keys).drop("_z")
