"""Session construction and the few settings every operator relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(cpus: int = 8, memory: str = "12g", app: str = "cairnlake", **extra: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the session is given."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app).config("spark.driver.memory", memory)
    for k, v in {**DEFAULTS, "spark.sql.shuffle.partitions": str(cpus), **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session (tests) that names none gets a folder of its own machine; a cluster must name one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cairnlake-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; ``clean`` removes it, and so does the end of the process."""
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_at_exit)
    _MADE.append(at)
    return at


def clean(spark: SparkSession) -> int:
    """Remove the folders that ``scratch`` gave; what is still to be read from them must have been read."""
    jvm, n = spark._jvm, len(_MADE)
    while _MADE:
        at = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return n


def _at_exit() -> None:
    try:
        spark = SparkSession.getActiveSession()
        if spark is not None and spark.sparkContext._jsc is not None:
            clean(spark)
    except Exception:  # the session has gone already
        pass
