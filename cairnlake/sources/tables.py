"""Named-table scans (parquet). Column pruning and filters are left to Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan ``<base>/<name>.parquet``, a file or a directory of files."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def table_or_none(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """As ``table``; a table that was never provisioned is None, not an error."""
    try:
        return table(spark, base, name)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def list_tables(spark: SparkSession, base: str) -> list[str]:
    """Names of the parquet tables in a folder, on any file system; none if it doesn't exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n[: -len(".parquet")] for n in names if n.endswith(".parquet"))


def query(spark: SparkSession, sql: str, base: str, tables: list[str], args: list | None = None) -> DataFrame:
    """A SQL query over registered tables with ``?`` markers bound as values; absent tables are not registered."""
    for name in tables:
        df = table_or_none(spark, base, name)
        if df is not None:
            df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or [])


def materialise(df: DataFrame, name: str, path: str | None = None) -> None:
    """A result as a view of this session or, with a path, as files (replaced as a whole)."""
    if path:
        df.write.mode("overwrite").parquet(path)
    df.createOrReplaceTempView(name)
