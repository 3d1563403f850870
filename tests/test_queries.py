"""Every core query with SQL, at the smallest scale, against DuckDB."""

import datetime
import glob
import os

import duckdb
import pytest

from cairnlake.queries import registry

SLOW = {"p1_found"}


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{data}/sf0.001/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(x):
    if isinstance(x, float):
        return round(x, 7) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    if hasattr(x, "asDict"):
        return plain(x.asDict())
    if isinstance(x, dict):
        return {k: plain(v) for k, v in x.items()}
    return [plain(y) for y in x] if isinstance(x, list) else x


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query(spark, data, con, name):
    df = registry.queries()[name](spark, f"{data}/sf0.001")
    rel = con.sql(registry.oracles()[name])
    cols = list(rel.columns)
    assert sorted(df.columns) == sorted(cols)
    want = sorted(repr([plain(v) for v in r]) for r in rel.fetchall())
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles())))
def test_query_without_sql_runs(spark, data, name):
    df = registry.queries()[name](spark, f"{data}/sf0.001")
    assert df.columns and df.count() >= 0
