import pytest
from pyspark.sql import functions as F

from cairnlake.operators import changefeed
from cairnlake.sources.versioned import ConcurrentWrite, VersionedTable, clustered
from cairnlake.streaming import feed


def newest(rows, key):
    return changefeed.latest(rows, key, "version", "seq")


def test_writes_appends_and_vacuum(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None and t.compact() is None and t.versions() == []
    df = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    t.write(df)
    first = {p for p in tmp_path.rglob("*.parquet")}
    t.write(df.withColumn("w", F.lit("x")), mode="append")
    assert first <= {p for p in tmp_path.rglob("*.parquet")}  # nothing was copied
    assert t.read().count() == 20 and t.read().where("w is null").count() == 10 and t.read(0).columns == ["id", "v"]
    t.compact(["id", "v"])
    assert t.vacuum(1, hours=24) == 2 and len(t.versions()) == 1 and t.read().count() == 20
    t.vacuum(1)
    assert len({p.parent for p in tmp_path.rglob("*.parquet")}) == 1 and t.read().count() == 20


def test_versions_stay_in_order_under_vacuum(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    for k in range(9):
        t.write(spark.range(1).select(F.lit(k).alias("k")))
        t.vacuum(keep=2)
        assert t.read().first()[0] == k and t.versions()[-1] == k


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=16)
    rows = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("version"), F.col("id").alias("seq"))
    t.merge(rows, ["id"], newest)
    before = {p["bucket"]: p["dir"] for p in t.entry()["parts"]}
    t.merge(rows.where("id = '7'").withColumn("version", F.lit(2)), ["id"], newest)
    after = {p["bucket"]: p["dir"] for p in t.entry()["parts"]}
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert t.read().count() == 400 and t.read().where("version = 2").count() == 1
    t.vacuum(1)
    assert t.read().count() == 400
    assert t.merge(rows.where("id = '7'"), ["id"], newest, transaction=("s", 4)) is not None
    assert t.merge(rows, ["id"], newest, transaction=("s", 4)) is None and t.merge(rows.limit(0), ["id"], newest) is None


def test_the_second_of_two_writers_fails_or_tries_again(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.write(spark.range(3))
    base = t.entry()
    t.write(spark.range(4), mode="append")
    with pytest.raises(ConcurrentWrite):
        t._commit(base, [], None)
    seen = []

    def once_late():
        got = base if not seen else t.entry()
        seen.append(1)
        return t._commit(got, got["parts"], None)

    assert t._retried(once_late, 3) == 2 and len(seen) == 2 and t.read(-2).count() == 7


def test_stream_of_many_batches_and_a_replay(spark, tmp_path):
    rows = [(i % 3 and "A", str(i % 23), (i * 7) % 11, i, i % 13 == 0, i // 15) for i in range(200)]
    df = spark.createDataFrame(rows, "resource_type string, id string, version_id bigint, _commit_version bigint, deleted boolean, delivery int")
    feed.deliver(df, str(tmp_path / "in"), "delivery")
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=4)
    stream = feed.read_stream(spark, str(tmp_path / "in"), df, files=1)
    assert feed.incremental(stream, t, str(tmp_path / "cp")) == 14
    want = sorted(map(tuple, changefeed.latest(df.drop("delivery")).collect()), key=str)
    cols = df.drop("delivery").columns
    assert sorted(map(tuple, t.read().select(*cols).collect()), key=str) == want
    # The same batches from a lost checkpoint: all are applied again and leave the same rows.
    assert feed.incremental(stream, t, str(tmp_path / "cp2")) == 14
    assert sorted(map(tuple, t.read().select(*cols).collect()), key=str) == want


def test_clustering_keeps_rows(spark):
    df = spark.range(500).select(F.when(F.col("id") % 50 != 0, F.col("id").cast("string")).alias("a"), (F.col("id") * 37 % 101).alias("b"))
    out = clustered(df, ["a", "b"])
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect())) and out.columns == ["a", "b"]
    assert clustered(df.limit(0), ["a", "b"]).count() == 0
