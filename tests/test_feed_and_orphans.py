from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cairnlake.operators import changefeed, orphans

FEED = "resource_type string, id string, version_id bigint, _commit_version bigint, deleted boolean, is_current boolean"


def test_feed_orders_and_deletes(spark):
    rows = [
        ("A", "1", 1, 1, False, True), ("A", "1", 3, 2, False, True), ("A", "1", 2, 3, False, True), ("A", "1", 3, 4, False, False),  # late, repeated
        ("B", "1", 1, 5, False, True), ("B", "1", 2, 6, True, False),  # deleted
        ("C", "1", 2, 7, True, True), ("C", "1", 2, 8, None, False),  # corrected delivery; null is not deleted
        (None, "1", 1, 9, False, True), ("D", None, 1, 10, False, True), ("E", "1", None, 11, False, True),
        ("A", "1", 3, 4, False, False),
    ]
    got = sorted(map(tuple, changefeed.found(spark.createDataFrame(rows, FEED)).collect()), key=str)
    assert got == [("A", "1", 3, 4), ("C", "1", 2, 8), ("E", "1", None, 11)]
    assert changefeed.found(spark.createDataFrame([], FEED)).collect() == []


def test_feed_merges_into_a_base_in_any_order(spark):
    rows = [("A", str(i % 7), i % 5, i, i % 11 == 0, True) for i in range(200)]
    df = spark.createDataFrame(rows, FEED)
    whole = sorted(map(tuple, changefeed.apply_changes(None, df).collect()))
    first, second = df.where("_commit_version % 3 = 0"), df.where("_commit_version % 3 <> 0")
    base = changefeed.latest(first)
    assert sorted(map(tuple, changefeed.apply_changes(base, second).collect())) == whole


def test_feed_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("string").alias("resource_type"), (F.col("id") % 3).cast("string").alias("id"), F.col("id").alias("version_id"), F.col("id").alias("_commit_version"), F.lit(False).alias("deleted"))
    plan = changefeed.latest(df)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


T0 = datetime(2024, 1, 1)
REFS = "source_table string, fhir_id string, field_path string, governed_at timestamp, target string"


def brute_orphans(refs, parents):
    keys = {}
    for k, gone, at in parents:
        g, t = keys.get(k, (False, at))
        keys[k] = (g or bool(gone), max(t, at))
    return sorted({r[:3] for r in refs if r[4] is not None and (r[4] not in keys or keys[r[4]][0] or keys[r[4]][1] > r[3])}, key=str)


def test_orphans_with_a_hot_key_runs_and_odd_ids(spark):
    ids = [f"Patient/p-{i:04x}" for i in range(0, 3000) if i % 17] + ["Patient/", "Patient/ß'|`", "Patient/pt-ffffffffffffffffff", "Patient/PT-00", "Organization/p-0001", "X/zz"]
    parents = [(k, i % 13 == 0, T0 + timedelta(days=i % 9)) for i, k in enumerate(ids)] + [("Patient/p-0001", None, T0)]
    targets = [f"Patient/p-{i:04x}" for i in range(0, 3200)] + ["Patient/p-0002"] * 2000 + ["Patient/PT-00", "Patient/pt-00", "Patient/ß'|`", "nothing", "", "Patient/pt-fffffffffffffffffe", "Patient/p-2", None]
    refs = [("t", f"r{i % 4000}", "f", T0 + timedelta(days=i % 10), k) for i, k in enumerate(targets)]
    r = spark.createDataFrame(refs, REFS).where("target is not null")
    p = spark.createDataFrame(parents, "key string, deleted boolean, governed_at timestamp")
    got = sorted({tuple(x[c] for c in ("source_table", "fhir_id", "field_path")) for x in orphans.orphans(r, p).collect()}, key=str)
    assert got == brute_orphans(refs, parents)


def test_orphans_of_empty_tables(spark):
    r, p = spark.createDataFrame([], REFS), spark.createDataFrame([], "key string, deleted boolean, governed_at timestamp")
    assert orphans.orphans(r, p).collect() == []
    one = spark.createDataFrame([("t", "1", "f", T0, "Patient/1")], REFS)
    assert len(orphans.orphans(one, p).collect()) == 1


def test_targets(spark):
    cases = {"Patient/a": "Patient/a", " Patient/a\n": "Patient/a", "http://h:1/x/Patient/a/_history/3": "Patient/a", "#a": None, "": None, " ": None, None: None, "a": "a"}
    df = spark.createDataFrame([(k,) for k in cases], "r string").select("r", orphans.target(F.col("r")).alias("t"))
    assert {x["r"]: x["t"] for x in df.collect()} == cases
