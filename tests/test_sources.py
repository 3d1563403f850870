from pyspark.sql import functions as F

from cairnlake.operators import resources, search, validation
from cairnlake.sources import tables


def test_scan_list_query_materialise(spark, tmp_path):
    base = str(tmp_path)
    spark.range(5).write.parquet(f"{base}/a.parquet")
    assert tables.list_tables(spark, base) == ["a"] and tables.list_tables(spark, base + "/none") == []
    assert tables.table_or_none(spark, base, "b") is None
    assert tables.query(spark, "SELECT * FROM a WHERE id > ? AND ? = 'x'' OR 1=1'", base, ["a", "b"], [2, "x' OR 1=1"]).count() == 2
    tables.materialise(spark.range(3), "m", base + "/m.parquet")
    assert spark.table("m").count() == 3 and tables.list_tables(spark, base) == ["a", "m"]


def test_export_and_links(spark, tmp_path):
    df = spark.createDataFrame([("A", "1", False, "{}"), ("A", "2", True, "{}"), ("B", "3", None, '{"x":1}')], "resource_type string, id string, deleted boolean, body_json string")
    got = {r["resource_type"]: r["count"] for r in search.export(df, str(tmp_path / "out")).collect()}
    assert got == {"A": 1, "B": 1} and [r[0] for r in spark.read.text(str(tmp_path / "out" / "resource_type=B")).collect()] == ['{"x":1}']
    assert search.page_links("/P", [("a", "b c"), ("_offset", "9")], 0, 10, 11) == {"self": "/P?a=b+c&_count=10&_offset=0", "next": "/P?a=b+c&_count=10&_offset=10"}
    assert "next" not in search.page_links("/P", [], 10, 10, 20)


def test_rows_of_new_resources(spark):
    df = spark.createDataFrame([('{"id":"1","identifier":[{"system":"s","value":"v","type":{"coding":[{"code":"MR"},{"code":"X"}]}},{"value":"w"}]}',), ("{",)], "body_json string")
    rows = resources.bronze_row(df, "src", "2024-01-01T00:00:00Z").collect()
    assert [tuple(i) for i in rows[0]["identifier_index"]] == [("s", "v", "MR"), (None, "w", None)] and rows[0]["id"] == "1" and rows[1]["id"] is None


def test_invariants_and_required(spark):
    df = spark.createDataFrame([("1", '{"a":[{"b":1},{}]}'), ("2", "{}"), ("3", None)], "id string, body_json string")
    out, skipped = validation.invariants(df, {"has": "a.exists()", "none": "c = 'x'", "odd": "a.frob()"})
    assert {r["id"]: r["broken"] for r in out.collect()} == {"1": [], "2": ["has"], "3": []} and skipped == ["odd"]
    assert {r["id"]: r["missing"] for r in validation.required_paths(df, ["a", "a.b"]).collect()} == {"1": ["a.b"], "2": ["a"], "3": []}
    assert df.select(F.count("*")).first()[0] == 3
