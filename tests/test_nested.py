import json

from brute_nested import brute
from pyspark.sql.types import ArrayType, StructType

from cairnlake import session
from cairnlake.operators import nested
from cairnlake.sources.tables import table

DEEP = "null"
for level in range(14):
    DEEP = '{"a": [%s, {"k%d": [[{"z": 1}]]}]}' % (DEEP, level)
BODIES = [
    '{"item": [{"x": 1, "answer": [{"v": [1, 2]}, null, 3]}, 5]}',
    '{"item": {"answer": [{"v": 1}]}}',  # an object where others have an array
    '{"item": "none"}',
    '{"item": [[{"q": [{}]}], []]}',
    '[{"a": [{}]}, 1]',
    '{"a": [{}]} trailing',
    '{"a": [{"b": 1}',
    "{'a': [{}]}",
    "",
    "   ",
    None,
    "7",
    "null",
    DEEP,
    json.dumps({"text": "y" * 200_000, "a": [{"t": "[{]}" * 1000}]}),
]


def test_mixed_layouts(spark):
    df = spark.createDataFrame([(i, b, "x") for i, b in enumerate(BODIES)], "_commit_version bigint, body_json string, node_path string")
    got = sorted(map(tuple, nested.found(df).collect()))
    assert got == sorted((i, p, o) for i, b in enumerate(BODIES) for p, o in brute(b))
    assert sum(1 for i, _, _ in got if i == 13) > 25


def test_empty_and_flat(spark):
    for rows in ([], [(1, None)], [(1, '{"a": 1}')], [(1, "{")]):
        df = spark.createDataFrame(rows, "_commit_version bigint, body_json string")
        assert nested.found(df).collect() == []


def test_repeated_rows_repeat(spark):
    df = spark.createDataFrame([(1, '{"a":[{}]}')] * 3, "_commit_version bigint, body_json string")
    assert [tuple(r) for r in nested.found(df).collect()] == [(1, "$.a[0]", "$")] * 3


def test_child_table_links(spark):
    df = spark.createDataFrame([(1, '{"item":[{"id":"p","answer":[{"v":"x"},{"v":"y"}]},{"id":"q"}]}')], "k bigint, b string")
    rows = nested.child_table(df, "b", ["k"], ["item", "answer"]).collect()
    assert [(r["node_path"], r["parent_path"], r["ordinal"], r["v"]) for r in rows] == [("$.item[0].answer[0]", "$.item[0]", 0, "x"), ("$.item[0].answer[1]", "$.item[0]", 1, "y")]


def test_table(spark, data):
    b = table(spark, f"{data}/sf0.01", "bronze")
    want = sorted((r[0], p, o) for r in b.select("_commit_version", "body_json").collect() for p, o in brute(r[1]))
    assert sorted(map(tuple, nested.found(b).collect())) == want


def test_levels_have_no_column_for_each_way_down(spark):
    bodies = ['{"item": [{"x": 1}]}']
    for _ in range(4):
        bodies = [b.replace('{"x": 1}', '{"%s": [{"x": 1}, null], "t": "y"}' % k) for b in bodies for k in ("item", "answer", "part")]
    df = spark.createDataFrame(list(enumerate(bodies)), "_commit_version bigint, body_json string")
    assert sorted(map(tuple, nested.found(df).collect())) == sorted((i, p, o) for i, b in enumerate(bodies) for p, o in brute(b))
    written = [spark.read.parquet(f"{session._MADE[-1]}/{level}").schema for level in range(4)]
    assert all(not isinstance(f.dataType, (StructType, ArrayType)) for s in written for f in s), written[0].simpleString()


def test_what_is_below_an_element_comes_through_its_level(spark):
    odd = json.dumps({"a": [{'k "`.\n\\ü\U0001f600$': [None, {"b": {"c d": [[], [{"z": "</\u2028"}, {}], None]}}], "b": []}, {}, None]})
    mixed = ['{"a": [{"m": [1e999, -0.0, 12345678901234567890123456789012345678901234567890, "x", {"q": [{"r": [{}]}]}], "n": null}]}', '{"a": [{"m": {"q": [[{}]]}, "n": [{}]}]}', '{"a": [{"n": [null, {"o": "[{"}], "m": "none"}]}']
    rows = list(enumerate([odd, *mixed]))
    df = spark.createDataFrame(rows, "_commit_version bigint, body_json string")
    want = sorted((i, p, o) for i, b in rows for p, o in brute(b))
    assert sorted(map(tuple, nested.found(df).collect())) == want
    tables = nested.child_tables(df, "body_json", ["_commit_version"]).select("_commit_version", "node_path", "parent_path").collect()
    assert sorted(map(tuple, tables)) == want
