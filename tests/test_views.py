import json

import pytest

from cairnlake.plans.fhirpath import CompileError, parse
from cairnlake.plans.views import View

PEOPLE = [
    {"resourceType": "Patient", "id": "1", "active": True, "name": [{"use": "official", "family": "A", "given": ["x", "y"]}, {"use": "nick", "given": ["z"]}], "birthDate": "1970-06"},
    {"resourceType": "Patient", "id": "2", "active": False, "name": [], "deceasedBoolean": True, "link": [{"other": {"reference": "http://h/Patient/1/_history/2"}}]},
    {"resourceType": "Patient", "id": "3", "name": None, "extension": [{"url": "u", "valueCode": "c"}], "weight": {"value": 1.50}},
    {"resourceType": "Device", "id": "4", "part": [{"n": "a", "part": [{"n": "b"}, {"n": "c", "sub": [{"part": [{"n": "d"}]}]}]}, {"n": "e"}]},
]


def rows(spark, view, typed=True):
    df = spark.createDataFrame([(json.dumps(p).replace("1.5}", "1.50}"),) for p in PEOPLE] + [("{broken",), (None,)], "body_json string")
    v = View(view, typed)
    return [tuple(r) for r in v.apply(df).collect()]


def cols(*pairs):
    return {"column": [{"name": n, "path": p} | ({"type": t} if t else {}) for n, p, t in pairs]}


ID = ("id", "id", "id")


def test_columns_and_choice(spark):
    v = {"resource": "Patient", "select": [cols(ID, ("active", "active", "boolean"), ("dead", "deceased.ofType(boolean)", "boolean"))]}
    assert rows(spark, v) == [("1", True, None), ("2", False, True), ("3", None, None)]


def test_where_and_three_values(spark):
    v = {"resource": "Patient", "select": [cols(ID)], "where": [{"path": "name.use = 'official' or birthDate.empty() and deceased.ofType(boolean).not()"}]}
    assert rows(spark, v) == [("1",)]
    v["where"] = [{"path": "deceased.ofType(boolean) or extension.exists()"}]
    assert rows(spark, v) == [("2",), ("3",)]


def test_iteration_keeps_or_drops_empty_ones(spark):
    each = {"column": [{"name": "use", "path": "use", "type": "code"}, {"name": "i", "path": "%rowIndex", "type": "integer"}, {"name": "g", "path": "given.join(',')", "type": "string"}]}
    assert rows(spark, {"resource": "Patient", "select": [cols(ID), {"forEach": "name"} | each]}) == [("1", "official", 0, "x,y"), ("1", "nick", 1, "z")]
    assert rows(spark, {"resource": "Patient", "select": [cols(ID), {"forEachOrNull": "name"} | each]})[2:] == [("2", None, 0, None), ("3", None, 0, None)]


def test_union_and_keys(spark):
    v = {"resource": "Patient", "select": [cols(ID), {"unionAll": [{"forEach": "name.given", "column": [{"name": "v", "path": "$this", "type": "string"}]}, {"forEach": "link", "column": [{"name": "v", "path": "other.getReferenceKey(Patient)", "type": "string"}]}]}]}
    assert rows(spark, v) == [("1", "x"), ("1", "y"), ("1", "z"), ("2", "1")]


def test_repeat_goes_depth_first(spark):
    v = {"resource": "Device", "select": [{"repeat": ["part", "sub.part"], "column": [{"name": "n", "path": "n", "type": "string"}]}]}
    assert rows(spark, v) == [("a",), ("b",), ("c",), ("d",), ("e",)]


def test_functions(spark):
    v = {"resource": "Patient", "select": [cols(ID, ("e", "extension('u').value.ofType(code).first()", "code"), ("low", "birthDate.lowBoundary()", "string"), ("high", "birthDate.highBoundary()", "string"), ("w", "weight.value.highBoundary()", "decimal"), ("n", "name.where(use = 'nick').exists()", "boolean"), ("second", "name.given[1]", "string"))]}
    assert rows(spark, v) == [("1", None, "1970-06-01", "1970-06-30", None, True, "y"), ("2", None, None, None, None, False, None), ("3", "c", None, None, 1.505, False, None)]


def test_collections(spark):
    v = {"resource": "Patient", "select": [{"column": [{"name": "g", "path": "name.given", "collection": True}]}]}
    assert rows(spark, v) == [('["x","y","z"]',), ("[]",), ("[]",)]
    with pytest.raises(Exception, match="several values"):
        rows(spark, {"resource": "Patient", "select": [cols(("g", "name.given", "string"))]})


@pytest.mark.parametrize("view", [
    {"select": [cols(ID)]}, {"resource": "Patient", "select": []}, {"resource": "Patient", "select": [cols(ID), cols(ID)]},
    {"resource": "Patient", "select": [cols(("x", "name.frobnicate()", None))]}, {"resource": "Patient", "select": [cols(("x", "%nope", None))]}, {"resource": "Patient", "select": [cols(("x", "a | b", None))]},
    {"resource": "Patient", "select": [{"forEach": "name", "forEachOrNull": "name", "column": [{"name": "a", "path": "use"}]}]},
    {"resource": "Patient", "select": [{"unionAll": [cols(("a", "id", None)), cols(("b", "id", None))]}]},
    {"resource": "Patient", "constant": [{"name": "c"}], "select": [cols(ID)]},
])
def test_bad_definitions(spark, view):
    with pytest.raises(CompileError):
        View(view)


def test_precedence():
    assert parse("a = 1 or b and c") == ("bin", "or", ("bin", "=", ("path", None, [("field", "a")]), ("lit", "num", "1")), ("bin", "and", ("path", None, [("field", "b")]), ("path", None, [("field", "c")])))
    for bad in ("a.", "a b", "(a", "a[b]", "'x"):
        with pytest.raises(CompileError):
            parse(bad)
