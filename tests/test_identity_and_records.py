import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from cairnlake.operators import audit, consent, identity, quality, resources, search, store, terminology, validation
from cairnlake.operators.components import connected_components
from cairnlake.operators.quality import Check
from cairnlake.operators.search import Param

PERSON = "id string, gender string, birthDate string, family string, given array<string>, identifier array<struct<system:string,value:string>>, active boolean, deceased string, last_updated string"


def person(i, keys, gender="male", active=True, deceased=None, at="2024-01-01"):
    return (i, gender, "1970-01-01", "F", ["G"], [{"system": s, "value": v} for s, v in keys], active, deceased, at)


def union_find(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 7), (1, 2), (3, 2), (50, 60), (60, 50), (1, 2)]
    df = spark.createDataFrame(edges + [(None, 9)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert {k: v for k, v in got.items() if k != 9} == union_find(edges)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_normalised_identifiers(spark):
    cases = [("HTTP://Host.Org/Path/", " a  b ", "http://host.org/Path|a b"), ("urn:oid:1.2//", "x", "urn:oid:1.2|x"), (None, "x", "|x"), (identity.SSN, "12-3 4", identity.SSN + "|1234"), ("s", " ", None), ("s", None, None)]
    df = spark.createDataFrame([(s, v) for s, v, _ in cases], "s string, v string")
    assert [r[0] for r in df.select(identity.normalize_identifier(F.col("s"), F.col("v"))).collect()] == [w for *_, w in cases]


def test_resolution(spark):
    mrn, ssn = "http://h/mrn", identity.SSN
    rows = [
        person("a1", [(mrn, "1")], at="2024-01-01"), person("a2", [(mrn, "1")], at="2024-02-01"),
        person("b1", [(mrn, "2")]), person("b2", [(mrn, "2")]), person("b3", [(mrn, "2")]),
        person("c1", [(mrn, "3")]), person("c2", [(mrn, "3")], gender="female"),
        person("d1", [(mrn, "4"), (ssn, "1")]), person("d2", [(mrn, "4"), (ssn, "2")]),
        person("e1", [(mrn, "5")], active=False), person("e2", [(mrn, "5")]),
        person("f1", [(mrn, "6")], deceased="2024-01-01T00:00:00Z"), person("f2", [(mrn, "6")], deceased="2024-02-01T00:00:00Z"),
        person("g1", []),
        person("h1", [(mrn, "7")], at="2024-01-01"), person("h2", [(mrn, "7")], active=False), person("h3", [(mrn, "7")], at="2024-03-01"),  # an inactive one takes no part
    ]
    df = spark.createDataFrame(rows, PERSON)
    got = {r["component"]: (r["decision"], r["reason"], r["survivor"]) for r in identity.resolve(df).collect()}
    assert got == {"a1": ("merge", None, "a2"), "b1": ("review", "multi_match", None), "c1": ("review", "sex_mismatch", None), "h1": ("merge", None, "h3"), "f1": ("review", "date_of_death_mismatch", None)}


def test_survivors_and_rewriting(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("q", "q")], "merged string, survivor string")
    s = identity.survivor_chains(e)
    assert {r["id"]: r["terminal"] for r in s.collect()} == {"b": "a", "c": "a", "d": "a", "x": "x", "y": "x", "z": "x"}
    refs = [("Patient/d", "Patient/a"), ("http://h/Patient/c/_history/2", "http://h/Patient/a/_history/2"), ("Patient/dd", "Patient/dd"), ("Group/d", "Group/d"), (None, None)]
    df = spark.createDataFrame([(r, w) for r, w in refs], "r string, w string")
    assert all(x["r"] == x["w"] for x in identity.rewrite_references(df, "r", s).collect())


def test_config_floors():
    identity.MatchConfig().check()
    for bad in (identity.MatchConfig(auto=0.8), identity.MatchConfig(auto=0.92), identity.MatchConfig(review=0.99), identity.MatchConfig(cross_authority=0.9)):
        with pytest.raises(ValueError):
            bad.check()


def test_tokens(spark):
    key = b"k" * 70
    df = spark.createDataFrame([("1", "Élan-Ö", "1970"), ("2", "elan o", "1970"), ("3", None, None), ("4", "elan p", "1970")], "unique_id string, n string, b string")
    got = {r["unique_id"]: r["token"] for r in identity.hmac_tokens(df, ["n", "b"], key, "1").collect()}
    assert got["1"] == got["2"] == hmac.new(key, b"ELANO|1970", hashlib.sha256).hexdigest() and got["3"] == hmac.new(key, b"|", hashlib.sha256).hexdigest()
    bits = {r["unique_id"]: r["bits"] for r in identity.clk_bits(df, ["n"], key, 256, 3).collect()}
    want = sorted({int.from_bytes(hmac.new(key, f"{g}|{i}".encode(), hashlib.sha256).digest()[:4], "big") % 256 for g in ("_E", "EL", "LA", "AN", "NO", "O_") for i in range(3)})
    assert bits["1"] == want and bits["3"] == []


def test_weights_separate(spark):
    rows = [(f"l{i}", f"r{i}", 2, 2, 1, 1, 1) for i in range(50)] + [(f"l{i}", f"x{i}", i % 2, 0, 0, i % 2, 0) for i in range(500)]
    lv = spark.createDataFrame(rows, "id_l string, id_r string, g_given int, g_family int, g_birth int, g_gender int, g_postal int")
    out = identity.scored(lv, identity.fit_weights(lv)).collect()
    assert min(r["match_probability"] for r in out if r["id_r"][0] == "r") > 0.95 > 0.05 > max(r["match_probability"] for r in out if r["id_r"][0] == "x")


AUDIT = "chain string, id string, recorded string, action string, outcome string, subtype string, agent_who string, entity_ref string, patient string, body_json string"


def test_audit_chain_detects_harm(spark):
    df = spark.createDataFrame([(c, f"{i:03d}", f"2024-01-{i % 28 + 1:02d}", "read", "0", "vread", None, None, "Patient/1", "{}") for c in "ab" for i in range(40)], AUDIT)
    whole = audit.chain(df).cache()
    assert audit.verify(whole).collect() == []
    order = audit.chain_order(whole).where("chain = 'a'").orderBy("position").collect()
    assert [r["position"] for r in order] == list(range(1, 41))
    first, mid, last = order[0]["id"], order[20]["id"], order[-1]["id"]
    edited = whole.withColumn("action", F.when((F.col("chain") == "a") & (F.col("id") == mid), "write").otherwise(F.col("action")))
    assert [tuple(r) for r in audit.verify(edited).collect()] == [("a", mid, "content mismatch")]
    other = whole.withColumn("subtype", F.when((F.col("chain") == "b") & (F.col("id") == mid), "search").otherwise(F.col("subtype")))
    assert [tuple(r) for r in audit.verify(other).collect()] == [("b", mid, "content mismatch")]
    cut = whole.where(~((F.col("chain") == "a") & (F.col("id") == mid)))
    assert [r["issue"] for r in audit.verify(cut).collect()] == ["previous record missing"]
    assert {r["issue"] for r in audit.verify(whole.where(~((F.col("chain") == "a") & (F.col("id") == first)))).collect()} == {"no first record", "previous record missing"}
    an = audit.anchors(whole)
    state = lambda d: {r["chain"]: r["state"] for r in audit.check_anchors(d, an).collect()}
    assert state(whole) == {"a": "ok", "b": "ok"}
    assert state(whole.where(~((F.col("chain") == "a") & (F.col("id") == last)))) == {"a": "truncated", "b": "ok"}
    assert state(audit.chain(df.withColumn("outcome", F.when(F.col("chain") == "b", "4").otherwise("0")))) == {"a": "ok", "b": "rewritten"}
    assert audit.verify(audit.chain(df.limit(0))).collect() == []


def test_search_conditions(spark):
    patient = "silver_id string, fhir_id string, version_id bigint, deleted boolean, governed_at timestamp, active boolean, gender string, birthDate string, name array<struct<use:string,family:string,given:array<string>>>, address array<struct<city:string,postalCode:string>>, identifier array<struct<system:string,value:string>>, managingOrganization struct<reference:string>"
    rows = [("s1", "1", 1, False, None, True, "male", "1984-02", [("official", "Smith", ["Al"])], None, [("s", "v")], ("Organization/7",)), ("s2", "2", 1, None, None, None, None, None, None, None, None, None), ("s3", "3", 1, True, None, True, "male", None, [("official", "Smith", None)], [], [], None), ("s1b", "1", 1, False, None, True, "male", "1984-02", [("official", "Smith", ["Al"])], None, [("s", "v")], ("Organization/7",))]
    df = resources.patients(spark.createDataFrame(rows, patient))
    find = lambda *p, **k: sorted(r["id"] for r in search.search(df, list(p), **k).collect())
    assert find() == ["1", "2"]
    assert find(Param("family", "string", "SM")) == ["1"] and find(Param("family", "string", "mit", "contains")) == ["1"] and find(Param("family", "string", "smit", "exact")) == []
    assert find(Param("gender", "token", "male", "not")) == ["2"] and find(Param("gender", "token", "true", "missing")) == ["2"] and find(Param("gender", "token", "false", "missing")) == ["1"]
    assert find(Param("birthdate", "date", "ge1984"), Param("birthdate", "date", "lt1985")) == ["1"] and find(Param("birthdate", "date", "1984-02")) == ["1"] and find(Param("birthdate", "date", "sa1984-02")) == []
    assert find(Param("identifier", "token", "s|v")) == ["1"] and find(Param("identifier", "token", "t|v")) == []
    assert find(Param("organization", "reference", "7")) == ["1"] and find(Param("organization", "reference", "Group/7")) == []
    assert find(Param("birthdate", "number", "gt1")) == [] and find(ids=[]) == [] and find(ids=["2", "3"]) == ["2"]
    with pytest.raises(search.UnsupportedSearch):
        search.check_supported([("composite", "x")], set(), False)
    with pytest.raises(search.UnsupportedSearch):
        search.check_supported([("odd", "x")], {"id"}, True)


def test_store_writes(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    assert store.delete_where(df).count() == 0 and store.delete_where(df, F.col("id") > "5").count() == 6 and store.delete_where(df, F.lit(None).cast("boolean")).count() == 10
    assert sorted(map(tuple, store.upsert(df.where("id < 3"), df.where("id in (2, 9)").withColumn("v", F.lit(2)), ["id"]).collect())) == [("0", 1), ("1", 1), ("2", 2), ("9", 2)]


def test_checks_with_known_answers(spark):
    bodies = ['{"gender":"male","birthDate":"1990-01-01","name":[{"family":"A","given":["x"]}]}', '{"gender":"banana","birthDate":"2999-01-01"}', '{"gender":"male","birthDate":"1890"}', '{"birthDate":"1970-02-30x","name":[]}']
    df = spark.createDataFrame([(b,) for b in bodies], "body_json string")
    checks = [Check("must_support", "g", ("gender",)), Check("must_support", "n", ("name",)), Check("binding", "c", ("gender",), codes=("male", "female")), Check("format", "f", ("birthDate",), regex=r"\d{4}(-\d\d(-\d\d)?)?$"), Check("date_plausible", "p", ("birthDate",)), Check("max_cardinality", "m", ("name",)), Check("max_cardinality", "mg", ("name", "given"), max=1)]
    got = {r["metric"]: (r["numerator"], r["denominator"]) for r in quality.run_checks(df, checks, "2026-07-06").collect()}
    assert got == {"g": (3, 4), "n": (1, 4), "c": (2, 3), "f": (3, 4), "p": (1, 4), "m": (0, 2), "mg": (0, 1)}
    none = quality.run_checks(df.limit(0), checks, "2026-07-06").collect()
    assert len(none) == 7 and all(r["score"] is None and r["denominator"] == 0 for r in none)
    assert [r["value"] for r in quality.bad_examples(df, checks[2]).collect()] == ["banana"]


def test_position_is_exact(spark):
    import random

    random.seed(5)
    xs = [random.choice([1.0, 1.0, 2.5, random.random() * 100]) for _ in range(5000)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    s = sorted(xs)
    for k in (0, 1, 1250, 2500, 4749, 4999):
        assert quality.at_position(df, "x", k) == quality.at_position(df, "x", k, small=50) == s[k]
    assert quality.at_position(df, "x", 5000) is None and quality.at_position(df.limit(0), "x", 0) is None


def test_membership_is_three_valued(spark):
    ex = spark.createDataFrame([("v1", "s", "a", "A"), ("v1", "s", "a", "A"), ("v2", "s", "b", "B")], "valueset string, system string, code string, display string")
    hd = spark.createDataFrame([("v1", True), ("v2", True), ("v2", False)], "url string, complete boolean")
    asked = spark.createDataFrame([("v1", "a"), ("v1", "z"), ("v2", "b"), ("v2", "z"), ("v3", "a"), ("v1", None)], "valueset string, code string")
    got = {(r["valueset"], r["code"]): r["status"] for r in terminology.membership(asked, ex, hd).collect()}
    assert got == {("v1", "a"): "valid", ("v1", "z"): "invalid", ("v2", "b"): "valid", ("v2", "z"): "unknown", ("v3", "a"): "unknown", ("v1", None): "unknown"}


def test_terminology_files(spark, tmp_path):
    (tmp_path / "l.csv").write_text('LOINC_NUM,LONG_COMMON_NAME,SHORTNAME,STATUS\n1-1,"a ""q"", b",s,ACTIVE\n2-2,,short,ACTIVE\n3-3,,,\n4-4,x,y,DEPRECATED\n')
    assert [(r["code"], r["display"]) for r in terminology.read_loinc(spark, str(tmp_path / "l.csv")).collect()] == [("1-1", 'a "q", b'), ("2-2", "short"), ("3-3", "3-3")]
    (tmp_path / "c.txt").write_text("id\tactive\n1\t1\n2\t0\n3\t1\n")
    (tmp_path / "d.txt").write_text(f'id\tactive\tconceptId\ttypeId\tterm\n11\t1\t1\t{terminology.FULL_NAME}\tOne "x"\n12\t1\t1\t{terminology.FULL_NAME}\tLater\n13\t0\t3\t{terminology.FULL_NAME}\tOld\n')
    assert sorted((r["code"], r["display"]) for r in terminology.read_snomed(spark, str(tmp_path / "c.txt"), str(tmp_path / "d.txt")).collect()) == [("1", 'One "x"'), ("3", "3")]
    row = lambda c, lat, atom, sab, s: "|".join([c, lat, "", "", "", "", "", atom, "", "", "", sab, "", "", s, "", "", ""])
    (tmp_path / "r.rrf").write_text("\n".join([row("1", "ENG", "b", "RXNORM", "two"), row("1", "ENG", "a", "RXNORM", "one"), row("2", "SPA", "c", "RXNORM", "x"), row("3", "ENG", "d", "OTHER", "y")]))
    assert [(r["code"], r["display"]) for r in terminology.read_rxnorm(spark, str(tmp_path / "r.rrf")).collect()] == [("1", "one")]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text('{"resourceType":"CodeSystem",\n"url":"u"}')
    (tmp_path / "p" / "b.json").write_text("{")
    assert [(r["resource_type"], r["url"]) for r in terminology.read_packages(spark, str(tmp_path / "p")).collect()] == [("CodeSystem", "u")]


def test_structure_and_transactions(spark):
    df = spark.createDataFrame([("1", '{"active":"yes","name":{"family":1},"birthDate":"70","odd":1,"_active":{}}'), ("2", "{"), ("3", '{"active":true,"name":[{"family":"x"},{}]}')], "id string, body_json string")
    from cairnlake.operators.validation import Element

    el = (Element("active", "boolean", required=True), Element("birthDate", "date"), Element("name", (Element("family", required=True),), many=True))
    got = {r["id"]: sorted((i["path"], i["message"]) for i in r["issues"]) for r in validation.structure(df, el, "P").collect()}
    assert got == {"1": [("P.active", "expected a boolean"), ("P.birthDate", "not a date"), ("P.name", "expected an array"), ("P.odd", "unknown element")], "2": [("P", "not valid JSON")], "3": [("P.name[1].family", "required element missing")]}
    e = spark.createDataFrame([("b1", "urn:1", "X/1", None), ("b1", "urn:2", "X/2", "urn:1"), ("b2", "urn:1", "X/3", "Y/1"), ("b3", "urn:1", "X/4", "Y/none"), ("b3", "urn:2", "X/5", None)], "bundle string, full_url string, resource_id string, reference string")
    st = spark.createDataFrame([("Y/1",)], "key string")
    assert sorted({(r["bundle"], r["commits"]) for r in validation.transaction(e, st).collect()}) == [("b1", True), ("b2", True), ("b3", False)]


def test_identifiers_in_time_order(spark):
    df = spark.range(5).select(resources.uuid7(F.col("id") * 1000 + 1700000000000, F.col("id")).alias("u"), (F.col("id") * 1000 + 1700000000000).alias("t"))
    rows = df.select("u", "t", resources.uuid7_millis(F.col("u")).alias("b")).collect()
    assert all(r["t"] == r["b"] for r in rows) and sorted(r["u"] for r in rows) == [r["u"] for r in rows]
    assert spark.createDataFrame([("no",)], "u string").select(resources.uuid7_millis(F.col("u"))).first()[0] is None


def test_consent(spark):
    df = spark.createDataFrame([("system", ["R"], "1", None), ("patient", ["R"], "1", "1"), ("patient", [], "1", "2"), ("user", ["R", "N"], "1", None), ("user", None, "1", None), (None, [], "1", None)], "c string, l array<string>, p string, launch string")
    ok, blocking = consent.decision(F.col("c"), F.col("l"), F.col("p"), F.col("launch"))
    assert [(r[0], r[1]) for r in df.select(ok, blocking).collect()] == [(True, []), (True, []), (False, []), (False, ["R"]), (True, []), (False, [])]


def test_member_match_in_turn(spark):
    members = [("m1", ["a|1", "p|9"], "Sol", "1970-06-02", "female"), ("m2", ["a|2", "p|9"], "Sol", "1970-06-30", "female"), ("m3", ["a|3", "p|8"], "Orr", "1980-01-01", "male"), ("m4", None, None, None, None)]
    asks = [
        ("first unique wins", ["p|9", "a|2", "a|1"], None, None, None, ("m2", "identifier", False)),
        ("ambiguous falls through", ["p|9"], "ORR", "1980", "male", ("m3", "demographics", False)),
        ("several of both", ["p|9"], "sol", "1970-06", "female", (None, None, True)),
        ("several people fit", [], "Sol", "1970", "female", (None, None, True)),
        ("nobody", ["x|1", None], "Sol", "1971", "female", (None, None, False)),
        ("no keys", None, "Sol", "1970-06-30", "female", ("m2", "demographics", False)),
        ("nothing", None, None, None, None, (None, None, False)),
    ]
    m = spark.createDataFrame(members, "member string, keys array<string>, family string, birth_date string, gender string")
    q = spark.createDataFrame([a[:5] for a in asks], "request string, keys array<string>, family string, birth_date string, gender string")
    got = {r["request"]: (r["member"], r["strategy"], r["ambiguous"]) for r in consent.member_match(q, m).collect()}
    assert got == {a[0]: a[5] for a in asks}


def test_tokens_decompose_letters(spark):
    cases = {"Ångström": "ANGSTROM", "ﬁsh": "FISH", "Ğül-ș": "GULS", "søren": "SREN", "x¹": "X1", None: "", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["k"] for r in df.select("t", identity.token_text(F.col("t")).alias("k")).collect()} == cases
