import json
import random

import pytest

from cairnlake.llm import matching as M

P = "silver_id string, fhir_id string, gender string, birthDate string, name array<struct<use:string,family:string,given:array<string>>>, address array<struct<city:string,postalCode:string>>, meta struct<source:string>, score double"
L = "unique_id string, given_name string, family_name string, birth_date string, gender string, postal_code string, rec string"
S = "subject struct<reference:string,display:string,identifier:struct<system:string,value:string>>"
Z = "source_name string, time_zone string, date_order string"


def tables(spark, patients, labs, displays=()):
    return (
        spark.createDataFrame(patients, P), spark.createDataFrame(labs, L),
        spark.createDataFrame([((None, d, ("x", u)),) for u, d in displays], S), spark.createDataFrame([("a", "Europe/Vienna", "dmy")], Z),
    )


def patient(i, given, family, born, gender="male", postal="37000"):
    return (f"s{i}", f"pt-{i}", gender, born, [("official", family, given.split())], [("X", postal)], ("a",), 0.0)


def test_readings_of_displays():
    assert M.parse_display("Bornes, Emorine (1978-08-27)") == ([("emorine", "bornes")], "1978-08-27")
    assert M.parse_display("Casus Calavford *16.01.1964") == ([("casus", "calavford"), ("calavford", "casus")], "1964-01-16")
    assert M.parse_display("DE BELAMNER Y.") == ([("y.", "de belamner")], None)
    assert M.parse_display(None) == ([], None) and M.parse_display("  ") == ([], None)


def test_levels():
    assert M.fold("  Lømond-SØRÑ ") == "lomond sorn" and M.fold("0'Br1en") == "obrlen" and M.fold(None) == ""
    assert M.distance("abcd", "abdc") == 1 and M.distance("abc", "abcd") == 1
    assert [M.birth_level(*p) for p in (("2000-02-03", "2000-02-03"), ("2000-02-03", "2000-03-02"), ("2000-02-03", "2000-02-13"), ("2000-02-03", "2000"), ("2000-02-03", "2000-01-01"), ("2000-02-03", "1970-11-25"), (None, "2000"))] == [4, 3, 3, 2, 2, 0, -1]
    assert M.gender_level("male", "banana") == -1 and M.gender_level("male", "female") == 0
    assert M.postal_level(" 37000", "37000") == 2 and M.postal_level("", "37000") == -1


def test_assignment_is_one_to_one_and_best():
    pairs = [("p1", "a", 30.0), ("p1", "b", 29.0), ("p2", "a", 28.0), ("p3", "c", 20.0)]
    assert sorted(M.assign(pairs, {"a": 0, "b": 1, "c": 2})) == [("p1", "b", 29.0), ("p2", "a", 28.0), ("p3", "c", 20.0)]
    assert sorted(M.assign(pairs, {"a": 0, "b": 0, "c": 2})) == [("p1", "a", 30.0), ("p1", "b", 29.0), ("p3", "c", 20.0)]


def test_small_cases(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    patients = [
        patient(1, "Emora Lin", "Tessen", "01.02.1980"), patient(1, "Emora Lin", "Tessen", "01.02.1980"),  # delivered twice
        patient(2, "Adar", "Torberg", "1990-07-24"), patient(3, "Taminin", "Torberg", "1990-07-24"),  # twins
        patient(4, "Odeus", "Calkov", "1946-08-29"),
        (None, None, None, None, None, None, None, None), ("s9", "pt-9", None, None, None, None, None, None), ("s8", "pt-8", "male", "1", [None, (None, None, None)], [None], (None,), None),
    ]
    labs = [
        ("x1", "emora", "TESSEN", "1980-02-01", "male", "37000", ""), ("x1", "emora", "TESSEN", "1980-02-01", "male", "37000", ""),
        ("x1b", "Lin", "Tesen", "1980-01-02", "unknown", "37000", ""),  # the same person again, by the other name
        ("x2", "Torberg", "Adra", "1990-07-24", None, "37000", ""),  # order swapped, a slip
        ("x4", "Odeus", "Calkov", "1975-01-15", "male", "37000", ""),  # the son
        ("x5", None, None, None, None, None, ""), (None, "a", "b", None, None, None, ""), ("x6", "", " ", "", "", "", ""),
    ]
    got = sorted(map(tuple, M.found(*tables(spark, patients, labs, [("x1", "Tessen, Emora (1980-02-01)"), ("x1", None), (None, "x")])).collect()))
    assert got == [("pt-1", "x1"), ("pt-1", "x1b"), ("pt-2", "x2")]


def test_empty_tables(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert M.found(*tables(spark, [], [])).collect() == []
    assert M.found(*tables(spark, [patient(1, "A", "B", "1990")], [])).collect() == []


def noisy(rnd, word):
    k = rnd.randrange(len(word))
    return rnd.choice([word.upper(), word, word[:k] + word[k] + word[k:], word[:k] + word[k + 1 :], word[:k] + "x" + word[k + 1 :]])


@pytest.mark.parametrize("hot", [False, True])
def test_planted_people_are_found(spark, tmp_path, hot):
    """Recall and precision on planted copies; with ``hot`` a third of the people share family, place and year."""
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rnd = random.Random(4)
    syl = ["ba", "co", "da", "fen", "gor", "hel", "is", "jar", "kel", "lor", "mar", "nor", "os", "per", "qui", "ros", "sal", "tes"]
    name = lambda n: "".join(rnd.choice(syl) for _ in range(n)).title()
    patients, labs, truth = [], [], set()
    for i in range(900):
        h = hot and i % 3 == 0
        given, family = name(3), "Hotfamily" if h else name(3)
        born = f"{1980 if h else rnd.randint(1930, 2010)}-{rnd.randint(1, 12):02d}-{rnd.randint(2, 28):02d}"
        postal = "37555" if h else f"37{rnd.randrange(1000):03d}"
        patients.append(patient(i, given, family, born, postal=postal))
        if i % 2:
            labs.append((f"x{i}", noisy(rnd, given), family if h else noisy(rnd, family), born, "male", postal if i % 5 else "37001", ""))
            truth.add((f"pt-{i}", f"x{i}"))
        else:
            labs.append((f"x{i}", name(3), "Hotfamily" if h else name(3), f"{rnd.randint(1930, 2010)}-05-05", "male", postal, ""))
    got = set(map(tuple, M.found(*tables(spark, patients, labs)).collect()))
    assert len(got & truth) >= 0.97 * len(truth) and len(got & truth) >= 0.98 * len(got)


def test_large_components_are_one_to_one(spark, tmp_path, monkeypatch):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    ada, zora, cid = ("Ada", "Torberg", "1980-02-01", "male", "37000"), ("Zora", "Other", "1933-11-12", "female", "1"), ("Cid", "Quay", "1950-01-01", "female", "2")
    rows = [("p1", "a", 30.0, *ada), ("p1", "a2", 29.0, *ada), ("p1", "b", 20.0, *zora), ("p2", "b", 19.0, *zora), ("p2", "c", 18.0, *cid)]
    pairs = spark.createDataFrame(rows, "fhir_id string, unique_id string, score double, given_name string, family_name string, birth_date string, gender string, postal_code string")
    monkeypatch.setattr(M, "candidates", lambda *tables: pairs)
    monkeypatch.setattr(M, "EXACT", 1)
    assert sorted(map(tuple, M.matches(pairs, None, None, None).select("fhir_id", "unique_id").collect())) == [("p1", "a"), ("p1", "a2"), ("p2", "b")]


def test_rows_do_not_depend_on_the_size_of_components(spark, tmp_path, monkeypatch):
    """Contested and tied components give the same rows, with the largest total, on either side of ``EXACT``."""
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rnd = random.Random(6)
    people = [("".join(rnd.choices("abcdefghijklmnop", k=8)), "".join(rnd.choices("abcdefghijklmnop", k=8)), f"{1900 + k}-{k % 12 + 1:02d}-{k % 28 + 1:02d}", "male", f"{k * 977:05d}") for k in range(62)]
    rows = [("a1", "a", 20.0, *people[60]), ("a1", "b", 19.0, *people[61]), ("a2", "a", 19.0, *people[60])]  # mutual best alone gives 20
    for c in range(12):
        for k in range(rnd.randint(2, 9)):
            who = people[rnd.randrange(60)]
            for p in rnd.sample(range(6), rnd.randint(1, 4)):
                rows.append((f"c{c}p{p}", f"c{c}x{k}", 17 + rnd.randrange(rnd.choice([1, 3, 30])) / 2, *who))
    pairs = spark.createDataFrame(rows, "fhir_id string, unique_id string, score double, given_name string, family_name string, birth_date string, gender string, postal_code string")
    monkeypatch.setattr(M, "candidates", lambda *tables: pairs)
    got = []
    for exact in (100_000, 8, 1):
        monkeypatch.setattr(M, "EXACT", exact)
        got.append(sorted(map(tuple, M.matches(pairs, None, None, None).select("fhir_id", "unique_id").collect())))
    assert {("a1", "b"), ("a2", "a")} <= set(got[0]) and got[0] == got[1] == got[2]


def test_assignment_is_exact_at_any_size():
    rnd = random.Random(5)

    def largest(weight, groups, used=frozenset()):
        if not groups:
            return 0.0
        return max([largest(weight, groups[1:], used)] + [s + largest(weight, groups[1:], used | {p}) for (g, p), s in weight.items() if g == groups[0] and p not in used])

    for _ in range(400):
        n = rnd.randint(1, 6)
        weight = {(g, f"p{rnd.randrange(n)}"): 17 + rnd.randrange(40) / 2 for g in range(n) for _ in range(rnd.randint(1, 4))}
        got = M.assign([(p, f"x{g}", s) for (g, p), s in weight.items()], {f"x{g}": g for g in range(n)})
        assert len({p for p, _, _ in got}) == len(got) == len({q for _, q, _ in got})
        assert sum(s for *_, s in got) == largest(weight, list(range(n)))
    # 30 groups contest 12 patients; the largest total over sets of patients.
    weight = {(g, p): 17 + rnd.randrange(40) / 2 for g in range(30) for p in range(12)}
    best = {0: 0.0}
    for g in range(30):
        new = dict(best)
        for used, total in best.items():
            for p in range(12):
                if not used >> p & 1:
                    new[used | 1 << p] = max(new.get(used | 1 << p, 0.0), total + weight[g, p])
        best = new
    got = M.assign([(f"p{p}", f"x{g}", s) for (g, p), s in weight.items()], {f"x{g}": g for g in range(30)})
    assert len(got) == 12 and sum(s for *_, s in got) == max(best.values())


def test_short_ranges_keep_neighbours_together(spark, tmp_path, monkeypatch):
    """Ranges with fewer entries than the window, and empty ones, lose no pair of neighbours."""
    import pandas as pd

    from cairnlake.llm import matching

    entries = []
    for k in range(40):
        own = "P" if k % 2 else "L"
        rec = {"i": f"{own}{k:03d}", "n": [["ada", f"torberg{k // 2}"]], "b": ["1970-01-02"], "g": "female", "p": "123"}
        entries.append((1, f"torberg{k // 2:02d}", rec["i"], json.dumps(rec)))
    want = {(f"{2 * k + 1:03d}", f"{2 * k:03d}") for k in range(20)}
    for cuts in ([0, 40], [0, 3, 3, 5, 6, 20, 21, 22, 40], list(range(41))):
        frames = []
        for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            monkeypatch.setattr("pyspark.TaskContext.get", classmethod(lambda cls, part=part: type("T", (), {"partitionId": lambda self: part})()))
            rows = pd.DataFrame(entries[a:b], columns=["pass", "skey", "rid", "rec"])
            frames += list(matching._windows(iter([rows])))
        out = pd.concat(frames)
        sizes = dict(zip(out[out.kind == 2]["boundary"], out[out.kind == 2]["pass"], strict=True))
        group = matching.boundary_groups(sizes)
        got = set(map(tuple, out[out.kind == 0][["fhir_id", "unique_id"]].to_numpy()))
        ends = out[out.kind == 1].assign(boundary=lambda d: d["boundary"].map(group))
        for _, part in ends.groupby("boundary"):
            got |= set(map(tuple, matching._boundary(part)[["fhir_id", "unique_id"]].to_numpy()))
        assert want <= got
