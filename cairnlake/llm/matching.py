"""Matching the persons of two registers that share no key.

Sorted neighbourhood over several composite sort keys: every record gives one
entry per key and reading of its name (variants, both orders where a text
doesn't tell). Entries are range partitioned and sorted by (pass, key, record),
so a key that a third of all records share is spread over partitions, and a
window of ``WINDOW`` entries slides over each partition; the entries at a
partition's ends are compared again in one small group per boundary. In the
window, records of different registers are compared field by field; the
weights add up to a score in bits, and pairs above ``THRESHOLD`` are kept with
a confidence. Pairs form components; in each, the laboratory's records of one
person are first put together (some people are in it twice) and these groups
are assigned one-to-one to patients so that the total confidence is largest.

Weights are fixed: log2-like odds of how often a field agrees to that level
among one person's records and among others'. A slip is one edit, a swap of
neighbours, or a digit; names are folded for case, accents, particles and
scanning marks first.

Odd cases: null fields weigh little or nothing; records without any name or
with a null id are left out; repeated rows count once (of rows of one id that
differ, the smallest silver_id's or the smallest row); empty tables give an
empty result; extra columns aren't read. The assignment is exact and the same at
any size; ``EXACT`` only says from where on a component travels to its task as
numbers (``assign_large``) and no longer as records.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.operators.components import connected_components
from cairnlake.operators.instants import UNDETERMINED, normal_form
from cairnlake.session import shared_dir

#: Entries that a window holds.
WINDOW = 24
#: Bits from which a pair counts as one person; the confidence there is 0.5.
THRESHOLD = 17.0
#: Pairs of a component up to which its task gets whole records, above which numbers; the rows are the same.
EXACT = 100_000
# The laboratory record's fields that are compared.
FIELDS = ["given_name", "family_name", "birth_date", "gender", "postal_code"]
# Weights in bits by level of agreement (see the functions below); -1 is unknown.
FAMILY = {4: 9, 3: 6, 2: 3, 1: 0.5, 0: -8, -1: -1}
GIVEN = {4: 8, 3: 5, 2: 3, 1: 1, 0: -12, -1: -1}
BIRTH = {4: 11, 3: 8, 2: 1, 1: -8, 0: -14, -1: -2}
POSTAL = {2: 6, 1: 3, 0: -2, -1: 0}
GENDER = {1: 1, 0: -12, -1: 0}

# Letters that Unicode doesn't decompose, and digits that a scan puts for letters.
_FOLD = str.maketrans({"ø": "o", "œ": "oe", "æ": "ae", "ß": "ss", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "0": "o", "1": "l", "5": "s", "8": "b", "’": "'", "ı": "i"})
# Name particles.
_PARTICLES = {"de", "der", "del", "la", "van", "von", "di", "da", "du", "le", "of", "den", "dos"}


def fold(name: str | None) -> str:
    """Letters of a name: case, accents, digraphs for accents and scanning marks folded."""
    s = unicodedata.normalize("NFKD", (name or "").casefold().translate(_FOLD))
    s = "".join(c for c in s if not unicodedata.combining(c)).replace("oe", "o").replace("ue", "u").replace("ae", "a")
    return " ".join(re.sub(r"[^a-z. ]+", " ", s.replace("'", "")).split())


def distance(a: str, b: str) -> int:
    """Edits between two short texts, a swap of neighbours being one."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 3:
        return 9
    before2: list[int] = []
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before2[j - 2] + 1)
            row.append(d)
        if min(row) > 3:
            return 9  # no level asks for more
        before2, before = before, row
    return before[-1]


def one_slip(a: str, b: str) -> bool:
    """Whether two texts are at most one edit apart, without a table."""
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    return a[1:] == b[1:] or a[1:] == b or a == b[1:] or (a[2:] == b[2:] and a[:2] == b[:2][::-1])


def parse_display(text: str | None) -> tuple[list[tuple[str, str]], str | None]:
    """(given, family) readings of a requester's text, and its birth date (ISO) if it has one.

    Layouts: ``Family, Given (date)``, ``Given Family *d.m.y``, ``FAMILY G.`` and, in either order, ``A B``.
    """
    if not text or not text.strip():
        return [], None
    t, born = text.strip(), None
    if m := re.search(r"\((\d{4}-\d\d(?:-\d\d)?|\d{4})\)\s*$", t):
        born, t = m[1], t[: m.start()]
    elif m := re.search(r"\*\s*(\d\d)\.(\d\d)\.(\d{4})\s*$", t):
        born, t = f"{m[3]}-{m[2]}-{m[1]}", t[: m.start()]
    if "," in t:
        fam, given = t.split(",", 1)
        return [(fold(given), fold(fam))], born
    words = fold(t).split()
    if len(words) < 2:
        return [("", words[0])] if words else [], born
    if len(words[-1].rstrip(".")) == 1:
        return [(words[-1], " ".join(words[:-1]))], born
    split = [(" ".join(words[:k]), " ".join(words[k:])) for k in range(1, len(words))]
    return split + [(b, a) for a, b in split], born


def family_level(a: str, b: str) -> int:
    """4 same, 3 a slip apart, 2 part of a double name or two slips, 1 an initial, 0 different, -1 unknown."""
    if not a or not b:
        return -1
    if a == b:
        return 4
    short, long = sorted((a.replace(".", ""), b.replace(".", "")), key=len)
    if len(short) == 1:
        return 1 if any(w[0] == short for w in long.split()) else 0
    ca, cb = a.replace(" ", ""), b.replace(" ", "")
    d = distance(ca, cb)
    if d == 0:
        return 4
    if d == 1 or d == 2 and min(len(ca), len(cb)) >= 9:
        return 3
    wa = [w for w in a.split() if w not in _PARTICLES]
    wb = [w for w in b.split() if w not in _PARTICLES]
    if wa and wb and (len(wa) > 1 or len(wb) > 1 or len(wa) != len(a.split()) or len(wb) != len(b.split())):
        best = min(distance(x, y) for x in wa for y in wb)
        if best == 0:
            return 3 if len(wa) == len(wb) == 1 else 2
        if best == 1:
            return 2
    if d == 2 and min(len(ca), len(cb)) >= 6 or d == 3 and min(len(ca), len(cb)) >= 9:
        return 2
    near, far = sorted((ca, cb), key=len)
    return 1 if d == 2 and len(near) >= 4 or len(near) >= 3 and (far.startswith(near) or len(near) >= 4 and distance(near, far[: len(near)]) <= 1) else 0


def given_level(a: str, b: str) -> int:
    """4 same, 3 a slip apart, 2 a short form or two slips, 1 an initial, 0 different, -1 unknown."""
    if not a or not b:
        return -1
    best = 0
    for i, x in enumerate(a.split()):
        for j, y in enumerate(b.split()):
            p, q = x.rstrip("."), y.rstrip(".")
            if not p or not q:
                continue
            if len(p) == 1 or len(q) == 1:
                lv = 1 if p[0] == q[0] else 0
            elif p == q:
                lv = 4
            else:
                d = distance(p, q)
                short, long = sorted((p, q), key=len)
                lv = 3 if d == 1 or d == 2 and len(short) >= 8 else 2 if len(short) >= 3 and long.startswith(short) or d == 2 and len(short) >= 6 else 0
                if not lv and (d == 2 and len(short) >= 4 or len(short) >= 4 and distance(short, long[: len(short)]) <= 1):
                    lv = 1
            if (i or j) and lv:  # a second given name
                lv = max(1, lv - 1)
            best = max(best, lv)
    return best


def birth_level(a: str | None, b: str | None) -> int:
    """4 same day, 3 day and month swapped, a slip or 1 or 10 days off, 2 the same as far as known (also a year's first day), 1 the same year, or day of the year, 0 different, -1 unknown."""
    if not a or not b:
        return -1
    if a == b:
        return 4 if len(a) == 10 else 2
    k = min(len(a), len(b))
    if k == 10 and a[5:] != b[5:] and abs(int(a[:4]) - int(b[:4])) > 1:
        return 0  # the usual case: nothing in common
    if k < 10:
        return 2 if a[:k] == b[:k] else 0
    if a[:4] == b[:4] and a[5:7] == b[8:] and a[8:] == b[5:7]:
        return 3
    da, db = a.replace("-", ""), b.replace("-", "")
    diff = [i for i in range(8) if da[i] != db[i]]
    if len(diff) == 1:
        return 3
    if len(diff) == 2 and diff[1] == diff[0] + 1 and da[diff[0]] == db[diff[1]] and da[diff[1]] == db[diff[0]]:
        return 3
    from datetime import date

    try:
        if abs((date.fromisoformat(a) - date.fromisoformat(b)).days) in (1, 10):
            return 3
    except ValueError:
        pass
    if a[:4] == b[:4] and (a[4:] == "-01-01" or b[4:] == "-01-01"):
        return 2
    return 1 if a[:4] == b[:4] or a[5:] == b[5:] else 0


def postal_level(a: str | None, b: str | None) -> int:
    """2 same, 1 a slip apart, 0 different, -1 unknown."""
    a, b = (a or "").strip(), (b or "").strip()
    if not a or not b:
        return -1
    return 2 if a == b else 1 if one_slip(a, b) else 0


def gender_level(a: str | None, b: str | None) -> int:
    """1 same, 0 different, -1 unless both are known."""
    if a not in ("male", "female") or b not in ("male", "female"):
        return -1
    return 1 if a == b else 0


# Results of comparisons by their arguments; names and dates repeat within a window. Plain
# dicts, as functions that are cached otherwise can't travel to the workers by value.
_SEEN: dict[tuple, int] = {}


def _remembered(how, a: str | None, b: str | None) -> int:
    key = (how.__name__, a, b)
    v = _SEEN.get(key)
    if v is None:
        if len(_SEEN) > 80_000:
            _SEEN.clear()
        v = _SEEN[key] = how(a, b)
    return v


def _record(rid: str, names: list[tuple[str, str]], births: list[str], gender: str | None, postal: str | None) -> dict:
    """A record as it travels: names as (given, family), the longest readings first."""
    full = [n for n in dict.fromkeys(names) if any(n)]
    return {"i": rid, "n": full, "b": sorted(set(births)), "g": gender, "p": postal}


def _is_initial(name: str) -> bool:
    return bool(name) and len(name.replace(".", "").strip()) <= 1


def score(p: dict, q: dict) -> float:
    """Bits for a patient and a laboratory record being one person."""
    birth = max((birth_level(x, y) for x in p["b"] for y in q["b"]), default=-1)
    gender = gender_level(p["g"], q["g"])
    rest = BIRTH[birth] + GENDER[gender]
    if rest + POSTAL[2] + FAMILY[4] + GIVEN[4] < THRESHOLD:
        return rest  # no name can make up for it
    rest += POSTAL[postal_level(p["p"], q["p"])]
    if rest + FAMILY[4] + GIVEN[4] < THRESHOLD:
        return rest + FAMILY[4] + GIVEN[4]
    if "f" not in p:
        p["f"], p["v"] = {f for _, f in p["n"]}, {g for g, _ in p["n"]}
    families, givens = p["f"], p["v"]
    told = any(g and not _is_initial(g) and f and not _is_initial(f) for g, f in q["n"])
    best = -99.0
    for k, (g, f) in enumerate(q["n"]):
        if told and (_is_initial(g) or _is_initial(f)):
            continue  # an initial says nothing where the name is known
        for swap, (a, b) in enumerate(((g, f), (f, g))):
            if swap and k:
                break
            fl = max((_remembered(family_level, x, b) for x in families), default=-1)
            gl = max((_remembered(given_level, x, a) for x in givens), default=-1)
            best = max(best, FAMILY[fl] + GIVEN[gl] - 0.5 * swap)
    return rest + best


def _keys(r: dict) -> set[tuple[int, str]]:
    """The record's sort keys by pass."""
    out: set[tuple[int, str]] = set()
    postal = (r["p"] or "").strip()
    for k, (g, f) in enumerate(r["n"]):
        for a, b in ((g, f), (f, g)) if k == 0 and r["i"][:1] == "L" else ((g, f),):
            first, fam = (a.split() or [""])[0].rstrip("."), b.replace(" ", "")
            for born in r["b"] or [""]:
                out.add((1, f"{fam}|{born}|{first}"))
                if born:
                    out |= {(2, f"{born}|{fam}|{first}"), (3, f"{born}|{first}|{fam}")}
            if postal:
                out |= {(4, f"{postal}|{fam}|{first}"), (5, f"{postal}|{first}|{fam}")}
            out.add((6, f"{first}|{fam}|{(r['b'] or [''])[0]}"))
    return out


_ENTRY = "pass int, skey string, rid string, rec string"
_FOUND = "kind int, boundary int, pass int, skey string, rid string, rec string, fhir_id string, unique_id string, score double"


def _patient_entries(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        rows = []
        for fid, names, born, gender, postal in zip(pdf["fhir_id"], pdf["name"], pdf["born"], pdf["gender"], pdf["postal"], strict=True):
            own = [n for n in (names if names is not None else []) if n]
            giv = [" ".join(fold(w) for w in (n["given"] if n["given"] is not None else []) if w) for n in own]
            fams = [fold(n["family"]) for n in own if n["family"]]
            pairs = [(g, fold(n["family"]) if n["family"] else "") for g, n in zip(giv, own, strict=True)]
            pairs = [(g or (giv[0] if giv else ""), f or (fams[0] if fams else "")) for g, f in pairs]
            r = _record("P" + fid, pairs, [born] if born else [], gender, postal)
            rec = json.dumps(r)
            rows += [(p, k, r["i"], rec) for p, k in _keys(r)]
        yield pd.DataFrame(rows, columns=["pass", "skey", "rid", "rec"])


def _lab_entries(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        rows = []
        for uid, given, family, born, gender, postal, said in zip(pdf["unique_id"], pdf["given_name"], pdf["family_name"], pdf["birth_date"], pdf["gender"], pdf["postal_code"], pdf["said"], strict=True):
            names, births = [(fold(given), fold(family))], [born.strip()] if born and re.fullmatch(r"\d{4}(-\d\d(-\d\d)?)?", born.strip()) else []
            for text in sorted(said if said is not None else []):
                more, b = parse_display(text)
                names += more
                births += [b] if b else []
            r = _record("L" + uid, names, births, gender, postal)
            rec = json.dumps(r)
            rows += [(p, k, r["i"], rec) for p, k in _keys(r)]
        yield pd.DataFrame(rows, columns=["pass", "skey", "rid", "rec"])


class _Slide:
    """A window over sorted entries; compares each with those before it."""

    def __init__(self, window: int):
        self.held: deque[tuple[int, dict]] = deque(maxlen=window)
        self.done: dict[tuple[str, str], float] = {}
        self.out: list[tuple[str, str, float]] = []

    def push(self, group: int, rec: dict) -> None:
        own = rec["i"][0]
        rec["s"] = own
        # Year and day of a record with one full birth date; years further apart on different days have nothing
        # in common (birth_level is 0), which no other field can make up for.
        born = rec["b"]
        rec["y"], rec["d"] = year, day = (int(born[0][:4]), born[0][5:]) if len(born) == 1 and len(born[0]) == 10 else (0, "")
        for g, other in self.held:
            if g != group or other["s"] == own:
                continue
            if year and other["y"] and day != other["d"] and not -2 < year - other["y"] < 2:
                continue
            p, q = (rec, other) if own == "P" else (other, rec)
            key = (p["i"], q["i"])
            if key not in self.done:
                if len(self.done) > 40_000:
                    self.done.clear()
                self.done[key] = s = score(p, q)
                if s >= THRESHOLD:
                    self.out.append((p["i"][1:], q["i"][1:], s))
        self.held.append((group, rec))


def _frame(pairs: list[tuple[str, str, float]]) -> pd.DataFrame:
    n = len(pairs)
    return pd.DataFrame({"kind": [0] * n, "boundary": [-1] * n, "pass": [0] * n, "skey": [None] * n, "rid": [None] * n, "rec": [None] * n, "fhir_id": [p for p, _, _ in pairs], "unique_id": [q for _, q, _ in pairs], "score": [s for _, _, s in pairs]})


def _windows(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part, slide, seen = TaskContext.get().partitionId(), _Slide(WINDOW), 0
    head: list[tuple] = []
    tail: deque[tuple] = deque(maxlen=WINDOW)
    for pdf in it:
        for p, k, i, rec in zip(pdf["pass"], pdf["skey"], pdf["rid"], pdf["rec"], strict=True):
            slide.push(p, json.loads(rec))
            if seen < WINDOW:
                head.append((p, k, i, rec))
            tail.append((p, k, i, rec))
            seen += 1
        if slide.out:
            yield _frame(slide.out)
            slide.out.clear()
    # The last row says how many entries there were.
    ends = [(1, part - 1, *e) for e in head] + [(1, part, *e) for e in tail] + [(2, part, seen, None, None, None)]
    d = pd.DataFrame(ends, columns=["kind", "boundary", "pass", "skey", "rid", "rec"])
    yield d.assign(fhir_id=None, unique_id=None, score=None)


def _boundary(pdf: pd.DataFrame) -> pd.DataFrame:
    slide = _Slide(WINDOW)
    for p, _, _, rec in sorted(set(zip(pdf["pass"], pdf["skey"], pdf["rid"], pdf["rec"], strict=True))):
        slide.push(p, json.loads(rec))
    return pd.DataFrame(slide.out, columns=["fhir_id", "unique_id", "score"])


def boundary_groups(sizes: dict[int, int]) -> dict[int, int]:
    """The group of each boundary (k lies behind range k), from the entries that each range has."""
    group = {-1: -1}
    for k in range(max(sizes, default=-1) + 1):
        group[k] = group[k - 1] if sizes.get(k, 0) < WINDOW else k
    return group


def candidates(patient: DataFrame, linkage_record: DataFrame, specimen: DataFrame, sources: DataFrame) -> DataFrame:
    """Pairs above the threshold: fhir_id, unique_id, score and the laboratory record's fields."""
    spark = patient.sparkSession
    one = patient.where("fhir_id is not null").select("fhir_id", F.struct("silver_id", "name", "birthDate", "gender", F.get("address", 0)["postalCode"].alias("postal"), F.col("meta.source").alias("source")).alias("r"))
    one = one.groupBy("fhir_id").agg(F.min_by("r", F.coalesce("r.silver_id", F.lit(""))).alias("r")).select("fhir_id", "r.name", "r.birthDate", "r.gender", "r.postal", "r.source", F.lit(True).alias("date_only"))
    born = normal_form(one, "birthDate", "source", "date_only", sources, "born").withColumn("born", F.when(F.col("born") != UNDETERMINED, F.col("born")))
    patients = born.select("fhir_id", "name", "born", "gender", "postal").mapInPandas(_patient_entries, _ENTRY)
    said = specimen.select(F.col("subject.identifier.value").alias("unique_id"), F.col("subject.display").alias("display")).where("unique_id is not null and display is not null").distinct()
    said = said.groupBy("unique_id").agg(F.collect_list("display").alias("said"))
    labs = linkage_record.where("unique_id is not null").groupBy("unique_id").agg(F.min(F.struct(*FIELDS)).alias("r")).select("unique_id", *[f"r.{c}" for c in FIELDS])
    entries = patients.unionByName(labs.join(said, "unique_id", "left").mapInPandas(_lab_entries, _ENTRY)).checkpoint()
    # Ranges differ in work (entries of one birth date compare in full), so there are more of them than shuffle partitions.
    n = max(1, min(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), entries.count() // (WINDOW * 50)))
    slid = entries.repartitionByRange(n, "pass", "skey", "rid").sortWithinPartitions("pass", "skey", "rid").mapInPandas(_windows, _FOUND).checkpoint()
    inside = slid.where("kind = 0").select("fhir_id", "unique_id", "score")
    # A range shorter than the window doesn't part its neighbours: the boundaries on either side are one group.
    sizes = {r["boundary"]: r["pass"] for r in slid.where("kind = 2").select("boundary", "pass").collect()}  # one number a range
    joined = spark.createDataFrame(list(boundary_groups(sizes).items()), "boundary int, grp int")
    across = slid.where("kind = 1").join(F.broadcast(joined), "boundary").drop("boundary").withColumnRenamed("grp", "boundary").groupBy("boundary").applyInPandas(_boundary, "fhir_id string, unique_id string, score double")
    return inside.unionByName(across).groupBy("fhir_id", "unique_id").agg(F.max("score").alias("score")).join(labs, "unique_id")


def solve(group: np.ndarray, patient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The edges (by position) of the one-to-one assignment of groups to patients with the largest total.

    An edge is a group's number, a patient's and a weight above 0; numbers count from 0 without gaps and come
    once a pair. Exact by shortest augmenting paths: the groups come one by one, and each takes the path that
    adds most, at whose end is a free patient or a group (maybe itself) that goes without. Ties are settled by
    the numbers' order alone. Edges and partners stay in arrays; only what
    a single search reaches is in dicts.
    """
    by_group = np.argsort(group, kind="stable")
    first = np.searchsorted(group[by_group], np.arange(group.max(initial=-1) + 2))
    patient_of, weight_of = patient[by_group].astype(np.int32), weight[by_group]
    del by_group
    # Potentials: group + patient >= weight, with equality for the taken; those of the free are 0.
    of_group, of_patient = array("d", bytes(8 * (len(first) - 1))), array("d", bytes(8 * (int(patient.max(initial=-1)) + 1)))
    taken, has = array("q", [-1]) * len(of_patient), array("q", [-1]) * len(of_group)  # -1 is nobody
    for start in range(len(of_group)):
        own = slice(first[start], first[start + 1])
        of_group[start] = max(0.0, max(s - of_patient[p] for p, s in zip(patient_of[own].tolist(), weight_of[own].tolist(), strict=True)))
        far, came = {start: 0.0}, {}
        near: dict[int, float] = {}
        heap: list[tuple[float, int]] = []
        end, length = (start, -1), of_group[start]
        g = start
        while True:
            own = slice(first[g], first[g + 1])
            for p, s in zip(patient_of[own].tolist(), weight_of[own].tolist(), strict=True):
                d = far[g] + of_group[g] + of_patient[p] - s
                if d < length and d < near.get(p, length):
                    near[p], came[p] = d, g
                    heapq.heappush(heap, (d, p))
            while heap and (heap[0][0] > near[heap[0][1]] or taken[heap[0][1]] in far):
                heapq.heappop(heap)
            if not heap or heap[0][0] >= length:
                break
            d, p = heapq.heappop(heap)
            if taken[p] < 0:
                end, length = (-1, p), d
                break
            g = taken[p]
            far[g] = d
            if d + of_group[g] < length:
                end, length = (g, -1), d + of_group[g]
        for g, d in far.items():
            of_group[g] -= max(0.0, length - d)
        for p, d in near.items():
            of_patient[p] += max(0.0, length - d)
        g, p = end
        if p < 0:
            p, has[g] = has[g], -1  # goes without, and leaves its patient to the one before
        while p >= 0:
            g = came[p]
            before = has[g]
            taken[p], has[g] = g, p
            p = before
    return np.flatnonzero(np.array(has, np.int64)[group] == patient)


def assign(pairs: list[tuple[str, str, float]], same: dict[str, int]) -> list[tuple[str, str, float]]:
    """One-to-one between patients and groups of laboratory records with the largest total.

    ``same`` maps a record to its group. Ties are settled by the order of groups and patients.
    """
    best: dict[tuple[int, str], float] = {}
    for p, q, s in pairs:
        best[same[q], p] = max(best.get((same[q], p), 0.0), s)
    edges = list(best)
    group = np.unique([g for g, _ in edges], return_inverse=True)[1]
    number = {p: k for k, p in enumerate(sorted({p for _, p in edges}))}
    taken = solve(group, np.array([number[p] for _, p in edges], np.int64), np.array(list(best.values())))
    kept = {edges[k] for k in taken}
    return [(p, q, s) for p, q, s in pairs if (same[q], p) in kept]


def _same_person(recs: dict[str, dict], best: dict[str, str], sure: set[str]) -> dict[str, str]:
    """The first record of each record's group.

    Two records whose best patient is the same one are one person if both are close to the patient (whose
    names are the fuller: either may go by another of them) or to each other.
    """
    first, of = {u: u for u in recs}, {}
    for u in sorted(recs):
        of.setdefault(best[u], []).append(u)
    for ids in of.values():
        for i, u in enumerate(ids):
            for v in ids[:i]:
                if first[u] != first[v] and (u in sure and v in sure or score(recs[u], recs[v]) >= THRESHOLD - 6):
                    old, new = max(first[u], first[v]), min(first[u], first[v])
                    first |= {w: new for w in ids if first[w] == old}
    return first


def _records_of(pdf: pd.DataFrame) -> dict[str, dict]:
    return {u: {"b": [b] if b else [], "g": g, "p": po, "n": [(fold(gn), fold(fn))]} for u, gn, fn, b, g, po in zip(pdf["unique_id"], pdf["given_name"], pdf["family_name"], pdf["birth_date"], pdf["gender"], pdf["postal_code"], strict=True)}


def _component(pdf: pd.DataFrame) -> pd.DataFrame:
    pairs = list(zip(pdf["fhir_id"], pdf["unique_id"], pdf["score"], strict=True))
    top: dict[str, tuple[float, str]] = {}
    for p, q, s in pairs:
        top[q] = max(top.get(q, (s, p)), (s, p))
    first = _same_person(_records_of(pdf), {q: p for q, (_, p) in top.items()}, {q for q, (s, _) in top.items() if s >= THRESHOLD + 4})
    number = {u: k for k, u in enumerate(sorted(first))}
    return pd.DataFrame(assign(pairs, {u: number[f] for u, f in first.items()}), columns=["fhir_id", "unique_id", "score"])


def _grouped(pdf: pd.DataFrame) -> pd.DataFrame:
    """Groups of the records of one best patient."""
    first = _same_person(_records_of(pdf), dict(zip(pdf["unique_id"], pdf["best"], strict=True)), set(pdf["unique_id"][pdf["top"] >= THRESHOLD + 4]))
    return pd.DataFrame({"unique_id": list(first), "person": list(first.values())})


def _in_order(ids: DataFrame) -> DataFrame:
    """Each id once with a number ``n`` that grows with it."""
    return ids.distinct().orderBy("id").withColumn("n", F.monotonically_increasing_id()).checkpoint()


def _solved(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges that each component keeps; a component's edges come one after the other."""

    def kept() -> pd.DataFrame:
        g, p, weight = (np.concatenate(held.pop(c)) for c in ("g", "p", "score"))  # the pieces go one by one
        own = solve(np.unique(g, return_inverse=True)[1], np.unique(p, return_inverse=True)[1], weight)
        return pd.DataFrame({"g": g[own], "p": p[own]})

    now: str | None = None
    held: dict[str, list[np.ndarray]] = {}
    for pdf in it:
        for component, rows in pdf.groupby("component", sort=False):
            if held and component != now:
                yield kept()
            now = component
            for c in ("g", "p", "score"):
                held.setdefault(c, []).append(rows[c].to_numpy(copy=True))
    if held:
        yield kept()


def assign_large(marked: DataFrame) -> DataFrame:
    """What ``_component`` gives of each component, ties included, for those whose records don't fit a task.

    Records are grouped by best patient, each apart. A component's edges then are streamed to one task as
    numbers that sort like the ids, so that the same solver settles it in the same way.
    """
    top = marked.groupBy("unique_id").agg(F.max(F.struct("score", "fhir_id")).alias("t"), *[F.first(c).alias(c) for c in FIELDS])
    persons = top.select("unique_id", F.col("t.fhir_id").alias("best"), F.col("t.score").alias("top"), *FIELDS).groupBy("best").applyInPandas(_grouped, "unique_id string, person string").checkpoint()
    named = marked.select("component", "fhir_id", "unique_id", "score").join(persons, "unique_id").checkpoint()
    groups, patients = _in_order(named.select(F.col("person").alias("id"))), _in_order(named.select(F.col("fhir_id").alias("id")))
    named = named.join(groups.select(F.col("id").alias("person"), F.col("n").alias("g")), "person").join(patients.select(F.col("id").alias("fhir_id"), F.col("n").alias("p")), "fhir_id").checkpoint()
    edges = named.groupBy("component", "g", "p").agg(F.max("score").alias("score"))
    kept = edges.repartition("component").sortWithinPartitions("component").mapInPandas(_solved, "g long, p long").checkpoint()
    return named.join(kept, ["g", "p"], "left_semi").select("fhir_id", "unique_id", "score")


def matches(patient: DataFrame, linkage_record: DataFrame, specimen: DataFrame, sources: DataFrame) -> DataFrame:
    """fhir_id, unique_id and confidence of each patient and laboratory record that are one person."""
    shared_dir(patient.sparkSession)
    pairs = candidates(patient, linkage_record, specimen, sources).checkpoint()
    nodes = connected_components(pairs.select(F.concat(F.lit("P"), "fhir_id").alias("a"), F.concat(F.lit("L"), "unique_id").alias("b")))
    marked = pairs.join(nodes.select(F.col("node").alias("n"), "component"), F.concat(F.lit("L"), F.col("unique_id")) == F.col("n")).drop("n")
    sizes = marked.groupBy("component").agg(F.count("*").alias("size")).checkpoint()
    marked = marked.join(sizes, "component").checkpoint()
    # A pair by itself needs no assignment; it stays in the JVM.
    alone = marked.where("size = 1").select("fhir_id", "unique_id", "score")
    small = marked.where(f"size between 2 and {EXACT}").groupBy("component").applyInPandas(_component, "fhir_id string, unique_id string, score double")
    done = alone.unionByName(small)
    if not sizes.where(f"size > {EXACT}").isEmpty():
        done = done.unionByName(assign_large(marked.where(f"size > {EXACT}")))
    return done.select("fhir_id", "unique_id", (1 / (1 + F.pow(F.lit(2.0), F.lit(THRESHOLD) - F.col("score")))).alias("confidence"))


def found(patient: DataFrame, linkage_record: DataFrame, specimen: DataFrame, sources: DataFrame) -> DataFrame:
    """fhir_id and unique_id of each match, once."""
    return matches(patient, linkage_record, specimen, sources).select("fhir_id", "unique_id").distinct()
