import pytest
from brute_instants import brute
from pyspark.sql import functions as F

from cairnlake.operators import instants
from cairnlake.sources.tables import table

SOURCES = [("vienna", "Europe/Vienna", "dmy"), ("chicago", "America/Chicago", "mdy"), ("nozone", None, None), ("badzone", "Mars/Base", "dmy")]
CASES = [
    ("2024-03-31 02:30:00", "vienna", False, "undetermined"),  # skipped by the zone
    ("2024-10-27 02:30:00", "vienna", False, "undetermined"),  # there twice
    ("2024-10-27 03:30:00", "vienna", False, "2024-10-27T02:30:00.000Z"),
    ("2024-03-31T02:30:00+01:00[Europe/Vienna]", None, False, "undetermined"),  # the zone hasn't that offset then
    ("2024-06-01T12:00:00+02:00[Europe/Vienna]", None, False, "2024-06-01T10:00:00.000Z"),
    ("3/4/2024 1:05 PM", "chicago", False, "2024-03-04T19:05:00.000Z"),
    ("3/4/2024 13:05 PM", "chicago", False, "undetermined"),
    ("3.4.2024", "vienna", False, "2024-04-03"),
    ("3.4.2024", None, False, "undetermined"),
    ("2024-02-30", "vienna", False, "undetermined"),
    ("2023-02-29", "vienna", True, "undetermined"),
    ("1706765484072", None, False, "2024-02-01T05:31:24.072Z"),
    ("1706765484", None, False, "2024-02-01T05:31:24.000Z"),
    ("20240229", None, False, "2024-02-29"),
    ("2024-02-01T00:00:00.123456789Z", None, False, "2024-02-01T00:00:00.123Z"),
    ("2024-02-01 10:00:00", "nozone", False, "undetermined"),
    ("2024-02-01 10:00:00", "badzone", False, "undetermined"),
    ("2024-02-01 10:00:00", "unheard-of", False, "undetermined"),
    ("2024-02-01T10:00:00+25:00", None, False, "undetermined"),
    ("2024-02-01T24:00:00Z", None, False, "undetermined"),
    ("Mon, 01 Feb 2024 03:11:49 +0200", None, False, "undetermined"),  # it was a Thursday
    ("Thu, 01 Feb 2024 03:11:49 +0200", None, False, "2024-02-01T01:11:49.000Z"),
    ("1999-07-04T23:59:00.000+14:00", None, True, "1999-07-04"),
    ("05/1937", None, True, "1937-05"),
    ("13/1937", None, True, "undetermined"),
    ("0000", None, True, "undetermined"),
    ("", None, False, "undetermined"),
    ("  \t ", None, False, "undetermined"),
    (None, "vienna", False, None),
    ("x" * 100_000, "vienna", False, "undetermined"),
    ("\x01|1|2", "vienna", False, "undetermined"),
]


def run(spark, rows):
    z = spark.createDataFrame(SOURCES, "source_name string, time_zone string, date_order string")
    df = spark.createDataFrame(rows, "i int, value string, source string, date_only boolean, time_zone string")  # an extra column with a clashing name
    return {r["i"]: r["normal_form"] for r in instants.normal_form(df, "value", "source", "date_only", z).collect()}


def test_cases(spark):
    got = run(spark, [(i, v, s, b, "kept") for i, (v, s, b, _) in enumerate(CASES)])
    assert got == {i: want for i, (_, _, _, want) in enumerate(CASES)}


def test_empty(spark):
    assert run(spark, []) == {}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_plain_reading(spark, data, sf):
    d = f"{data}/{sf}"
    t = lambda n: table(spark, d, n)
    zones = {r[0]: (r[1], r[2]) for r in t("ingest_source").collect()}
    want = {}
    for name, key, field, source in (("bronze", "_commit_version", "last_updated", "_ingest_source"), ("observation", "silver_id", "effectiveInstant", "meta.source"), ("specimen", "silver_id", "collection.collectedDateTime", "meta.source"), ("patient", "silver_id", "birthDate", "meta.source")):
        for k, v, s in t(name).select(F.col(key).cast("string"), F.col(field), F.col(source)).where(F.col(field).isNotNull()).collect():
            r = brute(v, s, name == "patient", zones)
            if r != v:
                want[name, k] = r
    got = {(r[0], r[1]): r[2] for r in instants.found(t("bronze"), t("observation"), t("specimen"), t("patient"), t("ingest_source")).collect()}
    assert got == want
