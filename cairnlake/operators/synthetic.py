"""Deterministic person records from the ``customer`` table, with planted cases.

They carry what the hospital tables lack: identifiers shared by two or three
records, conflicting authoritative numbers, death dates, inactive records.
Every rule is arithmetic on the key, so SQL over ``customer`` gives the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SSN = "http://hl7.org/fhir/sid/us-ssn"


def persons(customer: DataFrame) -> DataFrame:
    """id, gender, birthDate, family, given, identifier, active, deceased, last_updated."""
    k = "c_custkey"
    e = F.expr
    birth = f"cast(date_add(date'1940-01-01', cast({k} * 37 % 25000 as int)) as string)"
    ident = "struct({} as system, {} as value)"
    return customer.select(
        e(f"cast({k} as string)").alias("id"),
        e(f"case when {k} % 101 = 0 then 'banana' when {k} % 4 = 0 then 'male' when {k} % 4 = 1 then 'female' when {k} % 4 = 2 then 'unknown' end").alias("gender"),
        e(f"case when {k} % 11 = 0 then left({birth}, 4) when {k} % 7 = 0 then left({birth}, 7) else {birth} end").alias("birthDate"),
        e(f"concat('F', {k} % 97)").alias("family"),
        e(f"array(concat('G', {k} % 53), concat('H', {k} % 7))").alias("given"),
        e(f"""array_compact(array(
          {ident.format(f"if({k} % 2 = 0, 'http://hosp.example.org/mrn', 'HTTP://Hosp.Example.org/mrn/')", f"concat(' ', if({k} % 50 < 2, {k} - {k} % 50, {k}))")},
          case when ({k} + 20) % 90 < 3 then {ident.format("'urn:ins'", f"cast({k} + 20 - ({k} + 20) % 90 as string)")} end,
          case when {k} % 150 < 2 or {k} % 9 = 4 then {ident.format(f"'{SSN}'", f"concat('9-', {k})")} end))""").alias("identifier"),
        e(f"{k} % 40 <> 5").alias("active"),
        e(f"case when {k} % 60 = 1 then '2020-01-01T00:00:00Z' when {k} % 300 = 0 then '2020-03-01T00:00:00Z' end").alias("deceased"),
        e(f"concat('2024-01-', lpad({k} % 28 + 1, 2, '0'))").alias("last_updated"),
    )


PERSONS_SQL = f"""persons AS (SELECT c_custkey AS k, c_custkey::varchar AS id,
 CASE WHEN c_custkey % 101 = 0 THEN 'banana' WHEN c_custkey % 4 = 0 THEN 'male' WHEN c_custkey % 4 = 1 THEN 'female' WHEN c_custkey % 4 = 2 THEN 'unknown' END AS gender,
 left(strftime(date '1940-01-01' + (c_custkey * 37 % 25000)::int, '%Y-%m-%d'), CASE WHEN c_custkey % 11 = 0 THEN 4 WHEN c_custkey % 7 = 0 THEN 7 ELSE 10 END) AS birthDate,
 'F' || c_custkey % 97 AS family, 'G' || c_custkey % 53 AS given1, c_custkey % 40 <> 5 AS active,
 CASE WHEN c_custkey % 60 = 1 THEN '2020-01-01T00:00:00Z' WHEN c_custkey % 300 = 0 THEN '2020-03-01T00:00:00Z' END AS deceased,
 '2024-01-' || lpad((c_custkey % 28 + 1)::varchar, 2, '0') AS last_updated FROM customer),
 keys AS (SELECT id, 'http://hosp.example.org/mrn|' || CASE WHEN k % 50 < 2 THEN k - k % 50 ELSE k END AS key FROM persons
  UNION SELECT id, 'urn:ins|' || (k + 20 - (k + 20) % 90) FROM persons WHERE (k + 20) % 90 < 3
  UNION SELECT id, '{SSN}|9' || k FROM persons WHERE k % 150 < 2 OR k % 9 = 4)"""
