"""Mixed time notations to one unambiguous form, inside the JVM.

All notations are one regular expression: an alternation with named groups,
applied once per value by ``regexp_replace``. As only one alternative of a
component can match, the replacement ``${y1}${y2}...`` is that component. The
components are then checked against the calendar and turned into an instant by
integer day arithmetic. No Python runs per row and nothing is shuffled.

Results, also for the odd cases:

* null value: null; blank or unreadable text: ``undetermined``
* a wall-clock time that a zone skips or has twice: ``undetermined``
* a wall-clock time or year-last all-numeric date without a known source:
  ``undetermined``
* an offset beyond 14 hours, an offset that its bracketed zone doesn't have at
  that instant, a weekday that isn't the date's, hour 24, second 60, year 0:
  ``undetermined``
* repeated rows give repeated results; an empty table an empty one
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNDETERMINED = "undetermined"

# Months, weekdays and zone abbreviations with their usual fixed offset in minutes.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "SGT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570, "AEST": 600,
    "ACDT": 630, "AEDT": 660, "NZST": 720, "NZDT": 780, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

_MON = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DOW = "(?:(?<dow>mon|tue|wed|thu|fri|sat|sun)[a-z]{0,6},? +)?"
_DATES = [
    r"(?<y1>[0-9]{4})-(?<m1>[0-9]{1,2})-(?<d1>[0-9]{1,2})",
    r"(?<y2>[0-9]{4})/(?<m2>[0-9]{1,2})/(?<d2>[0-9]{1,2})",
    r"(?<y3>[0-9]{4})\.(?<m3>[0-9]{1,2})\.(?<d3>[0-9]{1,2})",
    rf"{_DOW}(?<d4>[0-9]{{1,2}})[ -](?<n4>{_MON})[ -](?<y4>[0-9]{{4}})",
    rf"(?<n5>{_MON}) +(?<d5>[0-9]{{1,2}}),? +(?<y5>[0-9]{{4}})",
    r"(?<a6>[0-9]{1,2})(?<sep>[./-])(?<b6>[0-9]{1,2})\k<sep>(?<y6>[0-9]{4})",
]
_ZONE = r"(?: *(?:(?<sg>[+-])(?<oh>[0-9]{2}):?(?<om>[0-9]{2})?|(?<ab>[a-z]{1,5})))?(?: *\[(?<zn>[a-z0-9_+/-]+)\])?"
_TIME = r"(?<h1>[0-9]{1,2}):(?<i1>[0-9]{2})(?::(?<s1>[0-9]{2})(?:[.,](?<f1>[0-9]{1,9}))?)?(?: ?(?<ap>[ap]m))?"
_BASIC = r"(?<y7>[0-9]{4})(?<m7>[0-9]{2})(?<d7>[0-9]{2})(?:t(?<h7>[0-9]{2})(?<i7>[0-9]{2})(?:(?<s7>[0-9]{2})(?:[.,](?<f7>[0-9]{1,9}))?)?(?: *(?:(?<sh>[+-])(?<ohb>[0-9]{2}):?(?<omb>[0-9]{2})?|(?<abb>[a-z]{1,5})))?)?"
_PARTIAL = [
    r"(?<y8>[0-9]{4})[-/](?<m8>[0-9]{2})",
    r"(?<m9>[0-9]{1,2})[-/.](?<y9>[0-9]{4})",
    rf"(?<n10>{_MON}) +(?<y10>[0-9]{{4}})",
    r"(?<y11>[0-9]{4})",
]
_EPOCH = r"(?<ep>[0-9]{13}|[0-9]{10})"
_BLANK = r"[\s ﻿]*"

#: Every notation: dates with an optional time and zone, the basic form, partial dates, counts from 1970.
PATTERN = rf"(?is)^{_BLANK}(?:(?:{'|'.join(_DATES)})(?:(?:[t ] *|, *){_TIME}{_ZONE})?|{_BASIC}|{'|'.join(_PARTIAL)}|{_EPOCH}){_BLANK}$"

#: Component: its groups. Of a component's groups at most one matches.
_PARTS = {
    "y": ["y1", "y2", "y3", "y4", "y5", "y6", "y7", "y8", "y9", "y10", "y11"],
    "m": ["m1", "m2", "m3", "m7", "m8", "m9"],
    "n": ["n4", "n5", "n10"],
    "d": ["d1", "d2", "d3", "d4", "d5", "d7"],
    "a": ["a6"],
    "b": ["b6"],
    "h": ["h1", "h7"],
    "i": ["i1", "i7"],
    "s": ["s1", "s7"],
    "f": ["f1", "f7"],
    "ap": ["ap"],
    "sg": ["sg", "sh"],
    "oh": ["oh", "ohb"],
    "om": ["om", "omb"],
    "ab": ["ab", "abb"],
    "zn": ["zn"],
    "dow": ["dow"],
    "ep": ["ep"],
}
_MARK = "\x01"


def _known_zones(spark: SparkSession) -> list[str]:
    """Zone names that the JVM knows (about 600), a constant of its time-zone data."""
    try:
        return sorted(str(z) for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds())
    except Exception:  # a client without a JVM
        return sorted(zoneinfo.available_timezones())


def _case(table: dict[str, int], of: str) -> str:
    return f"element_at(map({', '.join(f"'{k}', {v}" for k, v in table.items())}), {of})"


def _days(y: str, m: str, d: str) -> str:
    """Days since 1970-01-01 of a proleptic Gregorian date, in whole numbers."""
    yy = f"({y} - if({m} <= 2, 1, 0))"
    doy = f"((153 * ({m} + if({m} > 2, -3, 9)) + 2) div 5 + {d} - 1)"
    yoe = f"({yy} - ({yy} div 400) * 400)"
    return f"(({yy} div 400) * 146097 + {yoe} * 365 + {yoe} div 4 - {yoe} div 100 + {doy} - 719468)"


def normal_form(df: DataFrame, value: str, source: str, date_only: str, zones: DataFrame, out: str = "normal_form") -> DataFrame:
    """``df`` with the normal form of ``value`` in ``out``.

    ``source`` names the column with the row's source, ``date_only`` a boolean
    column: true where any time is dropped and the written date counts.
    ``zones`` is the table of sources (source_name, time_zone, date_order);
    its size is Catalyst's to check, so no broadcast is forced. Clashing
    column names are avoided by a prefix of its own (``_ts_``).
    """
    spark = df.sparkSession
    p = "_ts_"
    keep = df.columns
    src = zones.groupBy(F.col("source_name").alias(p + "src")).agg(F.min("time_zone").alias(p + "tz"), F.min("date_order").alias(p + "order"))
    df = df.join(src, df[source] == src[p + "src"], "left")

    replacement = _MARK + "|".join("".join(f"${{{g}}}" for g in groups) for groups in _PARTS.values())
    df = df.withColumn(p + "raw", F.regexp_replace(F.col(value), F.lit(PATTERN), F.lit(replacement)))
    ok = F.col(p + "raw").startswith(_MARK) & ~F.contains(F.col(value), F.lit(_MARK))
    df = df.withColumn(p + "x", F.when(ok, F.split(F.substring(F.col(p + "raw"), 2, 1 << 20), r"\|", len(_PARTS))))
    x = {k: f"nullif({p}x[{i}], '')" for i, k in enumerate(_PARTS)}

    def ints(k: str) -> Column:
        return F.expr(f"cast({x[k]} as bigint)")

    month = "cast(array_position(array({}), lower(left({}, 3))) as bigint)"
    names = ", ".join(f"'{m}'" for m in MONTHS)
    df = df.select(
        *keep,
        F.col(p + "tz"),
        *[ints(k).alias(p + k) for k in ("y", "h", "i", "s", "oh", "om", "ep")],
        F.expr(f"coalesce(cast({x['m']} as bigint), {month.format(names, x['n'])}, case {p}order when 'dmy' then cast({x['b']} as bigint) when 'mdy' then cast({x['a']} as bigint) end)").alias(p + "m"),
        F.expr(f"coalesce(cast({x['d']} as bigint), case {p}order when 'dmy' then cast({x['a']} as bigint) when 'mdy' then cast({x['b']} as bigint) end)").alias(p + "d"),
        F.expr(f"case when {x['a']} is not null then 3 when {x['d']} is not null then 3 when {x['m']} is not null or {x['n']} is not null then 2 when {x['y']} is not null then 1 when {x['ep']} is not null then 0 end").alias(p + "prec"),
        F.expr(f"left(rpad(coalesce({x['f']}, ''), 3, '0'), 3)").alias(p + "ms"),
        F.expr(f"lower({x['ap']})").alias(p + "ap"),
        F.expr(f"if({x['sg']} = '-', -1, 1)").alias(p + "sg"),
        F.expr(f"upper({x['ab']})").alias(p + "ab"),
        F.expr(x["zn"]).alias(p + "zn"),
        F.expr(f"array_position(array({', '.join(f"'{w}'" for w in WEEKDAYS)}), lower({x['dow']}))").alias(p + "dow"),
    )
    c = {k: p + k for k in ("y", "m", "d", "h", "i", "s", "oh", "om", "ep", "prec", "ap", "sg", "ab", "zn", "dow", "tz", "ms")}
    leap = f"({c['y']} % 4 = 0 and ({c['y']} % 100 <> 0 or {c['y']} % 400 = 0))"
    length = f"(case when {c['m']} in (4, 6, 9, 11) then 30 when {c['m']} = 2 then if({leap}, 29, 28) else 31 end)"
    known = _known_zones(spark)
    df = df.withColumns({
        p + "day": F.expr(f"case when {c['prec']} = 3 and {c['y']} between 1 and 9999 and {c['m']} between 1 and 12 and {c['d']} between 1 and {length} then {_days(c['y'], c['m'], c['d'])} end"),
        p + "hh": F.expr(f"case when {c['ap']} is null then {c['h']} when {c['h']} between 1 and 12 then {c['h']} % 12 + if({c['ap']} = 'pm', 12, 0) else 99 end"),
        p + "off": F.expr(f"case when {c['oh']} is not null then if({c['oh']} * 60 + coalesce({c['om']}, 0) <= 840 and coalesce({c['om']}, 0) < 60, {c['sg']} * ({c['oh']} * 3600 + coalesce({c['om']}, 0) * 60), null) when {c['ab']} is not null then 60 * {_case(ABBREVIATIONS, c['ab'])} end"),
        p + "zone": F.when(F.coalesce(F.col(c["zn"]), F.col(c["tz"])).isin(known), F.coalesce(F.col(c["zn"]), F.col(c["tz"]))),
    })
    df = df.withColumn(
        p + "wall",
        F.expr(f"case when {p}day is not null and {p}hh between 0 and 23 and {c['i']} between 0 and 59 and coalesce({c['s']}, 0) between 0 and 59 then {p}day * 86400L + {p}hh * 3600 + {c['i']} * 60 + coalesce({c['s']}, 0) end"),
    )

    def offset(at: str) -> str:
        return f"(unix_seconds(from_utc_timestamp(timestamp_seconds({at}), {p}zone)) - ({at}))"

    # A wall-clock time is one instant if exactly one of the offsets on either side of it leads back to it.
    df = df.withColumns({p + "o1": F.expr(offset(f"{p}wall - 86400")), p + "o2": F.expr(offset(f"{p}wall + 86400"))})
    df = df.withColumns({p + "v1": F.expr(f"{offset(f'{p}wall - {p}o1')} = {p}o1"), p + "v2": F.expr(f"{offset(f'{p}wall - {p}o2')} = {p}o2 and {p}o1 <> {p}o2")})
    has_off = f"({c['oh']} is not null or {c['ab']} is not null)"
    df = df.withColumn(
        p + "utc",
        F.expr(f"""case
          when {c['prec']} = 0 then if(length({p}ep) > 10, {p}ep div 1000, {p}ep)
          when {has_off} and {c['zn']} is null then {p}wall - {p}off
          when {has_off} then if({offset(f'{p}wall - {p}off')} = {p}off, {p}wall - {p}off, null)
          when {p}v1 and not {p}v2 then {p}wall - {p}o1
          when {p}v2 and not {p}v1 then {p}wall - {p}o2 end"""),
    )
    date = f"case {c['prec']} when 3 then if({p}day is null, null, cast(date_from_unix_date(cast({p}day as int)) as string)) when 2 then if({c['m']} between 1 and 12 and {c['y']} > 0, concat(lpad({c['y']}, 4, '0'), '-', lpad({c['m']}, 2, '0')), null) when 1 then if({c['y']} > 0, lpad({c['y']}, 4, '0'), null) end"
    days, rest = f"cast(floor({p}utc / 86400D) as int)", f"pmod({p}utc, 86400)"
    ms = f"if({c['prec']} = 0, if({p}ep > 9999999999, lpad({p}ep % 1000, 3, '0'), '000'), {c['ms']})"
    instant = f"case when {p}utc between -62135596800 and 253402300799 then concat(date_from_unix_date({days}), 'T', lpad({rest} div 3600, 2, '0'), ':', lpad({rest} % 3600 div 60, 2, '0'), ':', lpad({rest} % 60, 2, '0'), '.', {ms}, 'Z') end"
    form = f"""case when {quoted(value)} is null then null
      when {p}dow > 0 and pmod({p}day + 3, 7) + 1 <> {p}dow then '{UNDETERMINED}'
      when {quoted(date_only)} then coalesce(case when {c['prec']} = 0 then left({instant}, 10) else {date} end, '{UNDETERMINED}')
      when {c['h']} is null and {c['prec']} > 0 then coalesce({date}, '{UNDETERMINED}')
      else coalesce({instant}, '{UNDETERMINED}') end"""
    # A generator of one row: a filter on the result must not be pushed down into (and multiply) the steps above.
    return df.select(*keep, F.explode(F.array(F.expr(form))).alias(out))


def quoted(name: str) -> str:
    """A column name quoted for an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def found(bronze: DataFrame, observation: DataFrame, specimen: DataFrame, patient: DataFrame, sources: DataFrame) -> DataFrame:
    """Every non-null value of the four time fields that isn't its own normal form."""

    def field(df: DataFrame, name: str, key: Column, value: str, source: str, date_only: bool) -> DataFrame:
        return df.select(F.lit(name).alias("source_table"), key.cast("string").alias("row_id"), F.col(value).alias("value"), F.col(source).alias("source"), F.lit(date_only).alias("date_only"))

    rows = [
        field(bronze, "bronze", F.col("_commit_version"), "last_updated", "_ingest_source", False),
        field(observation, "observation", F.col("silver_id"), "effectiveInstant", "meta.source", False),
        field(specimen, "specimen", F.col("silver_id"), "collection.collectedDateTime", "meta.source", False),
        field(patient, "patient", F.col("silver_id"), "birthDate", "meta.source", True),
    ]
    all_rows = rows[0]
    for r in rows[1:]:
        all_rows = all_rows.unionByName(r)
    done = normal_form(all_rows.where(F.col("value").isNotNull()), "value", "source", "date_only", sources)
    return done.where(F.col("value") != F.col("normal_form")).select("source_table", "row_id", "normal_form")
