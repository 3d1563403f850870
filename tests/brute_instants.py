"""Plain row-by-row reading of time notations, for comparison with the JVM operator."""

import re
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

ABBR = {"Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 1, "CET": 1, "CEST": 2, "EET": 2, "EEST": 3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "AEST": 10, "AEDT": 11, "IST": 5.5}
MON = "jan feb mar apr may jun jul aug sep oct nov dec".split()
BAD = "undetermined"


def local(dt, zone):
    zi = ZoneInfo(zone)
    hits = set()
    for fold in (0, 1):
        u = dt.replace(tzinfo=zi, fold=fold).astimezone(timezone.utc)
        if u.astimezone(zi).replace(tzinfo=None) == dt:
            hits.add(u)
    return hits.pop() if len(hits) == 1 else None


def brute(v, source, birth, zones):
    tz, order = zones.get(source, (None, None))
    s = v.strip()
    if re.fullmatch(r"\d{10}|\d{13}", s):
        ms = int(s) if len(s) == 13 else int(s) * 1000
        u = datetime(1970, 1, 1) + timedelta(milliseconds=ms)
        return u.strftime("%Y-%m-%d") if birth else u.strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z"
    try:
        if re.fullmatch(r"\d{4}", s):
            return s if int(s) else BAD
        for pat in (r"(?P<y>\d{4})[-/](?P<m>\d\d)", r"(?P<m>\d\d?)[-/.](?P<y>\d{4})"):
            if m := re.fullmatch(pat, s):
                return f"{date(int(m['y']), int(m['m']), 1):%Y-%m}"
        m = re.match(r"(?P<y>\d{4})(?P<sep>[-/])(?P<m>\d\d)(?P=sep)(?P<d>\d\d)", s) or re.match(r"(?P<y>\d{4})(?P<m>\d\d)(?P<d>\d\d)(?!\d)", s)
        if m:
            d = date(int(m["y"]), int(m["m"]), int(m["d"]))
        elif m := re.match(r"(?:\w{3}, )?(\d\d?) (\w{3}) (\d{4})", s):
            d = date(int(m[3]), MON.index(m[2].lower()) + 1, int(m[1]))
        elif m := re.match(r"(\w{3}) (\d\d?), (\d{4})", s):
            d = date(int(m[3]), MON.index(m[1].lower()) + 1, int(m[2]))
        elif m := re.match(r"(\d\d?)([./-])(\d\d?)\2(\d{4})", s):
            if order is None:
                return BAD
            a, b = int(m[1]), int(m[3])
            d = date(int(m[4]), *((b, a) if order == "dmy" else (a, b)))
        else:
            return BAD
        rest = s[m.end():]
        if not rest:
            return d.isoformat()
        t = re.fullmatch(r"[Tt ](\d\d?):?(\d\d)(?::?(\d\d)(?:[.,](\d+))?)?( [AP]M)?(?: ?([+-]\d\d:?\d\d|[A-Za-z]+))?(\[.*\])?", rest)
        if not t:
            return BAD
        if birth:
            return d.isoformat()
        h = int(t[1])
        if t[5]:
            if not 1 <= h <= 12:
                return BAD
            h = h % 12 + 12 * (t[5] == " PM")
        dt = datetime(d.year, d.month, d.day, h, int(t[2]), int(t[3] or 0), int((t[4] or "0").ljust(6, "0")[:3]) * 1000)
        if z := t[6]:
            if z[0] in "+-":
                off = int(z[1:3]) * 60 + int(z[-2:])
                off = -off if z[0] == "-" else off
            else:
                off = ABBR[z.upper()] * 60
            u = dt - timedelta(minutes=off)
        elif tz:
            u = local(dt, tz)
            if u is None:
                return BAD
        else:
            return BAD
        return u.strftime("%Y-%m-%dT%H:%M:%S.") + f"{u.microsecond // 1000:03d}Z"
    except (ValueError, KeyError):
        return BAD
