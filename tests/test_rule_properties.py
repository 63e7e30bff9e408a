"""Rules against plain-Python models of their semantics, on random awkward text."""

import datetime as dt
import hashlib
import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidystar.functions import privacy as P
from tidystar.functions import rules as R

PIECES = st.sampled_from(["0", "7", "12", "+", "-", ".", " ", '"', "e", "a", "N", "NULL",
                          "null", "\t", "\n", "99999", "3000000000", ",", "x"])
TEXT = st.one_of(st.none(), st.lists(PIECES, max_size=6).map("".join))


def m_int(t):
    if not re.fullmatch(r" *[+-]?[0-9]+ *", t):
        return None
    v = int(t.strip(" "))
    return v if -2**31 <= v < 2**31 else None


def m_key_int(s):
    return None if s is None else m_int(s.replace('"', "").replace(" ", ""))


def m_safe_int(s):
    return None if s is None else m_int(s.replace('"', ""))


def m_safe_decimal(s):
    if s is None:
        return None
    t = s.replace('"', "")
    if not re.fullmatch(r" *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+) *", t):
        return None
    d = Decimal(t.strip(" ")).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return d if abs(d) < Decimal(10) ** 8 else None


def m_label(s):
    if s is None:
        return "NO DETERMINADO"
    t = s.replace('"', "").strip(" ").upper()
    return "NO DETERMINADO" if t in ("", "NULL") else t


def m_mask(s):
    t = None if s is None else s.strip()
    if s is None or t == "" or t.upper() == "NULL":
        return "****0000"
    return "****" + t[-4:]


def m_hash(s):
    if s is None or s.strip() == "" or s.upper() == "NULL":
        return s
    return hashlib.sha256(s.strip().lower().encode("utf-8")).hexdigest()


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=50, max_size=200))
def test_rules_match_python_models(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", R.key_int("v").alias("key"), R.safe_int("v").alias("int"),
                     R.safe_decimal("v").alias("dec"), R.label_or_default("v").alias("label"),
                     P.mask_column("v").alias("mask"), P.hash_column("v").alias("hash")
                     ).orderBy("i").collect()
    for r, v in zip(rows, values):
        assert r.key == m_key_int(v), v
        assert r.int == m_safe_int(v), v
        assert r.dec == m_safe_decimal(v), v
        assert r.label == m_label(v), v
        assert r.mask == m_mask(v), v
        assert r.hash == m_hash(v), v


MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december"]


def m_timestamp(s):
    """Date text read piece by piece, with fractions in steps of 1/300 second."""
    if s is None:
        return None
    t = s.replace('"', "").replace("/", "-").strip(" ")
    clock = re.search(r"([ T]) *([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:\.([0-9]{1,3}))?)?\Z", t)
    day, time, millis = t, (0, 0, 0), 0
    if clock:
        if clock[1] == "T" and not clock[4]:
            return None
        day = t[:clock.start()].rstrip(" ") if clock[1] == " " else t[:clock.start()]
        time = (int(clock[2]), int(clock[3]), int(clock[4] or 0))
        ticks = int(Decimal((clock[5] or "0").ljust(3, "0")) * 3 / 10 + Decimal("0.5"))
        millis = int(Decimal(ticks) * 10 / 3 + Decimal("0.5"))
    if m := re.fullmatch(r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", day):
        y, mo, d = m.groups()
    elif m := re.fullmatch(r"([0-9]{4})([0-9]{2})([0-9]{2})", day):
        y, mo, d = m.groups()
    elif m := re.fullmatch(r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4}|[0-9]{2})", day):
        mo, d, y = m.groups()
        y = y if len(y) == 4 else ("20" if y < "50" else "19") + y
    elif (m := re.fullmatch(r"([A-Za-z]+) +([0-9]{1,2}),? +([0-9]{4})", day)) and not (clock and clock[1] == "T"):
        names = [i for i, n in enumerate(MONTHS) if m[1].lower() in (n, n[:3])]
        if not names:
            return None
        y, mo, d = m[3], names[0] + 1, m[2]
    elif re.fullmatch("[0-9]{4}", day) and not clock:
        y, mo, d = day, 1, 1
    else:
        return None
    try:
        v = dt.datetime(int(y), int(mo), int(d), *time) + dt.timedelta(milliseconds=millis)
    except (ValueError, OverflowError):
        return None
    return v if v.year >= 1753 else None


DATE_PIECES = st.sampled_from(["2023", "1700", "0001", "1", "02", "12", "13", "29", "30", "31",
                               "-", "/", " ", "T", ":", '"', "20230105", "8", "59", "60", "\n", ".", ".12", "23",
                               "75", "Jan ", "march 5, 2020", " 08:30", " 10:20:30", "2023-01-05", "1/15/2023", "T08:30:00"])
DATE_TEXT = st.one_of(st.none(), st.lists(DATE_PIECES, max_size=9).map("".join))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DATE_TEXT, min_size=50, max_size=200))
def test_safe_timestamp_matches_python_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", R.safe_timestamp("v").alias("ts")).orderBy("i").collect()
    for r, v in zip(rows, values):
        assert r.ts == m_timestamp(v), v
