"""Cleaning rules as reusable column expressions (inventory C1-C14, C20).

Every rule takes columns and limits as arguments and returns a ``Column``;
none knows about customers or orders. All are built-in Spark expressions, so
they run inside whole-stage codegen and scale with the scan: no UDF, no
shuffle. ANSI mode is on by default in Spark 4, so every cast here is a
``try_cast`` behind a pattern guard and every division goes through
``nullif``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's for the same results) ---------
# Default label for a missing or unusable text value.
DEFAULT_LABEL = "NO DETERMINADO"
# Words treated as "missing" by the label rule, compared after upper-casing.
MISSING_WORDS = ("", "NULL")
# Two-value flag: these words (upper-cased) mean active; all else inactive.
ACTIVE_WORDS = ("1", "TRUE", "ACTIVO", "YES")
ACTIVE_LABEL = "ACTIVO"
INACTIVE_LABEL = "INACTIVO"
# Supplier pattern: the word PROVEEDOR, one space, one letter A-Z.
SUPPLIER_PATTERN = r"^PROVEEDOR [A-Z]\z"
# -----------------------------------------------------------------------------

# Text accepted as an integer or a plain decimal number. Exponent forms such as
# ``1e3`` and thousands separators are rejected on purpose (note N3).
# ``\z`` is the very end; ``$`` would also admit a final line break.
INT_PATTERN = r"^ *[+-]?[0-9]+ *\z"
DECIMAL_PATTERN = r"^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+) *\z"

# Date text forms of ``safe_timestamp`` (after quotes are dropped and ``/`` became
# ``-``): pattern, and the same date as ``y-M-d``. They never overlap.
DATE_FORMS = (
    (r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", "$1-$2-$3"),
    (r"([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3"),
    (r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})", "$3-$1-$2"),
    (r"([0-9]{1,2})-([0-9]{1,2})-([0-4][0-9])", "20$3-$1-$2"),
    (r"([0-9]{1,2})-([0-9]{1,2})-([5-9][0-9])", "19$3-$1-$2"),
)
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
# Time of day after a date: minutes, or seconds with up to three fraction digits;
# ``T`` in place of the blank needs the seconds.
TIME_PATTERN = r"(?: +[0-9]{1,2}:[0-9]{1,2}|[T ] *[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(?:\.[0-9]{1,3})?)"
# Earliest year of the reference's DATETIME type.
MIN_YEAR = 1753


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: Column | str) -> Column:
    """Delete every double quote."""
    return F.replace(_col(c), F.lit('"'), F.lit(""))


def clean_text(c: Column | str, upper: bool = True) -> Column:
    """Drop quotes, trim spaces, optionally upper-case."""
    t = F.trim(strip_quotes(c))
    return F.upper(t) if upper else t


def _int_or_null(s: Column, type_name: str = "int") -> Column:
    # the guard admits only spaces around the digits, which the cast ignores
    return F.when(s.rlike(INT_PATTERN), s.try_cast(type_name))


def key_int(c: Column | str, type_name: str = "int") -> Column:
    """Drop quotes and every space (``1 2`` -> 12), then INT (or BIGINT) or NULL.

    A blank key gives NULL (note N1), never a made-up key 0; so does one beyond
    the type's range.
    """
    return _int_or_null(F.replace(strip_quotes(c), F.lit(" "), F.lit("")), type_name)


def safe_int(c: Column | str) -> Column:
    """C4: drop quotes, then INT or NULL (``12.5`` and blanks give NULL)."""
    return _int_or_null(strip_quotes(c))


def safe_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Drop quotes, then DECIMAL(p,s) rounded half up, NULL if bad or too large."""
    s = strip_quotes(c)
    return F.when(s.rlike(DECIMAL_PATTERN), s.try_cast(f"decimal({precision},{scale})"))


def safe_timestamp(c: Column | str) -> Column:
    """Drop quotes, ``/`` -> ``-``, then a date with or without a time of day, or NULL.

    Dates: ``yyyy-M-d``, ``yyyyMMdd``, US ``M-d-yyyy`` and ``M-d-yy`` (50 and later:
    19yy), ``Mon d yyyy`` and a bare ``yyyy`` (its first day, no time). Times:
    ``H:m``, ``H:m:s``, ``H:m:s.fff`` after blanks; ``T`` with seconds after a date
    of digits. Not read, and NULL: AM/PM, day-first dates, time zones, more than
    three fraction digits, a time alone.

    The result is zone-free. Impossible dates (30 February) and years before the
    reference's DATETIME range give NULL, and fractions are rounded to that type's
    steps of 1/300 second. Plain ISO text costs one pattern test and one cast.
    """
    s = F.trim(F.replace(strip_quotes(c), F.lit("/"), F.lit("-")))
    plain = r"^[0-9]{4}(?:-[0-9]{1,2}-[0-9]{1,2}(?:[T ][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?)?\z"
    date = None
    for pattern, form in DATE_FORMS:
        whole = f"^{pattern}{TIME_PATTERN}?\\z"
        text = F.regexp_replace(s, whole, form)
        date = F.when(s.rlike(whole), text) if date is None else date.when(s.rlike(whole), text)
    names = "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS)
    named = rf"(?i)^(?:{names}) +([0-9]{{1,2}}),? +([0-9]{{4}})(?: .*)?\z"
    month = F.array_position(F.array(*(F.lit(m[:3]) for m in MONTHS)), F.lower(F.substring(s, 1, 3)))
    date = date.when(s.rlike(named.replace("(?: .*)?", TIME_PATTERN.replace("[T ]", " ") + "?")),
                     F.concat(F.regexp_replace(s, named, "$2-"), month.cast("string"),
                              F.regexp_replace(s, named, "-$1")))
    time = F.regexp_extract(s, r"[T ] *([0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2})?)(?:\.[0-9]{1,3})?\z", 1)
    time = F.when(time == "", "00:00:00").when(time.rlike(r"^[0-9]+:[0-9]+\z"), F.concat(time, F.lit(":00"))).otherwise(time)
    fraction = F.rpad(F.regexp_extract(s, r":[0-9]{1,2}\.([0-9]{1,3})\z", 1), 3, "0").cast("int")
    millis = F.round(F.round(fraction * 3 / 10) * 10 / 3)
    ts = F.concat(date, F.lit(" "), time).try_cast("timestamp_ntz")
    ts = F.when(fraction > 0, ts + F.make_dt_interval(secs=(millis / 1000).cast("decimal(18,6)"))).otherwise(ts)
    ts = F.when(ts >= F.lit(f"{MIN_YEAR}-01-01 00:00:00").cast("timestamp_ntz"), ts)
    # plain text begins with its year: no second cast to compare
    return F.when(s.rlike(plain), F.when(s >= str(MIN_YEAR), s.try_cast("timestamp_ntz"))).otherwise(ts)


def null_outside(x: Column | str, lo, hi) -> Column:
    """NULL when outside [lo, hi]."""
    x = _col(x)
    return F.when(x.between(lo, hi), x)



def floor_zero(x: Column | str, zero=0, type_name: str | None = None) -> Column:
    """Negative or invalid (NULL) becomes zero."""
    x = _col(x)
    z = F.lit(zero).cast(type_name) if type_name else F.lit(zero)
    out = F.greatest(F.coalesce(x, z), z)
    return out.cast(type_name) if type_name else out


def clamp(x: Column | str, lo, hi, type_name: str | None = None) -> Column:
    """Clamp to [lo, hi]; NULL (invalid) becomes ``lo``."""
    x = _col(x)
    lo_c = F.lit(lo).cast(type_name) if type_name else F.lit(lo)
    hi_c = F.lit(hi).cast(type_name) if type_name else F.lit(hi)
    out = F.least(F.greatest(F.coalesce(x, lo_c), lo_c), hi_c)
    return out.cast(type_name) if type_name else out


def label_or_default(c: Column | str, default: str = DEFAULT_LABEL,
                     missing: Sequence[str] = MISSING_WORDS) -> Column:
    """NULL, blank or the word NULL (any case) -> default; else cleaned upper text."""
    t = clean_text(c)
    return F.when(_col(c).isNull() | t.isin(*missing), F.lit(default)).otherwise(t)


def match_or_default(c: Column | str, pattern: str = SUPPLIER_PATTERN,
                     default: str = DEFAULT_LABEL) -> Column:
    """C11: cleaned upper text if it matches the anchored pattern, else default."""
    t = clean_text(c)
    return F.when(t.rlike(pattern), t).otherwise(F.lit(default))


def flag(c: Column | str, true_words: Sequence[str] = ACTIVE_WORDS,
         yes: str = ACTIVE_LABEL, no: str = INACTIVE_LABEL) -> Column:
    """Two-value flag; NULL and unknown words give ``no``."""
    t = clean_text(c)
    return F.when(t.isin(*true_words), F.lit(yes)).otherwise(F.lit(no))


def ratio_if_invalid(q: Column | str, total: Column | str, unit: Column | str) -> Column:
    """Keep a positive quantity; else ``total / unit`` cut to INT (NULL if unit is 0/NULL).

    Decimal division keeps 13 places, so the cut is the exact truncation of
    the quotient; a quotient beyond INT gives NULL.
    """
    q, total, unit = _col(q), _col(total), _col(unit)
    repaired = (total / F.nullif(unit, F.lit(0))).try_cast("int")
    return F.when(q.isNull() | (q <= 0), repaired).otherwise(q)


def null_if_before(later: Column | str, earlier: Column | str) -> Column:
    """C14: NULL when ``later < earlier``; a NULL on either side keeps ``later``."""
    later, earlier = _col(later), _col(earlier)
    return F.when(later < earlier, F.lit(None)).otherwise(later)


def net_amount(total: Column | str, discount_pct: Column | str) -> Column:
    """C20: ``total * (1.00 - discount / 100.00)`` in exact decimals -> DECIMAL(25,10)."""
    one = F.lit(1).cast("decimal(3,2)")
    hundred = F.lit(100).cast("decimal(5,2)")
    return _col(total) * (one - _col(discount_pct) / hundred)
