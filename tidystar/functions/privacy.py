"""Personal-data protection as column expressions (inventory X1, X2).

Both are narrow projections evaluated where the data lives: nothing is pulled
to the driver and no row-by-row update is issued.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's for the same results) ---------
MASK_PREFIX = "****"
MASK_MISSING = "****0000"
MASK_KEEP = 4  # characters kept at the end of a masked value
# The word treated as missing, compared after upper-casing.
MISSING_WORD = "NULL"
# -----------------------------------------------------------------------------

# Python's str.strip() removes every character for which str.isspace() is
# true; the set is derived from that rule (all such characters are below
# U+3001).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Trim white space as Python's ``str.strip()`` does."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def hash_column(c: Column | str, salt: str | None = None) -> Column:
    """SHA-256 (lower-case hex) of the stripped, lower-cased value.

    NULL, blank and the exact word NULL in any case (not stripped) are kept
    as they are. ``salt`` is an optional prefix; the default is the plain
    digest, like the reference.
    """
    c = _col(c)
    keep = c.isNull() | (py_strip(c) == F.lit("")) | (F.upper(c) == F.lit(MISSING_WORD))
    value = F.lower(py_strip(c))
    if salt:
        value = F.concat(F.lit(salt), value)
    return F.when(keep, c).otherwise(F.sha2(value, 256))


def mask_column(c: Column | str) -> Column:
    """``****`` + the last four characters; missing values give ``****0000``.

    Missing is NULL, or blank or the word NULL after stripping. A value of
    four characters or fewer is kept whole after the prefix.
    """
    c = _col(c)
    t = py_strip(c)
    missing = c.isNull() | (t == F.lit("")) | (F.upper(t) == F.lit(MISSING_WORD))
    return F.when(missing, F.lit(MASK_MISSING)).otherwise(
        F.concat(F.lit(MASK_PREFIX), F.right(t, F.lit(MASK_KEEP))))
