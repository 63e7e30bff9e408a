"""Keep one row per key (inventory W1, W2, C15).

``row_number() == 1`` over a key window is what Catalyst recognises as a
group limit: the physical plan gets a *partial* ``WindowGroupLimit`` before
the shuffle, so each map task sends at most one row per key. A key holding a
third of all rows therefore costs one row per map task on the wire, not a
third of the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RN = "__rn"


def _asc(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_first()


def first_per_key_flag(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (),
                       ties: Sequence[str] | None = None) -> DataFrame:
    """Add the row number column ``__rn``; callers filter ``__rn == 1``.

    ``order`` is the business order (e.g. oldest date first, NULL first as
    the reference's ascending sort). ``ties`` closes the order so reruns and
    other engines pick the same row; by default every other column,
    ascending with NULL first.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *[_asc(c) for c in ties])
    return df.withColumn(RN, F.row_number().over(w))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (),
               ties: Sequence[str] | None = None, drop_null_keys: bool = True) -> DataFrame:
    """W1/W2 (+C15): one row per key, the first by ``order`` then ``ties``.

    Rows with a NULL key are removed first (C15): it does not change the
    result, and it spares the one huge NULL-key partition.
    """
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.filter(cond)
    flagged = first_per_key_flag(df, keys, order, ties)
    return flagged.filter(F.col(RN) == 1).drop(RN)
