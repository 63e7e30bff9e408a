"""Inner joins with one row per key that no hot key makes uneven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than this part (1 in so many) of all rows are joined by broadcast.
HOT = 1000


def join_hot(rows: DataFrame, by_key: DataFrame, keys: str | list[str], n_rows: str, how_many: int = HOT) -> DataFrame:
    """Inner join of ``rows`` and ``by_key`` (one row per key) on ``keys``.

    ``n_rows`` names the column of ``by_key`` with the number of rows of its key. Keys with more
    than one in ``how_many`` of all those rows are fewer than ``how_many`` by this definition and are
    broadcast; the rest is shuffled, no key with more than that share.
    """
    on = [keys] if isinstance(keys, str) else list(keys)
    total = by_key.agg(F.sum(n_rows)).first()[0] or 0
    is_hot = F.col(n_rows) * how_many > F.lit(total)
    hot = F.broadcast(by_key.where(is_hot))
    rest = rows.join(hot.select(*on), on, "left_anti").join(by_key.where(~is_hot), on)
    return rows.join(hot, on).select(rest.columns).union(rest)
