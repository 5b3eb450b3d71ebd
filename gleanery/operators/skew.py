"""Equi-joins with one row for each key, where some keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that count as hot at most: the bound of what is broadcast.
HOT_KEYS = 100_000
#: A key of fewer rows is never hot.
LEAST_ROWS = 256
#: Rows in all up to which the side with one row for each key is broadcast whole: it has no more rows than these.
FEW_ROWS = 500_000


def join_spread(rows: DataFrame, one: DataFrame, key: str, count: str, total: int, least: int = LEAST_ROWS, hot_keys: int = HOT_KEYS, few: int = FEW_ROWS) -> DataFrame:
    """``rows`` joined (inner) with ``one``, which has one row for each key and in column ``count`` the number of ``rows`` that hold it;
    ``total`` is the number of all rows. Keys of over total / hot_keys rows, so at most ``hot_keys``, are broadcast and their
    rows stay where they lie; the others meet by a shuffle, in which no key has more rows than that. The column ``count`` goes. Rows of ``one`` whose key no row has count as rows of ``total``."""
    if total <= few:
        return rows.join(F.broadcast(one.drop(count)), key)
    bound = max(least, total // hot_keys)
    hot = F.broadcast(one.where(F.col(count) > bound).drop(count))
    rest = one.where(F.col(count) <= bound).drop(count)
    # The join to be shuffled comes without the hot keys' rows, else these would travel to be dropped.
    cool = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cool.join(rest, key))
