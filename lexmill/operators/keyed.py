"""Joins whose keys may be very uneven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this part of all rows is hot; so there are fewer hot keys than this.
HOT_PARTS = 1000


def lookup(rows: DataFrame, values: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``values``, which has each key at most once; ``how`` is inner or left.

    ``weight`` is a column of ``values``, left out of the result: how many of the ``total`` rows have
    the key. Hot keys, fewer than ``HOT_PARTS``, are broadcast and their rows stay where they are;
    the others are shuffled, and none of them makes a large partition.
    """
    is_hot = F.col(weight) * HOT_PARTS > total
    hot, rest = F.broadcast(values.where(is_hot).drop(weight)), values.where(~is_hot).drop(weight)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key, how))
