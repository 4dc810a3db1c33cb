"""Joins of facts to one row per key, where a key may hold a large share of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.runtime import materialised

HOT_KEYS = 1000


def join_per_key(facts: DataFrame, per_key: DataFrame, key: str, rows: str, how: str = "left") -> DataFrame:
    """Join facts to a table with one row per key and its fact count in ``rows``.

    Keys with more than 1/``HOT_KEYS`` of all counted facts are joined by broadcast and never shuffled;
    there are fewer than ``HOT_KEYS`` of them whatever the data. All other keys take a shuffle join.
    The table per key is written once, as both parts and the total read it.
    """
    per_key = materialised(per_key)
    total = per_key.agg(F.sum(rows)).scalar()
    hot = F.col(rows) * HOT_KEYS > total
    hot_rows = per_key.filter(hot)
    hot_names = F.broadcast(hot_rows.select(key))
    split = facts.join(F.broadcast(hot_rows.drop(rows)), key)
    rest = facts.join(hot_names, key, "left_anti").join(per_key.filter(~hot).drop(rows), key, how)
    return split.unionByName(rest)
