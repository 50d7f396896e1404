"""Looking a value up by a key that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FREQUENT = 100_000  # the most keys that are broadcast


def looked_up(rows: DataFrame, values: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` joined to the one row that ``values`` has for each ``key``; ``count`` says how many rows have the key.

    Of ``total`` rows at most ``FREQUENT`` keys can have more than total / FREQUENT: these are broadcast and their rows
    stay where they are. All other rows are shuffled, and no key brings more than that many to a task.
    """
    limit = total // FREQUENT
    frequent = values.where(F.col(count) > limit).drop(count)
    rare = values.where(F.col(count) <= limit).drop(count)
    others = rows.join(F.broadcast(frequent.select(key)), key, "left_anti")
    return rows.join(F.broadcast(frequent), key).unionByName(others.join(rare, key))
