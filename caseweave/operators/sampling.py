"""First-n, seeded samples and de-duplication. All rank filters keep at most n rows per group before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from caseweave.functions.text import seeded_order

Keys = Sequence[str | Column]


def first_n_per_group(df: DataFrame, group: Sequence[str], order: Keys, n: int) -> DataFrame:
    """The first ``n`` rows of each group; ``order`` must end in a unique key."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def sample_per_group(df: DataFrame, group: Sequence[str], id_column: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random ``n`` rows of each group, or the whole group when it is smaller."""
    return first_n_per_group(df, group, [seeded_order(seed, F.col(id_column)), id_column], n)


def sample_rows(df: DataFrame, id_column: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random ``n`` rows overall."""
    return df.orderBy(seeded_order(seed, F.col(id_column)), id_column).limit(n)


def keep_first(df: DataFrame, keys: Sequence[str], order: Keys) -> DataFrame:
    """One row per key: the first in ``order``."""
    return first_n_per_group(df, keys, order, 1)


def unique_texts(df: DataFrame, text: str, id_column: str) -> DataFrame:
    """Rows with distinct texts; the smallest id survives."""
    return keep_first(df, [text], [id_column])
