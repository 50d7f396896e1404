"""Exact top-k similarity of all queries with all cases.

Both sides are cut into blocks by a hash of the row id, and a block is packed into one row. The product of the two tables of
blocks pairs them: a task holds one block of either side, goes on to the next case block of its part and keeps k rows per
query. So a vector is shuffled once, whatever the number of blocks on the other side; besides, only k rows per query and part
of the cases are shuffled, and there are no more parts than give every core ``TASKS`` tasks. The scores are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from caseweave.operators import blocks
from caseweave.session import cut_lineage

CASE_ENTRIES = 2_000_000  # vector entries per case block
QUERY_ENTRIES = 1_000_000  # vector entries per query block
QUERY_ROWS = 8_192
CASE_ROWS = 65_536
TASKS = 8  # tasks per core, as far as there are blocks for them
SMALL_PRODUCT = 100_000_000  # pairs


def _block_count(vectors: DataFrame, entries: int, rows: int, id_column: str) -> tuple[int, int]:
    """How many blocks keep the expected entries and rows per block below the bounds, and the row count."""
    size = vectors.agg(F.count(id_column).alias("n"), F.coalesce(F.sum(F.size("indices")), F.lit(0)).alias("m")).first()
    return max(1, -(-size["m"] // entries), -(-size["n"] // rows)), size["n"]


def _block_of(id_column: str, count: int) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(count)).cast("int")


def _packed(vectors: DataFrame, id_column: str, count: int, pack: Callable, schema: str, parts: int) -> DataFrame:
    """One row per block, dealt to ``parts`` partitions."""
    blocked = vectors.withColumn("_block", _block_of(id_column, count)).repartition(count, "_block")
    packed = blocked.groupBy("_block").applyInArrow(pack, schema)
    return packed.repartitionById(parts, F.col(packed.columns[0]) % parts)


def top_k(
    queries: DataFrame,
    cases: DataFrame,
    k: int,
    similarity_weight: float = 1.0,
    compatibility_weight: float = 0.0,
) -> DataFrame:
    """The ``k`` best cases per query with ranks 1..k, by combined score and then by the smaller case id.

    ``queries`` is (query_id, indices, weights[, intent_index]) and ``cases`` is (case_id, indices, weights
    [, compatibility]); ``compatibility`` is one score per intent and ``intent_index`` points into it, -1 for none.
    Every query gets k rows as long as there are k cases, also at similarity 0.
    """
    if "intent_index" not in queries.columns:
        queries = queries.withColumn("intent_index", F.lit(-1))
    if "compatibility" not in cases.columns:
        cases = cases.withColumn("compatibility", F.array().cast("array<double>"))
    queries = cut_lineage(queries.select("query_id", "indices", "weights", "intent_index"))
    cases = cut_lineage(cases.select("case_id", "indices", "weights", "compatibility"))
    return search_blocks(queries, cases, k, similarity_weight, compatibility_weight)


def search_blocks(
    queries: DataFrame, cases: DataFrame, k: int, similarity_weight: float, compatibility_weight: float
) -> DataFrame:
    """:func:`top_k` of stored tables (query_id, indices, weights, intent_index), (case_id, indices, weights, compatibility)."""
    query_blocks, n_queries = _block_count(queries, QUERY_ENTRIES, QUERY_ROWS, "query_id")
    case_blocks, n_cases = _block_count(cases, CASE_ENTRIES, CASE_ROWS, "case_id")
    cores = queries.sparkSession.sparkContext.defaultParallelism
    if n_queries * n_cases <= SMALL_PRODUCT:  # so few blocks still use all cores
        case_blocks = max(case_blocks, min(-(-cores // query_blocks), -(-n_cases // 64), cores))
    parts = min(case_blocks, -(-TASKS * cores // query_blocks))
    # The right side's partition, one block, is held by its task; the left side's rows pass one after the other.
    scored = _packed(cases, "case_id", case_blocks, blocks.pack_cases, blocks.PACKED_CASES, parts).crossJoin(
        _packed(queries, "query_id", query_blocks, blocks.pack_queries, blocks.PACKED_QUERIES, query_blocks).hint("shuffle_replicate_nl")
    ).mapInArrow(blocks.top_k_of_blocks(k, similarity_weight, compatibility_weight), blocks.RESULT)
    best_first = Window.partitionBy("query_id").orderBy(F.desc(F.round("combined_score", blocks.DECIMALS)), "case_id")
    ranked = scored.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select(
        "query_id", "rank", "case_id", "similarity", "intent_compatibility", "combined_score"
    )


def exact_median(df: DataFrame, value: str, steps: int = 10_000) -> DataFrame:
    """One row ``median`` of a score in [0, 1], without a sort or a list of all values in one task.

    Equal values are folded first; the value steps that hold the two middle ranks are found from at most
    ``steps`` + 1 counts, and only those steps are sorted.
    """
    folded = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    folded = folded.withColumn("step", F.floor(F.col("v") * steps))
    sizes = folded.groupBy("step").agg(F.sum("n").alias("size"))
    up_to = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marks = sizes.select(
        "step",
        (F.sum("size").over(up_to) - F.col("size")).alias("before"),
        F.sum("size").over(everything).alias("total"),
        "size",
    )
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    middle = marks.where(
        ((F.col("before") < low) & (low <= F.col("before") + F.col("size")))
        | ((F.col("before") < high) & (high <= F.col("before") + F.col("size")))
    )
    inside = Window.partitionBy("step").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = folded.join(F.broadcast(middle), "step").withColumn(
        "last", F.col("before") + F.sum("n").over(inside)
    ).withColumn("first", F.col("last") - F.col("n") + 1)
    at_low = F.max(F.when((F.col("first") <= low) & (low <= F.col("last")), F.col("v")))
    at_high = F.max(F.when((F.col("first") <= high) & (high <= F.col("last")), F.col("v")))
    return placed.agg(((at_low + at_high) / 2).alias("median"))


def similarity_statistics(ranked: DataFrame, thresholds: tuple[float, ...] = (0.2, 0.3, 0.4, 0.5, 0.6)) -> DataFrame:
    """(metric, value): mean and median of the top-1 and best-of-k similarity, and the share above each threshold."""
    top1 = ranked.where("rank = 1").select("similarity")
    best = ranked.groupBy("query_id").agg(F.max("similarity").alias("similarity"))
    shares = [
        F.avg((F.round("similarity", blocks.DECIMALS) >= t).cast("double")).alias(f"best_at_least_{round(t * 100)}_percent")
        for t in thresholds
    ]
    means = [
        top1.agg(F.count(F.lit(1)).cast("double").alias("queries"), F.avg("similarity").alias("mean_top1")),
        exact_median(top1, "similarity").withColumnRenamed("median", "median_top1"),
        best.agg(F.avg("similarity").alias("mean_best"), *shares),
        exact_median(best, "similarity").withColumnRenamed("median", "median_best"),
    ]
    long = [m.unpivot([], m.columns, "metric", "value") for m in means]
    result = long[0]
    for part in long[1:]:
        result = result.unionByName(part)
    return result
