"""Small relational steps shared by the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from caseweave.functions import text as tx
from caseweave.schema import to_flag
from caseweave.session import cut_lineage


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in that order; absent ones are ignored."""
    return df.select(*[c for c in columns if c in df.columns])


def place_after(df: DataFrame, column: str, anchor: str) -> DataFrame:
    """Move ``column`` right behind ``anchor``."""
    rest = [c for c in df.columns if c != column]
    at = rest.index(anchor) + 1
    return df.select(*rest[:at], column, *rest[at:])


def add_constants(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Add text columns with a fixed value, such as blank annotation columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def dense_row_id(df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """Number the rows 1..n in the order of ``order`` (a unique key) without a single-task sort.

    Rows are range-partitioned, sorted and written once together with their place in the partition, so that the
    partition sizes and the row numbers come from the same layout; only one size per partition travels on.
    """
    session = df.sparkSession
    n = partitions or max(
        session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))
    )
    place = F.monotonically_increasing_id()  # the partition's number in the upper 31 bits, the row's in the lower 33
    sorted_parts = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = cut_lineage(sorted_parts.withColumn("_place", place)).withColumns({
        "_part": F.shiftright("_place", 33), "_row": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1,
    })
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), "_part")  # at most n rows
        .select((F.col("_offset") + F.col("_row")).alias(name), *df.columns)
    )


def support_of(messages: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Support messages written by the listed brands."""
    return messages.where(~F.col("inbound") & F.col("author_id").isin(*brands))


def customers_of(messages: DataFrame) -> DataFrame:
    """Inbound messages; an unknown direction is not a customer."""
    return messages.where(to_flag(F.col("inbound"), null_as_false=True))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(~tx.is_blank(F.col(column)))


def of_brand(records: DataFrame, brand: str) -> DataFrame:
    """Records of one brand, compared without case; a missing brand never matches."""
    return records.where(F.lower(F.coalesce("brand", F.lit(""))) == brand.lower())


def frequent_classes(df: DataFrame, label: str, at_least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Rows of classes with enough examples, and the excluded classes with their counts."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("examples"))
    rare = sizes.where(F.col("examples") < at_least)
    return df.where(F.col(label).isNotNull()).join(rare, label, "left_anti"), rare


def validate_requests(requests: DataFrame, top_k: int = 3) -> tuple[DataFrame, DataFrame]:
    """Split triage requests into accepted and rejected ones; ``top_k`` must be 1 to 10."""
    if not 1 <= top_k <= 10:
        raise ValueError("top_k must be between 1 and 10")
    accepted = F.coalesce(F.length("message") >= 1, F.lit(False))
    return requests.where(accepted), requests.where(~accepted)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"No {what} remain.")
    return df


def top_rows(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows of a report; ``order`` must end in a unique key."""
    return df.orderBy(*order).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, null included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def majority_value(df: DataFrame, column: str) -> DataFrame:
    """The most frequent non-null value; the smallest wins a tie."""
    counts = value_counts(df.where(F.col(column).isNotNull()), column)
    return counts.orderBy(F.desc("n"), column).limit(1)
