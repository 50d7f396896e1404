"""Table schemas, column contracts and id coercion."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

MESSAGE = T.StructType([
    T.StructField("tweet_id", T.LongType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("inbound", T.BooleanType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("response_tweet_id", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.LongType()),
])

# The raw file may spell ids as "12.0" and flags as "True" or "1", so it is read as text first.
RAW_MESSAGE = T.StructType([T.StructField(f.name, T.StringType()) for f in MESSAGE.fields])

TURN = T.StructType([
    T.StructField("tweet_id", T.LongType()),
    T.StructField("speaker", T.StringType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("parent_id", T.LongType()),
])

THREAD = T.StructType([
    T.StructField("brand", T.StringType()),
    T.StructField("support_tweet_id", T.LongType()),
    T.StructField("num_messages", T.IntegerType()),
    T.StructField("conversation", T.ArrayType(TURN)),
])

AGENT_EVALUATION_COLUMNS = ("example_id", "query", "response")
RETRIEVAL_EVALUATION_COLUMNS = (
    "query", "rank", "historical_customer", "historical_support",
    "similarity", "intent_compatibility", "combined_score",
)


def require_columns(df: DataFrame, required: Iterable[str], table: str) -> DataFrame:
    """Raise before any job runs when ``df`` lacks a required column."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns in {table}: {', '.join(missing)}")
    return df


def to_long_id(value: Column) -> Column:
    """Numeric text to BIGINT, exact above 2^53; ``"12.0"`` is 12 and anything else is null."""
    return F.regexp_replace(F.trim(value.cast("string")), r"\.0+$", "").try_cast("bigint")


def to_flag(value: Column, null_as_false: bool = False) -> Column:
    """``true``/``1`` in any case is true, other values are false; null stays null unless asked."""
    flag = F.lower(F.trim(value.cast("string"))).isin("true", "1")
    return F.coalesce(flag, F.lit(False)) if null_as_false else flag
