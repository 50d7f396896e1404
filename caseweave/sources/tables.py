"""Readers of message tables, threads and models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from caseweave import schema
from caseweave.sources import quoted


def read_messages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The raw CSV export as a MESSAGE table.

    Quoted texts may hold line breaks; files are split all the same (``sources/quoted.py``). ``multi_line=False`` is for
    files known to hold one record per line and reads them once instead of twice. Convert to parquet once and read that
    afterwards.
    """
    if multi_line:
        return coerce_messages(quoted.read_csv(spark, path, schema.RAW_MESSAGE))
    raw = spark.read.schema(schema.RAW_MESSAGE).option("header", True).option("escape", '"').csv(path)
    return coerce_messages(raw)


def coerce_messages(raw: DataFrame) -> DataFrame:
    """Ids to BIGINT and the direction to BOOLEAN; what cannot be read becomes null."""
    return raw.select(
        schema.to_long_id(F.col("tweet_id")).alias("tweet_id"),
        F.col("author_id").cast("string").alias("author_id"),
        schema.to_flag(F.col("inbound")).alias("inbound"),
        "created_at",
        "text",
        F.col("response_tweet_id").cast("string").alias("response_tweet_id"),
        schema.to_long_id(F.col("in_response_to_tweet_id")).alias("in_response_to_tweet_id"),
    )


def read_table(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """A whole CSV file with a declared schema; parquet by suffix."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(columns).parquet(path)
    return quoted.read_csv(spark, path, columns)


def decode_conversation(raw: Column) -> Column:
    """A conversation given as a JSON list, or as that list inside a JSON string; anything else is empty.

    ``raw`` is the JSON text of the field as it stands in the record.
    """
    turns = T.ArrayType(schema.TURN)
    inner = F.from_json(F.concat(F.lit('{"v":'), raw, F.lit("}")), "v string")["v"]
    text = F.when(raw.startswith('"'), inner).otherwise(raw)
    return F.coalesce(F.when(F.ltrim(text).startswith("["), F.from_json(text, turns)), F.array().cast(turns))


def read_threads(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """THREAD records from JSON lines; both spellings of ``conversation`` are accepted.

    Blank lines are skipped. Malformed lines are dropped, or fail the job when ``strict``.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    fields = "brand string, support_tweet_id string, num_messages string, conversation string, _bad string"
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    record = F.from_json("value", fields, mode)
    parsed = lines.select(record.alias("r"), F.get_json_object("value", "$.conversation").alias("c"))
    if not strict:
        parsed = parsed.where("r IS NOT NULL AND r._bad IS NULL")
    # get_json_object hands back the content of a JSON string and the JSON text of a list.
    conversation = decode_conversation(F.col("c"))
    return parsed.select(
        F.col("r.brand").alias("brand"),
        schema.to_long_id(F.col("r.support_tweet_id")).alias("support_tweet_id"),
        F.coalesce(F.col("r.num_messages").try_cast("int"), F.size(conversation)).alias("num_messages"),
        conversation.alias("conversation"),
    )
