"""The supplied parquet tables, and the turn table seen as a message table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseweave.session import spread

# Ids of a message table made from (conv_id, turn): room for a billion turns per conversation.
TURN_SPACE = 1_000_000_000
BRANDS = 6


KEYS = {"conversations": ("conv_id", "turn"), "documents": ("doc_id",), "pages": ("page_id",)}


def table(spark: SparkSession, folder: str, name: str, text_work: bool = False) -> DataFrame:
    """One table; ``text_work`` spreads a small file over all cores by its unique key."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df, *KEYS[name]) if text_work else df


def messages(spark: SparkSession, folder: str, children: bool = False) -> DataFrame:
    """``conversations`` as a MESSAGE table: users write to one of six brands, each turn answers the one before.

    Creation times are derived from the id: an hour per conversation, a minute per turn. ``children`` adds
    ``response_tweet_id``; the next turn is looked up by its id, so a long conversation needs no window over all
    its turns, but the join costs a shuffle that the other queries can do without.
    """
    turns = table(spark, folder, "conversations")
    tweet_id = F.col("conv_id") * TURN_SPACE + F.col("turn")
    minutes = F.col("conv_id") % 1_000_000 * 60 + F.col("turn") % 60
    moment = F.lit("2017-11-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))
    base = turns.select(
        tweet_id.alias("tweet_id"),
        F.when(F.col("role") == "user", F.concat(F.lit("u"), F.col("conv_id").cast("string")))
        .otherwise(F.concat(F.lit("brand"), (F.col("conv_id") % BRANDS).cast("string")))
        .alias("author_id"),
        F.when(F.col("role") == "user", True).when(F.col("role") == "assistant", False).alias("inbound"),
        F.concat(F.date_format(moment, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(moment, "yyyy")).alias(
            "created_at"
        ),
        "text",
        F.when(F.col("turn") > 0, tweet_id - 1).alias("in_response_to_tweet_id"),
    )
    if not children:
        return base
    followers = turns.where("turn > 0").select((tweet_id - 1).alias("tweet_id"), tweet_id.alias("_next"))
    return base.join(followers, "tweet_id", "left").select(
        "tweet_id", "author_id", "inbound", "created_at", "text",
        F.col("_next").cast("string").alias("response_tweet_id"), "in_response_to_tweet_id",
    )


def support_threads(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation up to its last support turn, as the long thread form; the turns are already numbered."""
    turns = table(spark, folder, "conversations", text_work=True)
    last = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("_last"))
    kept = turns.join(last, "conv_id").where(F.col("turn") <= F.col("_last"))
    return kept.select(
        F.concat(F.lit("brand"), (F.col("conv_id") % BRANDS).cast("string")).alias("brand"),
        (F.col("conv_id") * TURN_SPACE + F.col("_last")).alias("support_tweet_id"),
        (F.col("_last") + 1).alias("num_messages"),
        (F.col("turn") + 1).alias("position"),
        (F.col("conv_id") * TURN_SPACE + F.col("turn")).alias("tweet_id"),
        F.when(F.col("role") == "user", "customer").when(F.col("role") == "assistant", "support").alias("speaker"),
        "text",
    )
