"""Audits of a message table: totals, gaps, duplicates, authors, reply attribution and reply quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caseweave.functions import text as tx
from caseweave.schema import to_flag


def as_metrics(one_row: DataFrame) -> DataFrame:
    """A one-row aggregate as (metric, value) rows."""
    return one_row.unpivot([], one_row.columns, "metric", "value")


def _count() -> Column:
    return F.count(F.lit(1))


def message_totals(messages: DataFrame) -> DataFrame:
    """Rows, direction counts, distinct ids and surplus occurrences of ids; null ids are left out of the last two."""
    return as_metrics(messages.agg(
        _count().alias("total_rows"),
        F.count_if(F.col("inbound")).alias("inbound_customer_tweets"),
        F.count_if(~F.col("inbound")).alias("outbound_support_tweets"),
        F.countDistinct("tweet_id").alias("unique_tweet_ids"),
        (F.count("tweet_id") - F.countDistinct("tweet_id")).alias("duplicate_tweet_ids"),
    ))


def missing_values(df: DataFrame) -> DataFrame:
    """Nulls per column and their share of all rows in percent, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns], _count().alias("_rows"))
    long = counts.unpivot(["_rows"], df.columns, "column", "missing_values")
    share = tx.safe_ratio(F.col("missing_values"), F.col("_rows")) * 100
    return long.select("column", "missing_values", share.alias("missing_percentage"))


def text_frequency(df: DataFrame, text: str = "text") -> DataFrame:
    """How often each text occurs; null counts as the empty text."""
    return df.groupBy(F.coalesce(text, F.lit("")).alias("text")).agg(_count().alias("n"))


def author_statistics(messages: DataFrame) -> DataFrame:
    """Activity per author with the share of messages that drew a response."""
    stats = messages.where(F.col("author_id").isNotNull()).groupBy("author_id").agg(
        _count().alias("tweets"),
        F.count_if(F.col("inbound")).alias("inbound"),
        F.count_if(~F.col("inbound")).alias("outbound"),
        F.count("response_tweet_id").alias("tweets_with_responses"),
    )
    return stats.withColumn("response_rate", tx.safe_ratio(F.col("tweets_with_responses"), F.col("tweets")))


def duplicated_rows(df: DataFrame, key: Column, name: str) -> DataFrame:
    """One row: how many rows share their key with another row."""
    sizes = df.groupBy(key.alias("_key")).agg(_count().alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias(name))


def missing_parents(messages: DataFrame) -> DataFrame:
    """One row: references to a parent that is not in the table. References are counted before the join."""
    parents = (
        messages.where(F.col("in_response_to_tweet_id").isNotNull())
        .groupBy(F.col("in_response_to_tweet_id").alias("tweet_id"))
        .agg(_count().alias("n"))
    )
    orphans = parents.join(messages.select("tweet_id"), "tweet_id", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("missing_parent_references"))


def quality_metrics(messages: DataFrame) -> DataFrame:
    """The nine (metric, value) rows of the data-quality report; unknown direction counts as support here."""
    raw_text = F.coalesce("text", F.lit(""))
    inbound = to_flag(F.col("inbound"), null_as_false=True)
    totals = messages.agg(
        _count().alias("raw_rows"),
        # A null id is one more key to keep-first, as it is to the de-duplication.
        (F.countDistinct("tweet_id") + F.max(F.when(F.col("tweet_id").isNull(), 1).otherwise(0))).alias("clean_rows"),
        F.count_if(tx.is_blank(F.col("text"))).alias("empty_text_rows"),
        F.count_if(tx.parse_created_at(F.col("created_at")).isNull()).alias("invalid_created_at_rows"),
        F.count_if(inbound).alias("customer_inbound_rows"),
        F.count_if(~inbound).alias("support_outbound_rows"),
    )
    parts = [
        totals,
        duplicated_rows(messages, F.col("tweet_id"), "duplicate_tweet_id_rows"),
        duplicated_rows(messages, raw_text, "duplicate_text_rows"),
        missing_parents(messages),
    ]
    return reduce(DataFrame.unionByName, [
        as_metrics(p).select("metric", F.coalesce("value", F.lit(0)).cast("bigint").alias("value")) for p in parts
    ])


def reply_statistics(messages: DataFrame) -> DataFrame:
    """Support messages per brand, how many of them reply to a customer, and how many customers' messages they answer.

    Replies are first counted per (brand, parent), which also folds all messages without a parent into one row.
    """
    support = (
        messages.where(~F.col("inbound"))
        .groupBy(F.col("author_id").alias("brand"), F.col("in_response_to_tweet_id").alias("parent_id"))
        .agg(_count().alias("n"))
    )
    customers = messages.where("inbound").select(F.col("tweet_id").alias("parent_id")).distinct()
    answered = support.join(customers.withColumn("is_customer", F.lit(True)), "parent_id", "left")
    return answered.groupBy("brand").agg(
        F.sum("n").alias("support_tweets"),
        F.count("is_customer").alias("customer_messages_answered"),
        F.coalesce(F.sum(F.when(F.col("is_customer"), F.col("n"))), F.lit(0)).alias("support_replies_to_customer"),
    )


def reply_quality(replies: DataFrame, brand: str = "author_id", text: str = "text") -> DataFrame:
    """Diversity, length and signal rates of the replies per brand.

    Equal replies of a brand are folded first, so copies are read once and a big brand spreads over all tasks.
    """
    folded = replies.groupBy(F.col(brand).alias("brand"), F.coalesce(text, F.lit("")).alias("text")).agg(
        _count().alias("n")
    )
    body = F.col("text")

    def weighted(value: Column) -> Column:
        return F.sum(F.col("n") * value.cast("bigint"))

    sums = folded.groupBy("brand").agg(
        F.sum("n").alias("support_tweets"),
        _count().alias("unique_support_responses"),
        weighted(tx.word_count(body)).alias("_words"),
        weighted(tx.asks_for_dm(body)).alias("_dm"),
        weighted(tx.apologises(body)).alias("_apology"),
        weighted(tx.signals_resolution(body)).alias("_resolution"),
    )

    def per_reply(column: str) -> Column:
        return tx.safe_ratio(F.col(column), F.col("support_tweets"))

    return sums.select(
        "brand",
        "support_tweets",
        "unique_support_responses",
        per_reply("unique_support_responses").alias("response_diversity"),
        per_reply("_words").alias("average_response_words"),
        per_reply("_dm").alias("dm_request_rate"),
        per_reply("_apology").alias("apology_rate"),
        per_reply("_resolution").alias("resolution_signal_rate"),
    )
