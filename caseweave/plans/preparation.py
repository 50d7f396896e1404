"""Preparation jobs: cleaning, samples for discovery and annotation, golden candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caseweave.functions import lexicon, text as tx
from caseweave.operators.audit import quality_metrics
from caseweave.operators.relational import add_constants, customers_of, drop_blank, project
from caseweave.operators.sampling import keep_first, sample_rows, unique_texts

SAMPLE_COLUMNS = (
    "tweet_id", "created_at", "author_id", "clean_text", "response_tweet_id", "in_response_to_tweet_id",
)


def with_clean_text(messages: DataFrame, full_entities: bool = True) -> DataFrame:
    """Add the raw text without nulls, the cleaned text and the parsed time."""
    return messages.withColumns({
        "raw_text": F.coalesce("text", F.lit("")),
        "clean_text": tx.clean_text(F.col("text"), full_entities),
        "created_at_parsed": tx.parse_created_at(F.col("created_at")),
    })


def clean_messages(messages: DataFrame, full_entities: bool = True) -> tuple[DataFrame, DataFrame]:
    """The cleaned table with one row per id, the earliest one, and the nine quality metrics of the raw table.

    De-duplication ranks rows before the Python step, so surplus copies are not decoded.
    """
    timed = messages.withColumn("_at", tx.parse_created_at(F.col("created_at")))
    order = [F.col("_at").asc_nulls_last(), "author_id", "text"]
    unique = keep_first(timed, ["tweet_id"], order).drop("_at")
    return with_clean_text(unique, full_entities), quality_metrics(messages)


def chronological(messages: DataFrame) -> DataFrame:
    return messages.orderBy(F.col("created_at_parsed").asc_nulls_last(), "tweet_id")


def discovery_sample(clean: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """Sampled distinct customer messages, projected and in order of their creation text."""
    customers = unique_texts(drop_blank(customers_of(clean), "clean_text"), "clean_text", "tweet_id")
    return project(sample_rows(customers, "tweet_id", n, seed), SAMPLE_COLUMNS).orderBy("created_at", "tweet_id")


def golden_candidates(sample: DataFrame, n: int = 200, seed: int = 42) -> DataFrame:
    """Distinct messages drawn from the sample, with blank annotation columns and the label options."""
    stripped = sample.withColumn("clean_text", tx.squeeze(F.coalesce("clean_text", F.lit(""))))
    unique = unique_texts(drop_blank(stripped, "clean_text"), "clean_text", "tweet_id")
    return add_constants(sample_rows(unique, "tweet_id", n, seed), {
        "intent": "",
        "resolution_status": "",
        "requires_escalation": "",
        "annotation_notes": "",
        "intent_options": lexicon.INTENT_OPTIONS,
        "resolution_options": lexicon.RESOLUTION_OPTIONS,
        "escalation_options": lexicon.ESCALATION_OPTIONS,
    })


def disjoint_split(clean: DataFrame, discovery: int = 500, golden: int = 200, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A discovery sample and a golden set that share no message."""
    first = discovery_sample(clean, discovery, seed)
    rest = clean.join(first.select("tweet_id"), "tweet_id", "left_anti")
    return first, golden_candidates(discovery_sample(rest, discovery, seed + 1), golden, seed)
