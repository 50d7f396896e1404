"""Historical cases: from threads or from single customer messages, without evaluation rows and copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caseweave.functions import text as tx
from caseweave.operators.relational import customers_of, drop_blank
from caseweave.operators.sampling import unique_texts


def _with_case_text(cases: DataFrame) -> DataFrame:
    """Both sides of a case as one text; they are normalised already, so only a missing reply leaves a blank to trim."""
    return cases.withColumn("case_text", F.trim(F.concat("customer_text", F.lit(" "), "support_text")))


def cases_from_turns(turns: DataFrame, brand: str | None = None) -> DataFrame:
    """One case per thread with a customer text: ids of its non-blank turns and the texts per speaker.

    ``turns`` is the long form of :mod:`caseweave.operators.threads`. The texts of a case are one value each, so
    one thread must fit in a row; nothing else is collected.
    """
    if brand is not None:
        turns = turns.where(F.lower(F.coalesce("brand", F.lit(""))) == brand.lower())
    spoken = turns.select("support_tweet_id", "position", "tweet_id", "speaker", tx.normalize(F.col("text")).alias("t"))
    spoken = spoken.where("t <> ''")

    def said_by(speaker: str):
        return F.collect_list(F.when(F.col("speaker") == speaker, F.struct("position", "t")))

    def joined(column: str):
        return F.array_join(F.transform(F.sort_array(column), lambda e: e["t"]), " ")

    gathered = spoken.groupBy("support_tweet_id").agg(
        F.collect_list(F.when(F.col("tweet_id").isNotNull(), F.struct("position", "tweet_id"))).alias("_ids"),
        said_by("customer").alias("_customer"),
        said_by("support").alias("_support"),
    ).where(F.size("_customer") > 0)
    cases = gathered.select(
        "support_tweet_id",
        F.transform(F.sort_array("_ids"), lambda e: e["tweet_id"]).alias("tweet_ids"),
        joined("_customer").alias("customer_text"),
        joined("_support").alias("support_text"),
    )
    return _with_case_text(cases)


def cases_from_threads(threads: DataFrame) -> DataFrame:
    """The same from nested THREAD records, row by row; for corpora that are already stored in that form."""

    def joined(speaker: str):
        kept = F.filter("_turns", lambda t: t["speaker"] == speaker)
        return F.array_join(F.transform(kept, lambda t: t["t"]), " ")

    turn = F.transform(
        "conversation",
        lambda t: F.struct(
            t["tweet_id"].alias("tweet_id"), F.lower(t["speaker"]).alias("speaker"), tx.normalize(t["text"]).alias("t")
        ),
    )
    spoken = threads.select("support_tweet_id", F.filter(turn, lambda t: t["t"] != "").alias("_turns"))
    ids = F.filter(F.transform("_turns", lambda t: t["tweet_id"]), lambda i: i.isNotNull())
    cases = spoken.select(
        "support_tweet_id",
        ids.alias("tweet_ids"),
        joined("customer").alias("customer_text"),
        joined("support").alias("support_text"),
    ).where("customer_text <> ''")
    return _with_case_text(cases)


def without_overlap(cases: DataFrame, golden: DataFrame) -> DataFrame:
    """Drop a case when any of its messages is a golden message."""
    members = cases.select("support_tweet_id", F.explode("tweet_ids").alias("tweet_id"))
    leaked = members.join(golden.select("tweet_id"), "tweet_id", "left_semi").select("support_tweet_id").distinct()
    return cases.join(leaked, "support_tweet_id", "left_anti")


def unique_cases(cases: DataFrame) -> DataFrame:
    """Cases with distinct texts; the smallest support id survives."""
    return unique_texts(cases, "case_text", "support_tweet_id")


def answerable(cases: DataFrame, question: str = "customer_text", reply: str = "support_text", id_column: str = "support_tweet_id") -> DataFrame:
    """The cases that retrieval may cite: with a question and a reply, one per question text; the smallest id survives.

    Equal questions are found by a digest, so a frequent question shuffles no text.
    """
    usable = drop_blank(drop_blank(cases, question), reply)
    key = F.sha2(F.col(question), 256)
    first = usable.groupBy(key.alias("_question")).agg(F.min(id_column).alias(id_column)).select(id_column)
    return usable.join(first, id_column, "left_semi")


def without_ids(corpus: DataFrame, golden: DataFrame, id_column: str = "tweet_id") -> DataFrame:
    """Remove evaluation rows from the corpus by id."""
    return corpus.join(golden.select(id_column), id_column, "left_anti")


def message_corpus(messages: DataFrame, golden: DataFrame, text: str = "clean_text") -> DataFrame:
    """Customer messages as cases: no golden rows, no blank texts, one row per text."""
    return unique_texts(drop_blank(without_ids(customers_of(messages), golden), text), text, "tweet_id")


def leakage_counters(before: DataFrame, golden: DataFrame, text: str, id_column: str = "tweet_id") -> DataFrame:
    """(metric, value): corpus size before and after the golden rows are removed, and the distinct remaining texts."""
    marked = before.join(
        golden.select(id_column).distinct().withColumn("_golden", F.lit(True)), id_column, "left"
    ).withColumn("_golden", F.coalesce("_golden", F.lit(False)))
    kept = ~F.col("_golden")
    counts = marked.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if("_golden").alias("golden_rows_removed"),
        F.count_if(kept).alias("rows_after"),
        F.countDistinct(F.when(kept & ~tx.is_blank(F.col(text)), F.col(text))).alias("unique_texts"),
    )
    return counts.unpivot([], counts.columns, "metric", "value")
