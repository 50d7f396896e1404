"""Batch evaluation: agent results, retrieval records, annotation table and judging."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from caseweave import schema
from caseweave.functions import judging
from caseweave.operators import tfidf
from caseweave.operators.metrics import score_means
from caseweave.operators.relational import add_constants, dense_row_id, require_rows, value_counts
from caseweave.operators.retrieval import retrieve, with_case_texts
from caseweave.operators.sampling import sample_rows
from caseweave.plans.triage import triage


def golden_queries(golden: DataFrame) -> DataFrame:
    """Golden rows with a text and an intent as (query_id, query, gold labels)."""
    def label(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit("")) if column in golden.columns else F.lit("")

    return golden.na.drop(subset=["clean_text", "intent"]).select(
        F.col("annotation_id").cast("bigint").alias("query_id"),
        F.col("clean_text").alias("query"),
        F.col("intent").cast("string").alias("gold_intent"),
        label("resolution_status").alias("gold_resolution"),
        label("requires_escalation").alias("gold_escalation"),
    )


def evaluate_agent(golden: DataFrame, cases: DataFrame, text_model: tfidf.TfidfModel, **options) -> DataFrame:
    """Triage of every golden row next to its gold labels; no such row or no case is an error."""
    queries = require_rows(golden_queries(golden), "evaluation rows")
    require_rows(cases, "historical cases")
    results = triage(queries, cases, text_model, case_texts=False, **options).drop("query", "retrieved_cases")
    return queries.join(results, "query_id").select(
        F.col("query_id").alias("example_id"), "query", "gold_intent", F.col("intent").alias("predicted_intent"),
        "classifier_confidence", "retrieval_similarity", "gold_resolution", "gold_escalation",
        F.col("action").alias("agent_action"), "decision_reason", "response", "grounded", "needs_escalation",
    )


def evaluation_counts(evaluated: DataFrame) -> DataFrame:
    """(measure, value, n): how often each action, grounding flag and predicted intent occurs."""
    parts = [
        value_counts(evaluated, column).select(
            F.lit(column).alias("measure"), F.col(column).cast("string").alias("value"), "n"
        )
        for column in ("agent_action", "grounded", "predicted_intent")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def evaluate_retrieval(golden: DataFrame, cases: DataFrame, text_model: tfidf.TfidfModel, top_k: int = 3,
                       **options) -> DataFrame:
    """Retrieved cases of every golden row, using its gold intent; no such row or no case is an error."""
    queries = require_rows(golden_queries(golden), "evaluation rows")
    require_rows(cases, "historical cases")
    ranked = retrieve(queries.withColumnRenamed("gold_intent", "intent"), cases, text_model, top_k, **options)
    named = with_case_texts(ranked, cases).join(queries.select("query_id", "query", "gold_intent"), "query_id")
    return named.select(
        "query_id", "query", "gold_intent", "rank", F.col("case_id").alias("historical_support_tweet_id"),
        F.col("customer_case").alias("historical_customer"), F.col("support_response").alias("historical_support"),
        "similarity", "intent_compatibility", "combined_score",
    )


def relevance_annotation(retrieved: DataFrame, k: int = 5) -> DataFrame:
    """The top-k retrieved cases with blank judgment columns, numbered 1..n by query and rank."""
    top = retrieved.where(F.col("rank") <= k).select(
        F.col("query_id").alias("golden_id"), F.col("gold_intent").alias("golden_intent"),
        F.col("query").alias("golden_query"), "rank", "similarity", "historical_customer", "historical_support",
    )
    numbered = dense_row_id(top, ["golden_id", "rank"], "judgment_id")
    return add_constants(numbered, {"relevance": "", "annotation_notes": ""})


def annotation_summary(annotation: DataFrame) -> DataFrame:
    """One row: queries, records and the least and greatest number of cases per query."""
    sizes = annotation.groupBy("golden_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("queries"), F.sum("n").alias("records"),
        F.min("n").alias("least_cases"), F.max("n").alias("most_cases"),
    )


def attach_evidence(agent: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Add the ranked cases of each response as ``cases``; by query id when both sides have it, else by query text.

    The text key takes each query text's cases once per rank and case, so a text that repeats in the evaluation
    does not multiply its evidence.
    """
    schema.require_columns(agent, schema.AGENT_EVALUATION_COLUMNS, "agent evaluation")
    schema.require_columns(retrieved, schema.RETRIEVAL_EVALUATION_COLUMNS, "retrieval evaluation")
    by_id = "query_id" in retrieved.columns
    key = "example_id" if by_id else "query"
    evidence = retrieved.withColumnRenamed("query_id", "example_id").select(
        key,
        F.struct(
            "rank", F.col("historical_customer").alias("customer_case"),
            F.col("historical_support").alias("support_response"),
            "similarity", "intent_compatibility", "combined_score",
        ).alias("_case"),
    )
    if not by_id:
        evidence = evidence.distinct()
    gathered = evidence.groupBy(key).agg(F.sort_array(F.collect_list("_case")).alias("cases"))
    return agent.join(gathered, key, "left")


def matched_rows(with_evidence: DataFrame) -> DataFrame:
    """One row: how many responses have evidence."""
    return with_evidence.agg(
        F.count("cases").alias("rows_with_evidence"), F.count(F.lit(1)).alias("rows")
    )


def judge_prompts(agent: DataFrame, retrieved: DataFrame, rubric: str, n: int | None = 30, seed: int = 42) -> DataFrame:
    """(example_id, query, response, prompt) of a seeded sample of ``n`` responses, or of all of them."""
    schema.require_columns(agent, schema.AGENT_EVALUATION_COLUMNS, "agent evaluation")
    sample = agent if n is None else sample_rows(agent, "example_id", n, seed)
    joined = attach_evidence(sample.select("example_id", "query", "response"), retrieved)
    evidence = judging.format_evidence(F.col("cases"))
    return joined.select(
        "example_id", "query", "response",
        judging.build_prompt(F.col("query"), F.col("response"), evidence, rubric).alias("prompt"),
    )


def score_prompts(prompts: DataFrame, scorer: Callable[[str], str]) -> DataFrame:
    """Run a caller's scorer on each prompt inside the tasks; a failing row keeps its error and does not stop the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            replies, errors = [], []
            for prompt in rows["prompt"]:
                try:
                    replies.append(scorer(prompt))
                    errors.append(None)
                except Exception as problem:  # noqa: BLE001 - any failure of the caller's code belongs to its row
                    replies.append(None)
                    errors.append(str(problem))
            yield rows.drop(columns="prompt").assign(raw=replies, scorer_error=errors)

    kept = [f for f in prompts.schema.fields if f.name != "prompt"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return prompts.mapInPandas(run, f"{fields}, raw string, scorer_error string")


def parse_scores(scored: DataFrame) -> DataFrame:
    """Raw replies to scores; a row that failed has null scores and its error as the reason."""
    if "scorer_error" not in scored.columns:
        scored = scored.withColumn("scorer_error", F.lit(None).cast("string"))
    judged = judging.parse_judgments(scored, "raw")
    failure = F.concat(F.lit("Judge error: "), "scorer_error")
    return judged.select(
        "example_id", "query", "response", *judging.DIMENSIONS, F.coalesce(failure, F.col("reason")).alias("reason")
    )


def judge(
    agent: DataFrame, retrieved: DataFrame, scorer: Callable[[str], str], rubric: str, n: int | None = 30,
) -> DataFrame:
    """Prompts, the caller's scorer and parsed scores of a sample of responses."""
    return parse_scores(score_prompts(judge_prompts(agent, retrieved, rubric, n), scorer))


def judge_summary(judged: DataFrame) -> DataFrame:
    return score_means(judged, judging.DIMENSIONS)
