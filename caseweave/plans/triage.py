"""End-to-end triage of a table of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caseweave.functions import lexicon
from caseweave.functions.decisions import RuleTable, action_reply, route
from caseweave.operators import tfidf
from caseweave.operators.classify import IntentModel, classify
from caseweave.operators.postings import CaseIndex
from caseweave.operators.relational import validate_requests
from caseweave.operators.retrieval import Keywords, cases_per_query, retrieve, with_case_texts
from caseweave.session import cut_lineage

RESULT_COLUMNS = (
    "query", "intent", "classifier_confidence", "classifier_source", "retrieval_similarity", "intent_compatibility",
    "combined_score", "action", "decision_reason", "response", "grounded", "needs_escalation", "retrieved_cases",
)


def decide(classified: DataFrame, ranked: DataFrame, cases: DataFrame, case_texts: bool = True) -> DataFrame:
    """Route and answer (query_id, query, intent, confidence, source) given the ranked cases of each query.

    Only the best case's reply travels to its query; ``case_texts`` adds the texts of all retrieved cases to
    ``retrieved_cases``, which otherwise holds their ids and scores.
    """
    listed = cases_per_query(with_case_texts(ranked, cases) if case_texts else ranked)
    joined = classified.join(listed, "query_id", "left").withColumn("_best", F.get("cases", F.lit(0)))
    zero = F.lit(0.0)
    scored = joined.select(
        "*",
        F.coalesce(F.col("_best.similarity"), zero).alias("retrieval_similarity"),
        F.coalesce(F.col("_best.intent_compatibility"), zero).alias("intent_compatibility"),
        F.coalesce(F.col("_best.combined_score"), zero).alias("combined_score"),
    )
    routed = scored.withColumn("_route", route(
        F.col("intent"), F.col("retrieval_similarity"), F.col("intent_compatibility"), F.col("combined_score")
    ))
    # A fixed reply needs no case, so only answered messages look one up. They come back by their own id: a join
    # on the case would put all messages without a lookup under one null key.
    texts = cases.select(F.col("support_tweet_id").alias("_case"), F.col("support_text").alias("_support"))
    lookups = routed.where(F.col("_route.action") == "ANSWER").select("query_id", F.col("_best.case_id").alias("_case"))
    sourced = routed.join(lookups.join(texts, "_case").drop("_case"), "query_id", "left")
    answered = sourced.withColumn("_reply", action_reply(
        F.col("_route.action"), F.col("_best.similarity"), F.col("_support")
    ))
    return answered.select(
        "query_id", "query", "intent",
        F.col("confidence").alias("classifier_confidence"),
        F.col("source").alias("classifier_source"),
        "retrieval_similarity", "intent_compatibility", "combined_score",
        F.col("_route.action").alias("action"),
        F.col("_route.reason").alias("decision_reason"),
        "_reply.response", "_reply.grounded", "_reply.needs_escalation",
        F.coalesce("cases", F.array().cast(listed.schema["cases"].dataType)).alias("retrieved_cases"),
    )


def triage(
    messages: DataFrame,
    cases: DataFrame,
    text_model: tfidf.TfidfModel,
    intent_model: IntentModel | None = None,
    top_k: int = 3,
    rules: RuleTable = lexicon.INTENT_RULES,
    keywords: Keywords = lexicon.INTENT_KEYWORDS,
    case_texts: bool = True,
    index: CaseIndex | None = None,
) -> DataFrame:
    """(query_id, query) to one result row each: intent, evidence scores, action, reason, reply and cases."""
    named = messages.select(F.col("query_id").alias("id"), F.col("query").alias("text"))
    classes = classify(named, intent_model, rules, with_text=True)
    classified = cut_lineage(classes.withColumnsRenamed({"id": "query_id", "text": "query"}))
    ranked = cut_lineage(retrieve(classified, cases, text_model, top_k, keywords, index=index))
    return decide(classified, ranked, cases, case_texts)


def service_response(results: DataFrame) -> DataFrame:
    """The triage result as the service shapes it."""
    return results.withColumnRenamed("retrieved_cases", "historical_cases")


def serve(
    requests: DataFrame, cases: DataFrame, text_model: tfidf.TfidfModel, top_k: int = 3, **options
) -> tuple[DataFrame, DataFrame]:
    """Responses to the valid requests of (query_id, message), and the rejected requests."""
    accepted, rejected = validate_requests(requests, top_k)
    messages = accepted.select("query_id", F.col("message").alias("query"))
    return service_response(triage(messages, cases, text_model, top_k=top_k, **options)), rejected
