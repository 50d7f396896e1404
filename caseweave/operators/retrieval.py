"""Intent-aware retrieval of historical cases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from caseweave.functions import lexicon
from caseweave.functions.decisions import keyword_compatibility
from caseweave.operators import postings, tfidf
from caseweave.operators.cases import answerable
from caseweave.operators.similarity import top_k

Keywords = Mapping[str, Sequence[str]]


def _intent_index(intent: Column, intents: Sequence[str]) -> Column:
    """Position of the intent in ``intents``; -1 for an unknown or missing one."""
    return F.coalesce(F.array_position(F.array(*[F.lit(i) for i in intents]), intent), F.lit(0)).cast("int") - 1


def prepare_cases(
    cases: DataFrame,
    model: tfidf.TfidfModel,
    keywords: Keywords = lexicon.INTENT_KEYWORDS,
    id_column: str = "support_tweet_id",
    text: str = "customer_text",
    reply: str = "support_text",
) -> DataFrame:
    """Cases as (case_id, indices, weights, compatibility): unit vector and one keyword score per intent.

    Only cases with a reply count, one per question text.
    """
    cases = answerable(cases, text, reply, id_column)
    scores = F.array(*[keyword_compatibility(F.col(text), intent, keywords) for intent in keywords])
    scored = cases.select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), scores.cast("array<double>").alias("compatibility")
    )
    return tfidf.transform(scored, model, ["compatibility"]).withColumnRenamed("id", "case_id")


def index_cases(
    cases: DataFrame,
    model: tfidf.TfidfModel,
    path: str,
    keywords: Keywords = lexicon.INTENT_KEYWORDS,
    id_column: str = "support_tweet_id",
    text: str = "customer_text",
    depth: int = 10,
) -> postings.CaseIndex:
    """A new version of the case index kept at ``path``, for streams and services; :func:`postings.load` opens it."""
    return postings.build(prepare_cases(cases, model, keywords, id_column, text), path, depth)


def retrieve(
    queries: DataFrame,
    cases: DataFrame,
    model: tfidf.TfidfModel,
    k: int = 3,
    keywords: Keywords = lexicon.INTENT_KEYWORDS,
    id_column: str = "support_tweet_id",
    text: str = "customer_text",
    index: postings.CaseIndex | None = None,
) -> DataFrame:
    """The ``k`` best cases per query by .75 * similarity + .25 * compatibility with the query's intent.

    ``queries`` is (query_id, query, intent); a null intent counts no keywords. Ties go to the smaller case id.
    ``index`` is a case index of the same model and keywords (:func:`index_cases`); with it no case is read or vectorised
    anew, which is what a stream or a service wants.
    """
    intents = list(keywords)
    indexed = queries.select(
        F.col("query_id").alias("id"), F.col("query").alias("text"),
        _intent_index(F.col("intent"), intents).alias("intent_index"),
    )
    vectors = tfidf.transform(indexed, model, ["intent_index"]).withColumnRenamed("id", "query_id")
    weights = lexicon.SIMILARITY_WEIGHT, lexicon.COMPATIBILITY_WEIGHT
    if index is not None:
        return postings.search(vectors, index, k, *weights)
    return top_k(vectors, prepare_cases(cases, model, keywords, id_column, text), k, *weights)


def retrieve_messages(
    queries: DataFrame, corpus: DataFrame, model: tfidf.TfidfModel, k: int = 5, id_column: str = "tweet_id",
    text: str = "clean_text",
) -> DataFrame:
    """The ``k`` most similar texts per query, by cosine alone; ``queries`` is (query_id, query)."""
    query_vectors = tfidf.transform(tfidf.document_text(queries, "query_id", "query"), model)
    case_vectors = tfidf.transform(tfidf.document_text(corpus, id_column, text), model)
    return top_k(
        query_vectors.withColumnRenamed("id", "query_id"), case_vectors.withColumnRenamed("id", "case_id"), k
    ).drop("intent_compatibility", "combined_score")


def with_case_texts(ranked: DataFrame, cases: DataFrame, id_column: str = "support_tweet_id") -> DataFrame:
    """Look the retrieved ids up in the case table."""
    texts = cases.select(
        F.col(id_column).alias("case_id"),
        F.col("customer_text").alias("customer_case"),
        F.col("support_text").alias("support_response"),
    )
    return ranked.join(texts, "case_id", "left")


def best_case(ranked: DataFrame) -> DataFrame:
    """The first-ranked case of each query."""
    return ranked.where("rank = 1").drop("rank")


CASE_FIELDS = (
    "rank", "case_id", "customer_case", "support_response", "similarity", "intent_compatibility", "combined_score",
)


def cases_per_query(ranked: DataFrame, key: str = "query_id") -> DataFrame:
    """(key, cases): the retrieved cases of a query as one array in rank order; at most k entries per query id.

    The texts are part of an entry if they were looked up before.
    """
    entry = F.struct(*[c for c in CASE_FIELDS if c in ranked.columns])
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("cases"))


def cited_cases(ranked: DataFrame, cases: DataFrame, id_column: str = "support_tweet_id") -> DataFrame:
    """Each retrieved case once with its texts and the number of queries that cite it."""
    counts = ranked.groupBy("case_id").agg(F.count(F.lit(1)).alias("queries"))
    return with_case_texts(counts, cases, id_column)


def queries_of_first_ids(ranked: DataFrame, n: int = 5) -> DataFrame:
    """The retrieved rows of the first ``n`` query ids, for inspection."""
    first = ranked.select("query_id").distinct().orderBy("query_id").limit(n)
    return ranked.join(F.broadcast(first), "query_id", "left_semi")
