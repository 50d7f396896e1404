"""Intent discovery: k-means over TF-IDF for several k, the best k by silhouette, cluster terms and examples."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame, Window, functions as F

from caseweave.operators import blocks, tfidf
from caseweave.operators.sampling import sample_per_group, sample_rows
from caseweave.session import cut_lineage

SILHOUETTE_ROWS, ITERATIONS = 1_000, 300


def fit_kmeans(features: DataFrame, k: int, seed: int = 42, restarts: int = 10, parallel: int = 4) -> KMeansModel:
    """The k-means model with the lowest cost of ``restarts`` seeded runs; runs overlap on the cluster."""

    def run(number: int) -> KMeansModel:
        means = KMeans(k=k, seed=seed + number, maxIter=ITERATIONS, featuresCol="features", predictionCol="cluster")
        return means.fit(features)

    with ThreadPoolExecutor(parallel) as pool:
        return min(pool.map(run, range(restarts)), key=lambda model: model.summary.trainingCost)


def silhouette(sample: DataFrame) -> DataFrame:
    """(k, silhouette_score) of (k, id, indices, weights, cluster): exact Euclidean, one bounded group per k."""

    def score(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        value = blocks.silhouette_of_block(rows["indices"], rows["weights"], rows["cluster"].to_numpy())
        return pd.DataFrame({"k": [key[0]], "silhouette_score": [value]})

    return sample.groupBy("k").applyInPandas(score, "k int, silhouette_score double")


@dataclass(frozen=True)
class Clustering:
    scores: DataFrame  # (k, silhouette_score)
    best_k: int
    assigned: DataFrame  # (id, cluster)


def discover(
    vectors: DataFrame, size: int, ks: Sequence[int] = range(6, 13), seed: int = 42, restarts: int = 10,
    silhouette_rows: int = SILHOUETTE_ROWS,
) -> Clustering:
    """Cluster (id, indices, weights) for each k and keep the k with the highest silhouette, the smallest on ties.

    The silhouette is measured on at most ``silhouette_rows`` sampled rows, which bounds its pairwise distances.
    """
    features = cut_lineage(tfidf.to_ml_vectors(vectors, size))
    models = {k: fit_kmeans(features.select("features"), k, seed, restarts) for k in ks}
    sampled = cut_lineage(sample_rows(features, "id", silhouette_rows, seed))
    measured = None
    for k, model in models.items():
        part = model.transform(sampled).select(F.lit(k).alias("k"), "id", "indices", "weights", "cluster")
        measured = part if measured is None else measured.unionByName(part)
    scores = cut_lineage(silhouette(measured))
    best_k = scores.orderBy(F.desc("silhouette_score"), "k").first()["k"]
    assigned = models[best_k].transform(features).select("id", "cluster")
    return Clustering(scores, best_k, assigned)


def cluster_terms(
    vectors: DataFrame, model: tfidf.TfidfModel, assigned: DataFrame, top: int = 10
) -> DataFrame:
    """(cluster, size, rank, term, weight): the terms with the greatest mean weight per cluster."""
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sums = tfidf.group_sums(vectors.join(assigned, "id"), model, "cluster")
    means = sums.join(F.broadcast(sizes), "cluster").withColumn("weight", F.col("_sum") / F.col("size"))
    order = Window.partitionBy("cluster").orderBy(F.desc(F.round("weight", blocks.DECIMALS)), "term")
    ranked = means.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("cluster", "size", "rank", "term", "weight")


def representatives(clustered: DataFrame, id_column: str = "tweet_id", n: int = 10, seed: int = 42) -> DataFrame:
    """At most ``n`` sampled messages per cluster."""
    return sample_per_group(clustered, ["cluster"], id_column, n, seed)
