"""Exact top-k similarity of queries with cases over an inverted index of the cases.

Vectors have unit length and no negative weights. The index holds a row per (term, case). All terms have one order, rarest
first; a posting knows the norm and the greatest weight of what its case holds from that term on, a query term likewise
the norm and the sum. So the terms from there on add at most ``min(norm * norm, sum * greatest)`` to a similarity.

A search goes in steps that only drop pairs which cannot be among the best ``k``:

1. *Seeds*: the rarest terms of a query give some cases; the exact scores of the best of them bound its ``k``-th best
   score from below.
2. *Postings*: a query term meets a posting if what both hold from there on can still reach ``PART`` of what the bound
   asks for. The products are added up per pair. What was not met adds less than that part, so a pair stays only if its
   sum reaches the rest.
3. *Exact scores* of the pairs that are left, from the whole vectors.

The products of step 2 are shuffled, so they are only formed where their number, bounded from the frequencies of the terms
beforehand, stays near the number of entries, as for a micro-batch or for queries of rare terms. Many queries of common terms
meet the index's vectors block by block instead (:func:`caseweave.operators.similarity.search_blocks`): no product leaves
its task, and the rows are the same.

The second score, one number per case and intent, takes part in all bounds. The cases that are best by it alone are kept
per intent; they fill up queries that have fewer than ``k`` similar cases, and bound the others.

A term is dealt to slices of about ``SLICE`` postings, so no term's postings meet in one task; no side is broadcast but
lists whose size is counted first. The index can be kept: its postings lie in folders by a hash of the term, and a search
reads only the folders of its own terms.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from caseweave.operators import similarity
from caseweave.operators.blocks import DECIMALS
from caseweave.session import cut_lineage, scratch_path

COMMON = 1_000  # a common term is in more than one case of so many, and in LEAST at least
LEAST, SLICE = 16, 50_000
SEEDS, PART = 256, 0.5
SLACK = 1e-8
FEW_PRODUCTS, PRODUCTS = 1_000_000, 2  # products that a search may shuffle: so many, or so many per entry of both sides
FOLDERS = 256
BROADCAST_ROWS = 500_000
TABLES = ("common", "postings", "cases", "leaders")


@dataclass(frozen=True)
class CaseIndex:
    """``common`` (term, df, slices) the common terms, ``postings`` (term, folder, slice, case_id, weight, norm, top,
    compatibility), ``cases`` (case_id, indices, weights) and ``leaders`` (intent_index, place, case_id, compatibility):
    the ``depth`` best cases of each intent and, as intent -1, the first ones. Other terms are in up to ``least`` cases."""

    common: DataFrame
    postings: DataFrame
    cases: DataFrame
    leaders: DataFrame
    depth: int
    least: int
    intents: int
    n_common: int
    folders: int
    entries: int = 0

    def of_terms(self, wanted: DataFrame) -> DataFrame:
        """The postings in the folders of the terms of ``wanted``."""
        if self.folders == 1:
            return self.postings
        numbers = [r[0] for r in wanted.select(_folder(self.folders)).distinct().collect()]  # ``folders`` at most
        return self.postings.where(F.col("folder").isin(numbers))

    def ordered(self, entries: DataFrame) -> DataFrame:
        """Entries with ``df`` (0 for terms that are not common) and ``slices``."""
        common = F.broadcast(self.common) if self.n_common <= BROADCAST_ROWS else self.common
        known = entries.join(common, "term", "left")
        return known.withColumns({"df": F.coalesce("df", F.lit(0)), "slices": F.coalesce("slices", F.lit(1))})


def _folder(folders: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(folders)).cast("int").alias("folder")


def _from_here(key: str) -> Window:
    """What a vector holds from a term on: the most frequent terms come first, so it is a running sum."""
    return Window.partitionBy(key).orderBy(F.desc("df"), F.desc("term")).rowsBetween(Window.unboundedPreceding, 0)


def _entries(vectors: DataFrame, *columns: str) -> DataFrame:
    zipped = F.explode(F.arrays_zip("indices", "weights")).alias("e")
    return vectors.select(*columns, zipped).select(*columns, F.col("e.indices").alias("term"), F.col("e.weights").alias("weight"))


_BOUNDED = """case_id long, compatibility array<double>,
entries array<struct<term int, slices int, weight double, norm double, top double>>"""


def _bounds_of(common: list) -> Callable:
    """For ``mapInArrow`` over cases: each entry with its term's slices, and the norm and top of its case from it on."""
    common = sorted((r["term"], r["df"], r["slices"]) for r in common)
    terms, df, slices = (np.array([r[i] for r in common], dtype=np.int64) for i in range(3))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, own_weights = batch.column("indices"), batch.column("weights")
            term, weight = np.asarray(lists.flatten()), np.asarray(own_weights.flatten())
            offsets = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)), dtype=np.int64)])
            known, times = np.zeros(len(term), np.int64), np.ones(len(term), np.int64)
            if len(terms):
                at = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
                known, times = np.where(terms[at] == term, df[at], 0), np.where(terms[at] == term, slices[at], 1)
            norm, top = np.empty(len(term)), np.empty(len(term))
            for lo, hi in zip(offsets[:-1], offsets[1:]):
                order = lo + np.lexsort((-term[lo:hi], -known[lo:hi]))
                norm[order] = np.sqrt(np.cumsum(weight[order] * weight[order]))
                top[order] = np.maximum.accumulate(weight[order])
            fields = {"term": term.astype(np.int32), "slices": times.astype(np.int32), "weight": weight, "norm": norm, "top": top}
            entry = pa.StructArray.from_arrays([pa.array(f) for f in fields.values()], list(fields))
            entries = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entry)
            yield pa.RecordBatch.from_arrays(
                [batch.column("case_id"), batch.column("compatibility"), entries], ["case_id", "compatibility", "entries"])

    return bounds


def build(cases: DataFrame, path: str | None = None, depth: int = 10, folders: int = FOLDERS) -> CaseIndex:
    """Index (case_id, indices, weights[, compatibility]); with ``path`` it is kept there as a new version.

    ``compatibility`` holds one score per intent, at least 0. A search may ask for up to ``depth`` cases.
    """
    spark = cases.sparkSession
    if "compatibility" not in cases.columns:
        cases = cases.withColumn("compatibility", F.array().cast("array<double>"))
    folder = f"{path}/version={max(_versions(spark, path), default=0) + 1}" if path else scratch_path(spark, "case-index")
    folders = folders if path else 1

    def kept(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    cases = kept(cases.select("case_id", "indices", "weights", "compatibility"), "cases")
    entries = _entries(cases, "case_id", "compatibility")
    n_cases, n_entries = cases.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("indices")), F.lit(0))).first()
    least = min(SLICE, max(LEAST, n_cases // COMMON))
    counted = entries.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > least)
    common = kept(counted.select("term", "df", F.ceil(F.col("df") / SLICE).cast("int").alias("slices")), "common")
    index = CaseIndex(common, entries, cases, entries, depth, least, 0, common.count(), folders, n_entries)

    if index.n_common <= BROADCAST_ROWS:  # then what a case holds from a term on is found inside its row
        marked = cases.mapInArrow(_bounds_of(common.collect()), _BOUNDED)
        exploded = marked.select("case_id", "compatibility", F.explode("entries").alias("e")).select("case_id", "compatibility", "e.*")
    else:
        square, here = F.col("weight") * F.col("weight"), _from_here("case_id")
        exploded = index.ordered(entries).withColumns(
            {"norm": F.sqrt(F.sum(square).over(here)), "top": F.max("weight").over(here)})
    postings = exploded.select(
        "term", F.pmod(F.xxhash64("case_id"), "slices").cast("int").alias("slice"), "case_id", "weight", "norm", "top",
        "compatibility", *([_folder(folders)] if path else []),
    )
    if path:
        postings = postings.repartition("folder", "slice").sortWithinPartitions("folder", "term")
    postings = kept(postings, "postings", *(["folder"] if path else []))

    first = cases.select(F.lit(-1).alias("intent_index"), F.lit(0.0).alias("score"), "case_id", "compatibility")
    by_intent = cases.select(F.posexplode("compatibility").alias("intent_index", "score"), "case_id", "compatibility")
    best_first = Window.partitionBy("intent_index").orderBy(F.desc("score"), "case_id")
    ranked = first.unionByName(by_intent).withColumn("place", F.row_number().over(best_first)).drop("score")
    ranked = kept(ranked.where(F.col("place") <= depth), "leaders")
    intents = (ranked.agg(F.max("intent_index")).first()[0] or 0) + 1
    if path:  # written last: the version is complete
        meta = json.dumps({"depth": depth, "folders": folders, "least": least, "intents": intents, "entries": n_entries})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{folder}/meta")
    return replace(index, postings=postings, leaders=ranked, intents=intents)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions of a kept index."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/meta/_SUCCESS")
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
    return [int(status.getPath().getParent().getParent().getName().split("=")[1]) for status in found or []]


def _open(spark: SparkSession, folder: str) -> CaseIndex:
    meta = json.loads(spark.read.text(f"{folder}/meta").first()["value"])
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES}
    return CaseIndex(**tables, **meta, n_common=tables["common"].count())


def load(spark: SparkSession, path: str, version: int | None = None) -> CaseIndex:
    """A kept index, by default its newest complete version."""
    newest = version or max(_versions(spark, path), default=None)
    if newest is None:
        raise FileNotFoundError(f"no complete case index at {path}")
    return _open(spark, f"{path}/version={newest}")


def _exact(pairs: DataFrame, queries: DataFrame, index: CaseIndex) -> DataFrame:
    """``query_id``, ``case_id``, ``similarity``, ``fit`` of (query_id, case_id), from the whole vectors."""
    own = queries.select("query_id", "intent_index", F.col("indices").alias("own_indices"), F.col("weights").alias("own_weights"))
    met = pairs.select("query_id", "case_id").join(own, "query_id").join(index.cases, "case_id")
    met = met.select("query_id", "case_id", _fit(), "own_indices", "own_weights", "indices", "weights")
    return met.mapInArrow(_products, "query_id long, case_id long, similarity double, fit double")


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inner products of the two sparse vectors of each row, whose indices ascend."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2_000):
            batch = whole.slice(start, 2_000)
            rows = np.arange(batch.num_rows, dtype=np.int64) << 32
            keys, weights, owners = [], [], []
            for at in (3, 5):
                count = np.asarray(batch.column(at).value_lengths())
                keys.append(np.repeat(rows, count) + np.asarray(batch.column(at).flatten()))
                weights.append(np.asarray(batch.column(at + 1).flatten()))
                owners.append(np.repeat(np.arange(batch.num_rows), count))
            similarity = np.zeros(batch.num_rows)
            if len(keys[0]) and len(keys[1]):
                place = np.minimum(np.searchsorted(keys[1], keys[0]), len(keys[1]) - 1)
                same = keys[1][place] == keys[0]
                products = weights[0][same] * weights[1][place[same]]
                similarity = np.bincount(owners[0][same], weights=products, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(similarity), batch.column(2)], ["query_id", "case_id", "similarity", "fit"]
            )


def _fit() -> Column:
    return F.coalesce(F.get("compatibility", F.col("intent_index")), F.lit(0.0)).alias("fit")


def _kth(scores: DataFrame, k: int) -> DataFrame:
    """``query_id`` and ``bound``, the k-th best ``score``, of the queries that have so many."""
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"))
    placed = scores.withColumn("n", F.row_number().over(best_first)).where(F.col("n") <= k)
    return placed.where(F.col("n") == k).select("query_id", F.col("score").alias("bound"))


def candidates(
    queries: DataFrame, index: CaseIndex, k: int, similarity_weight: float = 1.0, compatibility_weight: float = 0.0
) -> DataFrame:
    """The pairs (query_id, case_id) with a common term that are not shown to be outside of the best ``k``."""
    ws, wc = F.lit(similarity_weight), F.lit(compatibility_weight)
    combined = ws * F.col("similarity") + wc * F.col("fit")
    here, weight = _from_here("query_id"), F.col("query_weight")
    entries = _entries(queries, "query_id", "intent_index").withColumnRenamed("weight", "query_weight")
    rarest = Window.partitionBy("query_id").orderBy("df", "term")
    terms = cut_lineage(index.ordered(entries).withColumns({
        "query_norm": F.sqrt(F.sum(weight * weight).over(here)), "query_sum": F.sum("query_weight").over(here),
        "place": F.row_number().over(rarest),
        "seen": F.sum(F.greatest("df", F.lit(index.least))).over(rarest.rowsBetween(Window.unboundedPreceding, 0)),
    }))
    postings = index.of_terms(terms).drop("folder")

    def met(own: DataFrame) -> DataFrame:
        return own.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).join(postings, ["term", "slice"])

    # Some cases of the rarest terms; any will do for a bound, so of a single common term a part.
    few = met(terms.where((F.col("place") == 1) | (F.col("seen") <= SEEDS))).where(
        (F.col("seen") <= SEEDS) | (F.pmod(F.hash("case_id"), F.ceil(F.col("df") / SEEDS)) == 0)
    ).select("query_id", "case_id", (weight * F.col("weight")).alias("p"), _fit())
    few = few.groupBy("query_id", "case_id").agg((ws * F.sum("p") + wc * F.first("fit")).alias("score"))
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "case_id")
    few = few.withColumn("n", F.row_number().over(best_first)).where(F.col("n") <= 2 * k)
    seeds = _exact(few, queries, index).select("query_id", combined.alias("score"))
    led = leaders(queries, index, k, compatibility_weight).select("query_id", combined.alias("score"))
    bounds = _kth(seeds, k).unionByName(_kth(led, k)).groupBy("query_id").agg((F.max("bound") - SLACK).alias("bound"))
    bounds = cut_lineage(bounds)

    # Where nothing bounds a query (fewer than k cases), all its postings are met.
    asked = F.coalesce("bound", F.lit(-1.0)) - wc * F.col("fit")  # of the similarity, times its weight
    products = met(terms.drop("df", "place", "seen").join(bounds, "query_id", "left")).withColumn("fit", _fit())
    most = lambda norm, total, other, top: F.least(norm * other, total * top)
    from_here = most(F.col("query_norm"), F.col("query_sum"), F.col("norm"), F.col("top"))
    products = products.where(ws * from_here >= PART * asked)
    rest = lambda norm, own: F.sqrt(F.greatest(norm * norm - own * own, F.lit(0.0)))
    after = most(rest(F.col("query_norm"), weight), F.col("query_sum") - weight, rest(F.col("norm"), F.col("weight")), F.col("top"))
    pairs = products.groupBy("query_id", "case_id").agg(
        F.sum(weight * F.col("weight")).alias("partial"), F.min(after).alias("after"), F.first("fit").alias("fit"), F.first("bound").alias("bound")
    )
    missed = F.least(ws * F.col("after") + SLACK, F.greatest(PART * asked, F.lit(0.0)))
    return pairs.where(ws * F.col("partial") + missed >= asked).select("query_id", "case_id")


def leaders(queries: DataFrame, index: CaseIndex, k: int, compatibility_weight: float) -> DataFrame:
    """The ``k`` cases that are best for each query's intent by compatibility alone, as if nothing were similar."""
    counts = F.col("intent_index").between(0, index.intents - 1) & F.lit(compatibility_weight > 0)
    best = index.leaders.where(F.col("place") <= k).withColumnRenamed("intent_index", "leading")  # k rows per intent
    led = queries.select("query_id", "intent_index", F.when(counts, F.col("intent_index")).otherwise(-1).alias("leading"))
    return led.join(F.broadcast(best), "leading").select("query_id", "case_id", F.lit(0.0).alias("similarity"), _fit())


def _meets_few(queries: DataFrame, index: CaseIndex) -> bool:
    """Whether the postings that share a term with a query are few beside the entries of both sides."""
    met = index.ordered(_entries(queries, "query_id")).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.greatest("df", F.lit(index.least))), F.lit(0))
    ).first()
    return met[1] <= max(FEW_PRODUCTS, PRODUCTS * (index.entries + met[0]))


def search(
    queries: DataFrame, index: CaseIndex, k: int, similarity_weight: float = 1.0, compatibility_weight: float = 0.0
) -> DataFrame:
    """The ``k`` best cases per query with ranks 1..k, by combined score and then by the smaller case id.

    ``queries`` is (query_id, indices, weights[, intent_index]); ``intent_index`` points into a case's compatibility, -1
    for none. Every query gets k rows as long as there are k cases, also at similarity 0.
    """
    if k > index.depth:
        raise ValueError(f"the index was built for up to {index.depth} cases a query")
    if "intent_index" not in queries.columns:
        queries = queries.withColumn("intent_index", F.lit(-1))
    queries = cut_lineage(queries.select("query_id", "indices", "weights", "intent_index"))
    if not _meets_few(queries, index):
        return similarity.search_blocks(queries, index.cases, k, similarity_weight, compatibility_weight)
    near = cut_lineage(candidates(queries, index, k, similarity_weight, compatibility_weight))
    scored = _exact(near, queries, index).unionByName(leaders(queries, index, k, compatibility_weight))
    scored = scored.groupBy("query_id", "case_id").agg(F.max("similarity").alias("similarity"), F.max("fit").alias("fit"))
    scored = scored.withColumn(
        "combined_score", F.lit(similarity_weight) * F.col("similarity") + F.lit(compatibility_weight) * F.col("fit")
    )
    best_first = Window.partitionBy("query_id").orderBy(F.desc(F.round("combined_score", DECIMALS)), "case_id")
    return scored.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "case_id", "similarity", F.col("fit").alias("intent_compatibility"), "combined_score"
    )
