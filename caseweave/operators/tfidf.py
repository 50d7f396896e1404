"""TF-IDF over (1,2)-grams: vocabulary, weights, keyword report.

Term counts of a text come out of one sorted array inside its row, so neither fitting nor transforming shuffles
the raw term occurrences: fitting shuffles partial counts per term, transforming shuffles finished vectors.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from caseweave.functions import text as tx
from caseweave.operators.relational import dense_row_id
from caseweave.session import cut_lineage

# A vocabulary up to this size is broadcast and numbered in one task; it is a bound on rows, not a cut.
SMALL_VOCABULARY = 100_000
TEXTS = 2_000  # texts whose words a task looks up at once
_ENTRIES = T.ArrayType(T.StructType([T.StructField("index", T.IntegerType()), T.StructField("weight", T.DoubleType())]))


@dataclass(frozen=True)
class TfidfParams:
    min_df: int = 2
    max_df: float = 0.95
    max_features: int | None = 50_000
    stop_words: tuple[str, ...] = field(default=())


DISCOVERY = {"min_df": 3, "max_df": 0.90, "max_features": 5_000}


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary: (term, index, df, total, idf)."""

    vocabulary: DataFrame
    params: TfidfParams
    documents: int
    size: int

    def lookup(self) -> DataFrame:
        terms = self.vocabulary.select("term", "index", "idf")
        return F.broadcast(terms) if self.size <= SMALL_VOCABULARY else terms

    def save(self, path: str) -> None:
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        meta = json.dumps({"params": asdict(self.params), "documents": self.documents, "size": self.size})
        self.vocabulary.sparkSession.createDataFrame([(meta,)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/params")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TfidfModel:
        meta = json.loads(spark.read.text(f"{path}/params").first()["value"])
        params = meta["params"]
        params["stop_words"] = tuple(params["stop_words"])
        return TfidfModel(
            spark.read.parquet(f"{path}/vocabulary"), TfidfParams(**params), meta["documents"], meta["size"]
        )


def term_counts(docs: DataFrame, stop_words: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """(id, text) to (id, terms, counts): the distinct 1- and 2-grams of each text, sorted, with their counts.

    Stop words go before the pairs are built, so a pair may span a removed word. Columns in ``carry`` stay.
    """
    kept = tx.words(F.col("text"))
    if stop_words:
        kept = F.filter(kept, lambda w: ~w.isin(*stop_words))
    worded = docs.select("id", *carry, kept.alias("_w"))
    n = F.size("_w")
    pairs = F.zip_with(
        F.slice("_w", F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice("_w", F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    grams = worded.select("id", *carry, F.sort_array(F.concat(F.col("_w"), pairs)).alias("_g"))
    gram = F.col("_g")
    # 0-based places where a new term starts in the sorted array.
    firsts = F.filter(
        F.transform(gram, lambda _, i: i), lambda i: (i == 0) | (F.get(gram, i) != F.get(gram, i - 1))
    )
    marked = grams.select("id", *carry, "_g", firsts.alias("_at"))
    at = F.col("_at")
    return marked.select(
        "id",
        *carry,
        F.transform(at, lambda i: F.get(gram, i)).alias("terms"),
        F.transform(at, lambda place, i: F.coalesce(F.get(at, i + 1), F.size("_g")) - place).alias("counts"),
    )


def _exploded(counted: DataFrame, outer: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    pairs = F.arrays_zip("terms", "counts")
    entry = F.explode_outer(pairs) if outer else F.explode(pairs)
    return counted.select("id", *carry, entry.alias("_e")).select(
        "id", *carry, F.col("_e.terms").alias("term"), F.col("_e.counts").alias("tf")
    )


def _term_totals(stop_words: Sequence[str]) -> Callable:
    """For ``mapInArrow`` over word lists: how many of some ``TEXTS`` texts hold a 1- or 2-gram, and how often."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stopped = pa.array(list(stop_words), pa.string())
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                lists = whole.column(0).slice(start, TEXTS)
                owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
                flat = lists.flatten()
                if len(stopped):
                    kept = np.asarray(pc.invert(pc.is_in(flat, stopped)))
                    owner, flat = owner[kept], flat.filter(pa.array(kept))
                coded = flat.dictionary_encode()
                words, code = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
                beside = owner[1:] == owner[:-1]
                # A word has its own number as key, a pair lies above all words.
                pair = (code[:-1] * len(words) + code[1:] + len(words))[beside]
                texts = max(len(lists), 1)
                cells = np.sort(np.concatenate([code, pair]) * texts + np.concatenate([owner, owner[1:][beside]]))
                gram = cells // texts
                start = np.flatnonzero(np.diff(gram, prepend=-1))
                keys, total = gram[start], np.diff(start, append=len(gram))
                df = np.add.reduceat((np.diff(cells, prepend=-1) != 0).astype(np.int64), start) if len(start) else total
                first, second = np.divmod(keys[keys >= len(words)] - len(words), max(len(words), 1))
                pairs = pc.binary_join_element_wise(words.take(pa.array(first)), words.take(pa.array(second)), " ")
                terms = pa.concat_arrays([words.take(pa.array(keys[keys < len(words)])), pairs])
                yield pa.RecordBatch.from_arrays([terms, pa.array(df), pa.array(total)], ["term", "df", "total"])

    return totals


def fit(docs: DataFrame, params: TfidfParams = TfidfParams()) -> TfidfModel:
    """Fit the vocabulary on (id, text). The most frequent ``max_features`` terms stay, ties by term."""
    documents = docs.count()
    worded = docs.select(tx.words(F.col("text")).alias("_w"))
    counted = worded.mapInArrow(_term_totals(params.stop_words), "term string, df long, total long")
    terms = counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    terms = terms.where((F.col("df") >= params.min_df) & (F.col("df") <= params.max_df * documents))
    idf = F.log((F.lit(1.0) + documents) / (F.lit(1.0) + F.col("df"))) + 1.0
    terms = terms.withColumn("idf", idf)
    kept = ["term", "index", "df", "total", "idf"]
    by_term = (F.row_number().over(Window.orderBy("term")) - 1).alias("index")
    if params.max_features is not None:
        terms = terms.orderBy(F.desc("total"), "term").limit(params.max_features)
    if params.max_features is not None and params.max_features <= SMALL_VOCABULARY:
        vocabulary = cut_lineage(terms.select("*", by_term).select(*kept))
        return TfidfModel(vocabulary, params, documents, vocabulary.count())
    terms = cut_lineage(terms)
    size = terms.count()
    if size <= SMALL_VOCABULARY:
        numbered = terms.select("*", by_term)
    else:
        numbered = dense_row_id(terms, ["term"], "_n").withColumn("index", (F.col("_n") - 1).cast("int"))
    return TfidfModel(cut_lineage(numbered.select(*kept)), params, documents, size)


def raw_weights(docs: DataFrame, model: TfidfModel, carry: Sequence[str] = ()) -> DataFrame:
    """(id, index, weight): sublinear tf times idf before the norm; terms outside the vocabulary are null rows."""
    counted = _exploded(term_counts(docs, model.params.stop_words, carry), True, carry)
    known = counted.join(model.lookup(), "term", "left")
    return known.select("id", *carry, "index", ((F.lit(1.0) + F.log("tf")) * F.col("idf")).alias("weight"))


def _vocabulary_lookup(rows: list) -> tuple:
    """The vocabulary as arrays: its words, the index of each as a term or -1, ordered keys of pairs of words, their index."""
    split = [(r["term"].partition(" "), r["index"], r["idf"]) for r in rows]
    words = sorted({w for (first, _, second), _, _ in split for w in (first, second) if w})
    number = {w: i for i, w in enumerate(words)}
    single, pairs, idf = np.full(len(words) + 1, -1), [], np.zeros(len(rows))
    for (first, _, second), index, value in split:
        idf[index] = value
        if second:
            pairs.append((number[first] * len(words) + number[second], index))
        else:
            single[number[first]] = index
    keys, indices = (np.array([p[i] for p in sorted(pairs)], dtype=np.int64) for i in range(2))
    return words, single, keys, indices, idf


def _entries_of_words(rows: list, stop_words: Sequence[str], carry: int) -> Callable:
    """For ``mapInArrow`` over (id, carried columns, words): the weights of each row's terms before the norm."""
    words, single, keys, indices, idf = _vocabulary_lookup(rows)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, stopped = pa.array(words, pa.string()), pa.array(list(stop_words), pa.string())
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                lists = batch.column(carry + 1)
                owner = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
                flat = lists.flatten()
                if len(stopped):
                    kept = np.asarray(pc.invert(pc.is_in(flat, stopped)))
                    owner, flat = owner[kept], flat.filter(pa.array(kept))
                code = np.asarray(pc.fill_null(pc.index_in(flat, known), -1)).astype(np.int64)
                term = single[code]  # the last place is that of unknown words
                found = [owner[term >= 0] * len(idf) + term[term >= 0]]
                if len(keys) and len(code) > 1:
                    beside = (owner[1:] == owner[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0)
                    key = code[:-1][beside] * len(words) + code[1:][beside]
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    hit = keys[at] == key
                    found.append(owner[1:][beside][hit] * len(idf) + indices[at[hit]])
                cell, count = np.unique(np.concatenate(found), return_counts=True)
                row, index = np.divmod(cell, max(len(idf), 1))
                weight = (1.0 + np.log(count)) * idf[index]
                offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
                entry = pa.StructArray.from_arrays([pa.array(index.astype(np.int32)), pa.array(weight)], ["index", "weight"])
                square = np.bincount(row, weights=weight * weight, minlength=batch.num_rows).astype(float)  # of integers if there is no row
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), entry), pa.array(square)],
                    [*batch.schema.names[:-1], "_v", "_square"],
                )

    return entries


def transform(docs: DataFrame, model: TfidfModel, carry: Sequence[str] = (), in_rows: bool = True) -> DataFrame:
    """(id, text) to unit vectors (id, indices, weights), sorted by index; a text without known terms is empty.

    Columns in ``carry`` depend on the id and stay, which spares a join back to the input. Rows of one id make one vector.
    With a small vocabulary the terms are looked up inside the row, so finished entries are shuffled, once per text;
    otherwise, or without ``in_rows``, entries are joined and grouped.
    """
    if in_rows and model.size <= SMALL_VOCABULARY:
        worded = docs.select("id", *carry, tx.words(F.col("text")).alias("_w"))
        schema = T.StructType([*worded.schema.fields[:-1], T.StructField("_v", _ENTRIES), T.StructField("_square", T.DoubleType())])
        vocabulary = model.vocabulary.select("term", "index", "idf").collect()  # SMALL_VOCABULARY rows at most
        found = worded.mapInArrow(_entries_of_words(vocabulary, model.params.stop_words, len(carry)), schema)
        packed = found.groupBy("id", *carry).agg(F.collect_list("_v").alias("_all"), F.sqrt(F.sum("_square")).alias("_norm"))
        single = F.size("_all") == 1
        packed = packed.withColumn("_v", F.when(single, F.get("_all", F.lit(0))).otherwise(F.sort_array(F.flatten("_all"))))
    else:
        entry = F.when(F.col("index").isNotNull(), F.struct("index", "weight"))
        # The norm is an aggregate of its own: inside the lambda below it would be computed once per entry.
        packed = raw_weights(docs, model, carry).groupBy("id", *carry).agg(
            F.sort_array(F.collect_list(entry)).alias("_v"),
            F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"),
        )
    return packed.select(
        "id",
        *carry,
        F.transform("_v", lambda e: e["index"]).alias("indices"),
        F.transform("_v", lambda e: e["weight"] / F.col("_norm")).alias("weights"),
    )


def postings(vectors: DataFrame, model: TfidfModel) -> DataFrame:
    """Vectors as (id, term, weight) rows."""
    entries = vectors.select("id", F.explode(F.arrays_zip("indices", "weights")).alias("_e"))
    terms = model.vocabulary.select(F.col("index").alias("indices"), "term")
    flat = entries.select("id", F.col("_e.indices").alias("indices"), F.col("_e.weights").alias("weight"))
    if model.size <= SMALL_VOCABULARY:
        terms = F.broadcast(terms)
    return flat.join(terms, "indices").select("id", "term", "weight")


def _sums(vectors: DataFrame, *by: str) -> DataFrame:
    """The summed weight per term index, and per column of ``by``."""
    entries = vectors.select(*by, F.explode(F.arrays_zip("indices", "weights")).alias("_e"))
    flat = entries.select(*by, F.col("_e.indices").alias("indices"), F.col("_e.weights").alias("weight"))
    return flat.groupBy(*by, "indices").agg(F.sum("weight").alias("_sum"))


def _named(sums: DataFrame, model: TfidfModel) -> DataFrame:
    terms = model.vocabulary.select(F.col("index").alias("indices"), "term")
    return sums.join(F.broadcast(terms) if model.size <= SMALL_VOCABULARY else terms, "indices").drop("indices")


def group_sums(vectors: DataFrame, model: TfidfModel, by: str) -> DataFrame:
    """(by, term, _sum): the summed weight of each term per group."""
    return _named(_sums(vectors, by), model)


def keyword_scores(vectors: DataFrame, model: TfidfModel) -> DataFrame:
    """(term, tfidf_score): the mean weight of each term over all texts, zeros included."""
    sums = _named(_sums(vectors), model)
    return sums.select("term", (F.col("_sum") / F.lit(float(model.documents))).alias("tfidf_score"))


def to_ml_vectors(vectors: DataFrame, size: int) -> DataFrame:
    """Add the sparse ML vector column ``features``; there is no built-in constructor for it."""

    def sparse(indices, weights):
        return Vectors.sparse(size, indices, weights)

    build = F.udf(sparse, VectorUDT(), useArrow=True)
    return vectors.withColumn("features", build("indices", "weights"))


def fit_transform(docs: DataFrame, params: TfidfParams = TfidfParams()) -> tuple[TfidfModel, DataFrame]:
    model = fit(docs, params)
    return model, transform(docs, model)


def document_text(df: DataFrame, id_column: str, text: Column | str) -> DataFrame:
    """(id, text) as the functions of this module take it."""
    return df.select(F.col(id_column).alias("id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
