"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Rotations are learned on a bounded sample (iterative quantisation: alternate between the signs of the rotated vectors
and the rotation that fits them best, by a singular value decomposition). Every vector gets a code of ``bits`` signs.
The code is split into substrings and each substring is indexed. If two codes differ in at most R bits, some substring
differs in at most R / (number of substrings) bits; so probing every substring's index within that distance finds every
code within R. Those are reranked by the inner product of the original vectors in double precision.

Inner products become angles by one more component that brings all vectors to the same length. R is learned too: the
``recall`` quantile of the code distances between sampled vectors and their nearest sampled neighbours, as many as make
up the same share of the sample as the wanted number does of all rows. A query that finds too few neighbours within R
is searched again without a limit, so it gets its number.

Spark deals the vectors out in blocks and joins each block with blocks of the queries; a block's index lives in its
task. No vector, however often it occurs, makes a larger block. The queries are a stated set, given by the caller.

Defined results: vectors that are null, zero, hold a null or a non-finite component, or are not as long as most take no
part, nor do rows with a null id; rows that share an id count once, with the smallest of their vectors; equal scores
go to the smaller id; with fewer candidates than wanted all are given; an empty table gives an empty one; only the
named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from caseweave.session import stored

SUBSTRING = 16
VECTOR_BLOCK, QUERY_BLOCK = 4096, 1024
NEIGHBOURS = "query_id long, vec_id long, score double"


@dataclass
class Codes:
    """The learned rotations (one column per bit), the length that all vectors are brought to, and the radius."""

    rotation: np.ndarray
    length: float
    radius: int

    def of(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """Signs of the rotated vectors, packed to 16-bit substrings."""
        square = (vectors**2).sum(axis=1)
        more = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(self.length**2 - square, 0))
        signs = np.hstack([vectors, more[:, None]]) @ self.rotation > 0
        return np.packbits(signs, axis=1).view(np.uint16)


def popcounts() -> np.ndarray:
    return np.array([bin(i).count("1") for i in range(1 << SUBSTRING)], np.uint8)


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes.view(np.uint64) ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)


def learn(sample: np.ndarray, n_rows: int, length: float, k: int, bits: int, recall: float, seed: int = 7) -> Codes:
    """Rotations and radius from the sampled vectors."""
    random = np.random.default_rng(seed)
    more = np.sqrt(np.maximum(length**2 - (sample**2).sum(axis=1), 0))
    x = np.hstack([sample, more[:, None]])
    size, parts = x.shape[1], []
    while sum(p.shape[1] for p in parts) < bits:
        rotation = np.linalg.qr(random.normal(size=(size, size)))[0]
        for _ in range(20):
            signs = np.where(x @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(x.T @ signs)
            rotation = u @ v
        parts.append(rotation)
    codes = Codes(np.hstack(parts)[:, :bits], length, bits)
    chosen = random.permutation(len(sample))[:512]
    scores = sample[chosen] @ sample.T
    scores[np.arange(len(chosen)), chosen] = -np.inf
    near = min(max(1, round(k * len(sample) / max(n_rows, 1))), len(sample) - 1)
    if near < 1:
        return codes
    own, asked = codes.of(sample), codes.of(sample[chosen], queries=True)
    found = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    apart = np.concatenate([distances(own[f], a) for f, a in zip(found, asked, strict=True)])
    codes.radius = int(np.quantile(apart, recall, method="higher"))
    return codes


class Index:
    """The substring indexes of one block of vectors."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.bits = codes, popcounts()
        self.parts = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, starts = np.unique(column[order], return_index=True)
            self.parts.append((order, values, np.append(starts, len(order))))

    def within(self, code: np.ndarray, radius: int, masks: np.ndarray) -> np.ndarray:
        """Rows whose code differs in at most ``radius`` bits. ``masks``: all differences of a substring to probe."""
        if radius >= len(code) * SUBSTRING:
            return np.arange(len(self.codes))
        near = radius // len(code)
        hit = np.zeros(len(self.codes), bool)
        for value, (order, values, starts) in zip(code, self.parts, strict=True):
            if len(masks) < len(values):  # look the probed values up
                probes = value ^ masks
                place = np.minimum(np.searchsorted(values, probes), len(values) - 1)
                place = place[values[place] == probes]
            else:  # fewer values than probes: test each value
                place = np.flatnonzero(self.bits[values ^ value] <= near)
            sizes = starts[place + 1] - starts[place]
            steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit[order[np.repeat(starts[place], sizes) + steps]] = True
        rows = np.flatnonzero(hit)
        return rows[distances(self.codes[rows], code) <= radius]


def probe_masks(radius: int, parts: int, most: int = VECTOR_BLOCK) -> np.ndarray:
    """All differences of a substring within the pigeonhole distance; none listed when there are more than ``most``."""
    masks: list[int] = []
    for n in range(radius // parts + 1):
        for bits in combinations(range(SUBSTRING), n):
            masks.append(sum(1 << b for b in bits))
            if len(masks) > most:
                return np.zeros(most + 1, np.uint16)  # more than any block has values
    return np.array(masks, np.uint16)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``vector`` (double) of the rows that take part, written to the shared folder."""
    def sound(v: Column) -> Column:
        return F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = stored(rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(sound(F.col("vector"))), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    kept = rows.where(F.size("vector") == (sizes["n"] if sizes else 0))
    return stored(kept.groupBy("vec_id").agg(F.min("vector").alias("vector")), "unique-vectors")


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    bits: int = 256, sampled: int = 8192, recall: float = 0.985,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each query the ``k`` largest inner products found.

    ``is_query`` is a condition on ``vec_id``.
    """
    rows = usable(vectors, id_col, vector_col)
    n, length = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))).first()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sampled).collect()])
    codes = learn(sample, n, length, k, bits, recall)
    queries = rows.where(is_query)
    found = stored(nearest(search_blocks(rows, n, queries, codes, k), k), "neighbours")
    enough = min(k, n - 1)
    served = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= enough)
    few = stored(queries.join(served, queries["vec_id"] == served["query_id"], "left_anti"), "short-queries")
    if enough and few.take(1):
        rest = nearest(search_blocks(rows, n, few, Codes(codes.rotation, codes.length, bits), k), k)
        found = found.join(few.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", "rank", "vec_id", "score")


def nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_blocks(rows: DataFrame, n: int, queries: DataFrame, codes: Codes, k: int) -> DataFrame:
    """The ``k`` best of each block of vectors for each query."""
    n_blocks = -(-n // VECTOR_BLOCK)
    n_query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(n_query_blocks)).cast("int")
    dealt = rows.withColumn("block", block).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))))
    asked = queries.withColumn("query_block", query_block).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, column = table["vec_id"].to_numpy(), table["vector"].combine_chunks()
        return ids, column.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)

    def find(own: pa.Table, asking: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not own.num_rows or not asking.num_rows:
            return schema.empty_table()
        ids, vectors = matrix(own)
        query_ids, query_vectors = matrix(asking)
        index = Index(codes.of(vectors))
        masks = probe_masks(codes.radius, codes.rotation.shape[1] // SUBSTRING)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for query, vector, code in zip(query_ids, query_vectors, codes.of(query_vectors, queries=True), strict=True):
            near = index.within(code, codes.radius, masks)
            near = near[ids[near] != query]
            score = (vectors[near] * vector).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            out.append((np.full(len(best), query), ids[near[best]], score[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)

    return dealt.groupBy("block", "query_block").cogroup(asked.groupBy("block", "query_block")).applyInArrow(find, NEIGHBOURS)
