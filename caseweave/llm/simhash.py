"""SimHash near duplicates: fingerprints within a Hamming radius are linked, found by pigeonhole blocks.

A fingerprint has 64 bits; bit ``b`` is 1 if it is 1 in over half of the XXH64 hashes of the text's word shingles. Equal
fingerprints are one node. Two fingerprints that differ in at most ``RADIUS`` bits are equal in one of ``RADIUS + 1``
blocks, so every fingerprint is dealt to one bucket per block, by the block's number and bits. A bucket of up to ``BUCKET``
fingerprints is verified in a task, in arrays: differing bits are counted, and the links are folded to a spanning forest
before they leave the task, so ``k`` linked fingerprints make at most ``k - 1`` edges.

A larger bucket is split once more by the same rule: its fingerprints agree in the bits used so far and may differ in the
others, which are cut into ``RADIUS + 1`` blocks again. Every step takes a quarter of the open bits, so the fingerprints
of a bucket have ever more bits in common, and after a few steps 2**(open bits) bounds a bucket whatever the data hold.
No pair is lost, no bucket is gathered above its bound, and no pair of fingerprints is ever a row.

Which buckets are large is counted with partial sums. Their list is broadcast while it is short; if it is long, all buckets
are split, which gives the same links.

Defined results: a null or empty text and one of white space have fingerprint zero and are linked like any other; a text
of fewer words than a shingle is hashed as one; rows that share an id are each answered; a row with a null id is linked
but never names a component (a component without any id has a null one); an empty table gives an empty one; only the id
and text columns are read. A text is taken whole in pieces of about ``PIECE`` bytes, so memory does not grow with it
beyond the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from caseweave.llm.components import components
from caseweave.llm.hot import looked_up
from caseweave.session import stored

WORDS, SEED, RADIUS = 3, 42, 3
PIECE = 1 << 20
BUCKET = 4096
BROADCAST_ROWS = 500_000
SPACE = re.compile(rb"[ \t-\r]")


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``size`` bytes."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + size)
        stop = cut.start() if cut else len(text)
        yield text[at:stop].split()
        at = stop


def shingle_hashes(text: bytes, n: int = WORDS, size: int = PIECE) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, repeats included, as arrays."""
    digest, carried, whole = xxhash.xxh64_intdigest, [], False
    for words in pieces(text.lower(), size):  # bytes.lower: A-Z only
        words = carried + words
        if len(words) >= n:
            whole = True
            joined = b" ".join(words)
            ends = np.cumsum([len(word) + 1 for word in words])
            starts = [0, *ends[: len(words) - n].tolist()]
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[n - 1 :] - 1).tolist(), strict=True)], np.uint64)
        carried = words[max(0, len(words) - n + 1) :]
    if carried and not whole:
        yield np.array([digest(b" ".join(carried), SEED)], np.uint64)


def fingerprint(text: bytes, n: int = WORDS, size: int = PIECE) -> int:
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, n, size):
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``doc_id`` and ``node``, the fingerprint as a signed number."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint((text.as_py() or "").encode(), n) for text in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "node"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(walk, "doc_id long, node long")


def blocks_of(bits: list[int]) -> list[list[int]]:
    """The bits dealt to ``RADIUS + 1`` blocks in order, of sizes as equal as can be."""
    edges = [len(bits) * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [bits[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def mask_of(bits: list[int]) -> int:
    """The bits as a signed mask."""
    mask = sum(1 << bit for bit in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def levels(bucket: int = BUCKET) -> list[list[list[int]]]:
    """For each level the sets of bits in which the fingerprints of a bucket agree, until the other bits bound a bucket by
    ``bucket``, or by ``BUCKET`` if that is more."""
    found, chosen = [], [[]]
    while not found or 1 << (64 - min(len(c) for c in chosen)) > bucket and len(chosen) < BUCKET:
        chosen = [own + block for own in chosen for block in blocks_of([b for b in range(64) if b not in own])]
        found.append(chosen)
    return found


def dealt(rows: DataFrame, masks: list[list[int]], first: Column, last: Column) -> DataFrame:
    """Each row's ``node`` in the buckets of the places from ``first`` to ``last``: ``place``, ``bits``, ``node``."""
    values = F.array(*[F.lit(mask_of(bits)) for bits in masks])
    placed = rows.select("node", F.explode(F.sequence(first, last)).alias("place"))
    return placed.select("place", F.col("node").bitwiseAND(F.get(values, "place")).alias("bits"), "node")


def spanning(keys: np.ndarray, nodes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the nodes of each key that links of the radius join; rows are in order of their keys."""
    label = np.arange(len(nodes))
    last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))
    room = np.repeat(last, np.diff(np.append(-1, last))) - label  # rows of the same key that follow
    for ahead in range(1, int(room.max(initial=0)) + 1):
        own = np.flatnonzero(room >= ahead)
        near = own[np.bitwise_count(nodes[own] ^ nodes[own + ahead]) <= radius]
        a, b = near, near + ahead
        while len(a):
            one, two = label[a], label[b]
            apart = one != two
            a, b, one, two = a[apart], b[apart], one[apart], two[apart]
            np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def verified(buckets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The edges ``a``, ``b`` of all buckets (``place``, ``bits``, ``node``), each small."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_keys, open_nodes = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)
        for batch in chain(batches, [None]):
            if batch is not None:
                keys = np.stack([batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy()], axis=1)
                open_keys = np.concatenate([open_keys, keys])
                open_nodes = np.concatenate([open_nodes, batch.column(2).to_numpy().view(np.uint64)])
            if not len(open_keys):
                continue
            fresh = np.append(True, (open_keys[1:] != open_keys[:-1]).any(axis=1))
            # The last bucket may go on in the next batch.
            stop = len(open_keys) if batch is None else int(np.flatnonzero(fresh)[-1])
            a, b = spanning(np.cumsum(fresh)[:stop], open_nodes[:stop], radius)
            open_keys, open_nodes = open_keys[stop:], open_nodes[stop:]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    ordered = buckets.select("place", "bits", "node").repartition("place", "bits").sortWithinPartitions("place", "bits")
    return ordered.mapInArrow(walk, "a long, b long")


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a``, ``b`` whose components are those of all pairs of ``nodes`` within the radius."""
    parts, parent = [], None  # ``parent``: members of the buckets to be split; at first all nodes
    ladder = levels(bucket)
    for level, masks in enumerate(ladder):
        if parent is None:
            buckets = dealt(nodes, masks, F.lit(0), F.lit(len(masks) - 1))
        else:
            inner = F.col("place") * (RADIUS + 1)
            buckets = dealt(parent, masks, inner, inner + RADIUS)
        if level == len(ladder) - 1:
            parts.append(verified(buckets))
            break
        large = stored(buckets.groupBy("place", "bits").count().where(F.col("count") > bucket).drop("count"), "large-buckets")
        n_large = large.count()
        if not n_large:
            parts.append(verified(buckets))
            break
        if n_large > BROADCAST_ROWS:  # all are split
            parent = None if parent is None else stored(buckets, "members")
            continue
        parts.append(verified(buckets.join(F.broadcast(large), ["place", "bits"], "left_anti")))
        parent = stored(buckets.join(F.broadcast(large), ["place", "bits"], "left_semi"), "members")
    return stored(reduce(DataFrame.unionByName, parts), "links")


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` (the smallest id that links lead to)."""
    rows = stored(fingerprints(docs, id_col, text_col, n), "fingerprints")
    nodes = stored(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    labels = components(links(nodes.select("node"), bucket))
    labelled = stored(
        nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled"
    )
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n_nodes"))
    named = looked_up(labelled, smallest, "label", "n_nodes", labelled.count())
    return looked_up(rows, named.select("node", "n", "component_id"), "node", "n", rows.count()).select(
        "doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id"
    )
