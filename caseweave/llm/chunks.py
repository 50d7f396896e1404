"""Repeated passages by content-defined chunking with a gear rolling hash.

A text's bytes are hashed with a gear hash (``h = 2h + gear[byte]`` modulo 2**16, so it depends on the last 16 bytes).
A chunk ends where the hash is the smallest within ``REACH`` bytes on both sides, moved on to the next white space, or
to the next start of a character if no white space follows within ``NEAR`` bytes (as in Chinese, Japanese or Thai). Both rules look at nearby bytes only, so an insertion moves the cuts around it and no others, and a passage is cut in
the same way wherever it stands. Chunks have about 35 bytes; one without minimum is cut at ``MOST``.

A chunk is repeated when its digest occurs in two or more documents. Single chunks repeat by chance, so only a run of
repeated chunks with ``min_words`` words or more, or with ``min_bytes`` bytes or more that are not white space, counts as
a passage; the latter is for text that does not put white space between words. The document with the smallest id that holds a
chunk owns it and keeps it; the others lose it if they are rewritten and half as many words or bytes in a row are not theirs,
so that an owner does not lose a few words of its passage which an earlier document holds by chance. A passage of over 50 words holds a run of at
least 22 whatever its surroundings, but for a few bytes' luck: the first and last cut inside it lie within two chunks
of its ends.

Per digest Spark keeps the smallest and largest document id (summed before the shuffle), so a passage that a third
of all documents share is one small row; its chunks are joined to that row and adaptive execution can split them. No
pairs of documents are made.

Defined results: a null or empty text has no chunks and stays as it is; rows that share an id (all rows with a null id
likewise, which counts as larger than any other) are one document: what only they share is not repeated; rows that
repeat each get their passages; an empty table gives an empty one; columns of the input may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from caseweave.llm.byte_bpe import slices
from caseweave.session import stored

REACH, MOST, PAD = 16, 512, 64
NO_ID = (1 << 63) - 1
NEAR = 64
MIN_WORDS, MIN_BYTES = 22, 256
BROADCAST_ROWS = 100_000
CHUNKED = "doc_id long, text_digest binary, digests array<long>, sizes array<int>, words array<int>, blanks array<int>"


def gear_table() -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(bytes([b])) & 0xFFFF for b in range(256)], np.uint16)


def minima(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Where the gear hash is smaller than before and not larger than behind, within REACH bytes."""
    h = gear[data]
    for k in (1, 2, 4, 8):  # the sum over 16 bytes by doubling
        h[k:] += h[:-k] << np.uint16(k)
    low = h.copy()
    for k in (1, 2, 4, 8):  # the smallest of 16 values from each place on
        low[:-k] = np.minimum(low[:-k], low[k:])
    inner = h[REACH:-REACH]
    return np.flatnonzero((inner < low[: len(inner)]) & (inner <= low[REACH + 1 : REACH + 1 + len(inner)])) + REACH


class Chunker:
    """Cuts a slice of texts at once; a pad between texts keeps them apart."""

    def __init__(self):
        self.gear = gear_table()
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of chunks per text; digest, size and number of words of each chunk."""
        return self.measured(texts)[:4]

    def measured(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """The same, and the number of white-space bytes of each chunk."""
        pad = bytes(PAD)
        whole = pad + b"".join([text + pad for text in texts])
        data = np.frombuffer(whole, np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = PAD + np.cumsum(np.concatenate([[0], sizes[:-1] + PAD])) if len(texts) else sizes
        ends = starts + sizes
        spaces = np.flatnonzero(self.space[data])
        found = minima(data, self.gear)
        moved = np.searchsorted(spaces, found)
        cuts = np.append(spaces, len(data) + NEAR)[moved]
        cuts = np.where(cuts - found <= NEAR, cuts, self._characters(data, found, len(data)))
        owner = np.searchsorted(starts, cuts, "right") - 1
        same = owner == np.searchsorted(starts, found, "right") - 1  # the next white space may be in another text
        cuts = cuts[same & (owner >= 0) & (cuts > starts[owner]) & (cuts < ends[owner])]
        bounds = np.unique(np.concatenate([starts[sizes > 0], ends[sizes > 0], cuts]))
        owner = np.searchsorted(starts, bounds, "right") - 1
        # An empty text shares no place with another, as the pad lies between; the pads themselves are no chunks.
        long = np.flatnonzero((np.diff(bounds) > MOST) & (owner[:-1] == owner[1:]) & (bounds[:-1] < ends[owner[:-1]]))
        if len(long):
            more = [self._forced(data, bounds[i], bounds[i + 1]) for i in long]
            bounds = np.unique(np.concatenate([bounds, *more]))
        first, last = bounds[:-1], bounds[1:]
        owner = np.searchsorted(starts, first, "right") - 1
        real = (owner >= 0) & (last <= ends[owner])
        first, last, owner = first[real], last[real], owner[real]
        digests = np.fromiter(
            (xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)),
            np.uint64, len(first),
        ).view(np.int64)
        inside = ~self.space[data] & (data > 0)
        begins = np.concatenate([[0], np.cumsum(inside & ~np.concatenate([[False], inside[:-1]]))])
        before = np.concatenate([[0], np.cumsum(self.space[data])])
        counts = np.bincount(owner, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        return counts, digests, (last - first).astype(np.int32), (begins[last] - begins[first]).astype(np.int32), (
            before[last] - before[first]
        ).astype(np.int32)

    @staticmethod
    def _forced(data: np.ndarray, start: int, end: int) -> np.ndarray:
        """Cuts every MOST bytes, at the start of a character."""
        places = Chunker._characters(data, np.arange(start + MOST, end, MOST), end)
        return places[places < end]

    @staticmethod
    def _characters(data: np.ndarray, places: np.ndarray, end: int) -> np.ndarray:
        """The places, moved on to the next start of a character."""
        for _ in range(3):
            places = np.where((places < end) & ((data[np.minimum(places, end - 1)] & 0xC0) == 0x80), places + 1, places)
        return places


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document with its chunks as arrays, numbered by ``row_no``; written to the shared folder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = Chunker()
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for start, stop in slices([len(t) for t in texts]):
                part = texts[start:stop]
                counts, digests, sizes, words, blanks = chunker.measured(part)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array([hashlib.sha256(t).digest() for t in part], pa.binary()),
                        *[pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (digests, sizes, words, blanks)],
                    ],
                    ["doc_id", "text_digest", "digests", "sizes", "words", "blanks"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    numbered = rows.mapInArrow(cut, CHUNKED).withColumn("row_no", F.monotonically_increasing_id())
    return stored(numbered.where(F.size("digests") > 0), "chunks")


def passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES
) -> DataFrame:
    """A row per repeated passage: ``doc_id``, ``text_digest``, byte range ``start``..``stop``, ``n_words``,
    ``first_doc_id`` (the smallest id among the owners of its chunks) and ``lost``, the byte ranges that others own."""
    table = chunked(docs, id_col, text_col)
    key = F.coalesce("doc_id", F.lit(NO_ID))
    chunks = table.select("row_no", key.alias("own"), F.posexplode("digests").alias("at", "digest"))
    owners = chunks.groupBy("digest").agg(F.min("own").alias("first"), F.max("own").alias("last")).where("first < last")
    repeated = chunks.select("digest", "row_no", "at").join(owners.select("digest", "first"), "digest")
    flagged = repeated.groupBy("row_no").agg(F.sort_array(F.collect_list(F.struct("at", "first"))).alias("flags"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = NO_ID if row["doc_id"] is None else row["doc_id"]
                at = np.array([f["at"] for f in row["flags"]], np.int64)
                first = np.array([f["first"] for f in row["flags"]], np.int64)
                ends = np.cumsum(row["sizes"])
                sizes, words = np.array(row["sizes"]), np.array(row["words"])
                solid = sizes - np.array(row["blanks"])
                breaks = np.flatnonzero(np.diff(at) != 1) + 1
                for a, f in zip(np.split(at, breaks), np.split(first, breaks), strict=True):
                    if (n := int(words[a].sum())) < min_words and solid[a].sum() < min_bytes:
                        continue
                    lost = a[f != own]
                    stretches = np.split(lost, np.flatnonzero(np.diff(lost) != 1) + 1) if len(lost) else []
                    stretches = [s for s in stretches if words[s].sum() >= min_words // 2 or solid[s].sum() >= min_bytes // 2]
                    out.append({
                        "doc_id": row["doc_id"], "text_digest": row["text_digest"],
                        "start": int(ends[a[0]] - sizes[a[0]]), "stop": int(ends[a[-1]]), "n_words": n,
                        "first_doc_id": int(f.min()) if f.min() != NO_ID else None,
                        "lost": [{"start": int(ends[s[0]] - sizes[s[0]]), "stop": int(ends[s[-1]])} for s in stretches],
                    })
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("text_digest", pa.binary()), ("start", pa.int64()), ("stop", pa.int64()),
                        ("n_words", pa.int64()), ("first_doc_id", pa.int64()), ("lost", pa.list_(span))])
    joined = table.select("row_no", "doc_id", "text_digest", "sizes", "words", "blanks").join(flagged, "row_no").drop("row_no")
    return joined.mapInArrow(
        runs,
        "doc_id long, text_digest binary, start long, stop long, n_words long, first_doc_id long, "
        "lost array<struct<start: long, stop: long>>",
    )


def without(text: Column, lost: Column) -> Column:
    """The text without the byte ranges, which are in order and do not meet."""
    data = text.cast("binary")
    pieces = F.transform(
        lost,
        lambda s, i: F.substring(
            data, F.coalesce(F.get(lost, i - 1).stop, F.lit(0)).cast("int") + 1,
            (s.start - F.coalesce(F.get(lost, i - 1).stop, F.lit(0))).cast("int"),
        ),
    )
    rest = F.substring(data, F.element_at(lost, -1).stop.cast("int") + 1, F.octet_length(data))
    return F.concat(F.array_join(F.transform(pieces, lambda p: p.cast("string")), ""), rest.cast("string"))


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES
) -> DataFrame:
    """The documents without the passages that an earlier document owns; one of which no word is left goes."""
    found = passages(docs, id_col, text_col, min_words, min_bytes).where(F.size("lost") > 0)
    lost = stored(
        found.dropDuplicates(["doc_id", "text_digest", "start"]).groupBy("doc_id", "text_digest").agg(
            F.sort_array(F.flatten(F.collect_list("lost"))).alias("_lost")
        ).select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest"), "_lost"),
        "lost-passages",
    )
    lost = F.broadcast(lost) if lost.count() <= BROADCAST_ROWS else lost
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_own"), F.col(text_col).alias("_text"),
        F.unhex(F.sha2(F.col(text_col), 256)).alias("_sha"),
    )
    joined = rows.join(lost, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest")), "left")
    text = F.when(F.col("_lost").isNull(), F.col("_text")).otherwise(without(F.col("_text"), F.col("_lost")))
    kept = joined.select("_row", text.alias("_left"), "_lost").where(
        F.col("_lost").isNull() | F.col("_left").rlike(r"[^\x20\x09-\x0D]")
    )
    return kept.select(*[F.col("_left").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
