"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest.

A text is split by the tokenizer's pattern. Each distinct pre-token of a slice of rows is looked up in a minimal
perfect hash of the vocabulary (all at once, in arrays); what is not in the vocabulary is merged pair by pair, lowest
rank first and leftmost among equals, with a heap over a doubly linked list of its bytes, or in a plain list of its
pairs if it has at most ``SHORT`` bytes. A bounded memo keeps the ids of short stretches of text (a word with its white
space) between slices.

Defined results: a null text is an empty one and has no ids; rows that repeat are each encoded; a text or pre-token of
any length is encoded whole (the heap needs n log n steps); an empty table gives an empty one. Only the named columns
are read and all columns of the input are carried along by :func:`with_ids` under their own names.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, types as T

from caseweave.llm.files import open_file
from caseweave.llm.memo import Memo

MEMO_TOKENS, MEMO_LENGTH, SLICE_CHARS = 350_000, 48, 2_000_000
SHORT, NO_RANK = 32, sys.maxsize
# White space as the Unicode property; the regex library's own \s also holds the four separators U+001C to U+001F.
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NO_SPACE = SPACE.replace("[", "[^", 1)


class PerfectHash:
    """Minimal perfect hash by levels of bit tables: a key's number is the rank of its bit.

    On each level the keys that share a slot with no other set their slot's bit, the others go on to the next level.
    Numbers run from 0 to n-1 without gaps; a foreign key may get any number, so the caller compares the key itself.
    """

    MIX, LOAD = np.uint64(0x9E3779B97F4A7C15), 1.5

    def __init__(self, hashes: np.ndarray):
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys share a 64-bit hash")
        self.levels, self.size, rest = [], 0, hashes
        while len(rest):
            slots = self._slot(rest, len(self.levels), width := max(1, int(len(rest) * self.LOAD)))
            bits = np.bincount(slots, minlength=width) == 1
            ranks = np.cumsum(bits) - 1 + self.size
            self.levels.append((width, bits, ranks))
            self.size += int(bits.sum())
            rest = rest[~bits[slots]]

    def _slot(self, hashes: np.ndarray, level: int, width: int) -> np.ndarray:
        x = (hashes ^ (hashes >> np.uint64(29))) * np.uint64((int(self.MIX) * (2 * level + 1)) % 2**64)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(width)).astype(np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each key, -1 where no level has a bit."""
        found, rest = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, (width, bits, ranks) in enumerate(self.levels):
            slots = self._slot(hashes[rest], level, width)
            hit = bits[slots]
            found[rest[hit]] = ranks[slots[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return found


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a rank file with a base64 token and a number per line."""
    with open_file(path) as source:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, source.read().splitlines()) if a}


def token_table(ranks: dict[bytes, int]) -> pa.Array:
    """Token bytes by rank, null where no token has the rank."""
    names = {rank: token for token, rank in ranks.items()}
    return pa.array([names.get(i) for i in range(max(names) + 1)], pa.binary())


@cache
def _table_of(path: str) -> pa.Array:
    """The token table of a rank file, kept for the worker's next tasks: decoding needs nothing else of an encoder."""
    return token_table(read_ranks(path))


def bytes_of(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The bytes of each list of ids; of a null none."""
    taken = tokens.take(ids.flatten())
    offsets = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths().fill_null(0)))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), taken), b"")


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank is joined first, the leftmost among equals."""
    n, get = len(piece), ranks.get
    if n <= SHORT:
        return _merge_short(piece, ranks)
    shift = n.bit_length()
    low = (1 << shift) - 1
    end = list(range(1, n + 1))  # where the part that begins at i ends, 0 once it is joined to its left neighbour
    before = list(range(-1, n - 1))  # where the part left of i begins
    # An entry is one number: the rank, where the pair begins, where it ends.
    heap = [(rank << shift | i) << shift | i + 2 for i in range(n - 1) if (rank := get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        left, stop = entry >> shift & low, entry & low
        right = end[left]
        if not right or right >= n or end[right] != stop:
            continue  # one of the two has changed since
        end[left], end[right] = stop, 0
        if stop < n:
            before[stop] = left
            if (rank := get(piece[left : end[stop]])) is not None:
                push(heap, (rank << shift | left) << shift | end[stop])
        if left and (rank := get(piece[(first := before[left]) : stop])) is not None:
            push(heap, (rank << shift | first) << shift | stop)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for few bytes: the least of a list of pairs is found faster than a heap is kept."""
    get, n = ranks.get, len(piece)
    pairs = [get(piece[i : i + 2], NO_RANK) for i in range(n - 1)]
    at = list(range(n + 1))  # where the parts begin, and the end
    while pairs and (least := min(pairs)) != NO_RANK:
        i = pairs.index(least)
        del at[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(piece[at[i] : at[i + 2]], NO_RANK)
        if i:
            pairs[i - 1] = get(piece[at[i - 1] : at[i + 1]], NO_RANK)
    return [ranks[piece[start:stop]] for start, stop in pairwise(at)]


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Bpe:
    """Encoder and decoder of one rank file."""

    _loaded: dict[tuple[str, str], Bpe] = {}

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        tokens = list(self.ranks)
        self.pattern = regex.compile(pattern.replace(r"[^\s", "[^" + SPACE[1:-1]).replace(r"\S", NO_SPACE).replace(r"\s", SPACE))
        # Two white-space characters in a row of which the last is a space, or a space at the end: cut with the pattern.
        self.odd_space = [c + " " for c in map(chr, range(0x3001)) if re.match(SPACE, c)]
        self.cut = regex.compile(f"{SPACE}*{NO_SPACE}+|{SPACE}+")
        # A space and lower-case ASCII letters are one pre-token of most patterns; this one is asked.
        probes = [" " + letters for letters in ("abcdefghijklmnopqrstuvwxyz", "s", "ll", "zz")]
        simple = all(self.pattern.findall(probe) == [probe] for probe in probes)
        self.whole = re.compile(" [a-z]+" if simple else r"(?!)").fullmatch
        hashes = self._hash(tokens)
        self.perfect = PerfectHash(hashes)
        numbers = self.perfect(hashes)
        self.keys, self.packed = [b""] * len(tokens), [b""] * len(tokens)
        for number, token in zip(numbers.tolist(), tokens, strict=True):
            self.keys[number], self.packed[number] = token, self.ranks[token].to_bytes(4, "little")
        self.tokens = token_table(self.ranks)
        self.forget()

    def forget(self) -> None:
        """Start with empty memos."""
        self.memo = Memo(self._resolve, MEMO_TOKENS, MEMO_LENGTH)
        self.pieces = Memo(self._ids, MEMO_TOKENS, MEMO_LENGTH)

    @classmethod
    def of(cls, path: str, pattern: str) -> Bpe:
        """The worker's own instance, kept for its next tasks."""
        if (path, pattern) not in cls._loaded:
            cls._loaded[path, pattern] = cls(path, pattern)
        return cls._loaded[path, pattern]

    @staticmethod
    def _hash(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _resolve(self, segments: list[str]) -> list[bytes]:
        """Ids of distinct stretches of text as packed 32-bit integers."""
        whole, split = self.whole, self.pattern.findall
        return self.pieces.joined([[segment] if whole(segment) else split(segment) for segment in segments])

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens: by the perfect hash, or merged."""
        keys = [piece.encode() for piece in pieces]
        packed, own, ranks = self.packed, self.keys, self.ranks
        return [
            packed[number] if number >= 0 and own[number] == key else packed_ids(merge(key, ranks))
            for key, number in zip(keys, self.perfect(self._hash(keys)).tolist(), strict=True)
        ]

    def _segments(self, text: str) -> list[str]:
        """``text`` cut before runs of white space: no pre-token of the pattern crosses such a place."""
        if text.endswith(" ") or any(pair in text for pair in self.odd_space):
            return self.cut.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + word for word in rest]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as packed little-endian 32-bit integers."""
        return self.memo.joined([self._segments(text or "") for text in texts])

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; of a null none."""
        return bytes_of(ids, self.tokens)


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows with about SLICE_CHARS characters; a longer row is a run of its own."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE_CHARS:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def with_ids(
    docs: DataFrame, ranks: str, pattern: str, text_col: str = "text", ids_col: str = "ids", lasting: bool = True
) -> DataFrame:
    """All columns of ``docs`` and the ids of its texts as an array.

    A worker keeps its memos for its next tasks; without ``lasting`` they go with the task, so that a worker that waits
    for another stage's tasks, or for those that decode, holds none.
    """
    at = docs.columns.index(text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.of(ranks, pattern)
        try:
            for batch in batches:
                texts = batch.column(at)
                for start, stop in slices(pc.utf8_length(texts).fill_null(0).to_pylist()):
                    packed = bpe.encode(texts.slice(start, stop - start).to_pylist())
                    offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
                    values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                    ids = pa.ListArray.from_arrays(pa.array(offsets), values)
                    kept = batch.slice(start, stop - start)
                    yield pa.RecordBatch.from_arrays([*kept.columns, ids], [*batch.schema.names, ids_col])
        finally:
            if not lasting:
                bpe.forget()

    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(encode, schema)


def with_bytes(encoded: DataFrame, ranks: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the bytes that its ids stand for."""
    at = encoded.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _table_of(ranks)
        for batch in batches:
            for start, stop in slices(batch.column(at).value_lengths().fill_null(0).to_pylist()):
                kept = batch.slice(start, stop - start)
                out = bytes_of(kept.column(at), tokens)
                yield pa.RecordBatch.from_arrays([*kept.columns, out], [*batch.schema.names, out_col])

    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())])
    return encoded.mapInArrow(decode, schema)
