"""Periodic runs of words, by a suffix automaton whose suffix-link paths are recoloured by last occurrence.

Words are appended one by one. A state of the automaton stands for the substrings with one set of end positions; its
suffix links lead to ever shorter suffixes, so the path from the state of the whole prefix to the root holds all suffixes
of the prefix. Appending a word *accesses* that path: all of it takes the new end position as colour. What had one colour
before is a segment of the path: the suffixes of one range of lengths whose last occurrence ended at one place. If that
place is ``d`` words back and the longest suffix of the segment has ``d`` words or more, a square of period ``d`` ends
here; it starts where that suffix first occurs, and is extended to the right as long as words ``d`` apart are equal.

As in a link-cut tree, a path is kept as segments and an access cuts one segment after the other. A segment needs no tree
here: it lies on the path of its own colour's prefix and only ever loses its upper end, so it is a colour with the length
below which it has been cut off, and the colour that cut it. The colour of a state is found by following those cuts.

Only stretches that can hold a run are appended. A run of 24 words or more whose length is three periods or more holds a
window of 16 words that occurs again one period later, and such windows cover it; so the rest of a text is passed over.

Defined results: a null or empty text and one of white space have no words and no runs; a row with a null id is never
rewritten; rows that repeat are each answered; of runs with the same greatest exponent the one with the smallest start,
then period, is reported; an empty table gives an empty one; only the id and text columns are read. A text is taken whole,
whatever its length: a task holds the words of one text (and of a batch of short ones), and some 400 bytes for each word
of the stretch that it is in.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAST, TIMES = 24, 3  # a run has so many words, and so many periods, at least
WINDOW = LEAST * (TIMES - 1) // TIMES  # words that surely recur one period later
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string"
)


def periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a row; a tenth of the rows, told by the checksum of their id, repeat their words from a place on."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    a = (h // 10) % n
    p = 1 + (n - a) // (3 + (h // 10) % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def stretches(words: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """The maximal ranges of words covered by windows that occur twice or more; every run lies inside one of them."""
    n = len(words) - window + 1
    if n < 2:
        return []
    # Hashes of windows of 2, 4, 8, ... words; equal windows have equal hashes, a false match costs time only.
    hashed, width = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1), 1
    while width < window:
        step = min(width, window - width)
        hashed = hashed[: len(hashed) - step] * np.uint64(0xD6E8FEB86659FD93) + hashed[step:]
        hashed ^= hashed >> np.uint64(29)
        width += step
    order = np.argsort(hashed, kind="stable")
    same = hashed[order[1:]] == hashed[order[:-1]]
    if not same.any():
        return []
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = np.flatnonzero(again)
    cut = np.flatnonzero(np.diff(at) > window)
    starts, ends = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + window
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def squares(words: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(start, end, period)``: for each run of two periods or more at least one repetition that starts where the run
    starts; ``end`` is the last word of one of its squares."""
    moves, length, link, hint = [{}], [0], [-1], [0]  # states; ``hint`` is a colour that the state has had
    low, cutter = [], []  # of each colour: its segment holds longer suffixes than this; the colour that cut it last
    last = 0
    for i, word in enumerate(words):
        # The state of the whole prefix.
        new = len(moves)
        moves.append({})
        length.append(i + 1)
        link.append(0)
        hint.append(i)
        p = last
        while p >= 0 and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        if p >= 0:
            q = moves[p][word]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(moves[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                hint.append(hint[q])
                while p >= 0 and moves[p].get(word) == q:
                    moves[p][word] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
        # The access: segment after segment up to the root takes the colour i.
        low.append(0)
        cutter.append(-1)
        state = link[new]
        at, colour = length[state], hint[state]
        hint[state] = i
        while at:
            while low[colour] >= at:
                colour = cutter[colour]
            if i - colour <= at:
                yield colour - at + 1, i, i - colour
            upper, above = low[colour], cutter[colour]
            low[colour], cutter[colour] = at, i
            at, colour = upper, above


def runs(words: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the maximal runs of ``least`` words and ``times`` periods or more, in order."""
    known, found, n = {}, [], len(words)
    for start, end, period in squares(words):
        if known.get(period, -1) >= end:  # inside a run that has been extended already
            continue
        stop = end + 1
        while stop < n and words[stop] == words[stop - period]:
            stop += 1
        known[period] = stop - 1
        if stop - start >= max(least, times * period):
            found.append((start, stop - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def summary(words: list[bytes]) -> tuple:
    """The columns of a row, from its words."""
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(word, len(numbers)) for word in words]
    found = []
    for first, stop in stretches(np.array(ids, np.int64)):
        found += [(first + start, size, period) for start, size, period in runs(ids[first:stop])]
    if not found:
        return 0, None, None, None, None, b"", words
    best = found[0]
    for run in found[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, size, period in found:
        dropped[start + period] += 1
        dropped[start + size] -= 1
    keep = (np.cumsum(dropped[:-1]) == 0).tolist()
    listed = "".join(f"{start},{size},{period}\n" for start, size, period in found).encode()
    kept = [word for word, own in zip(words, keep, strict=True) if own]
    return len(found), best[0], best[1], best[2], 1000 * best[1] // best[2], listed, kept


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = True) -> DataFrame:
    """One row per row of ``docs``: its runs, the one of the greatest exponent, and digests of all runs and of the words
    that are left when every run is cut down to its first period. ``rewrite`` applies :func:`periodic` first."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode().split()  # bytes split at the six ASCII white-space characters
                *columns, listed, kept = summary(periodic(words, doc_id) if rewrite else words)
                rows.append((doc_id, *columns, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if i < 6 else pa.string()) for i, c in enumerate(zip(*rows, strict=True))],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            ) if rows else pa.RecordBatch.from_arrays(
                [pa.array([], pa.int64() if i < 6 else pa.string()) for i in range(8)],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(walk, RESULT)
