"""Scoring of one block of queries against one block of cases, on Arrow tables inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CELLS = 2_000_000  # score cells held at once
DENSE_SHARE, DENSE_TERMS = 128, 256  # a term with a product in more than one of so many cells is a dense column
SLACK = 1e-12  # of the rounding itself
EXPANSION = 4_000_000  # products formed at once
DECIMALS = 9  # scores are ranked at this precision, so that the order of summation cannot decide a tie

RESULT = "query_id long, case_id long, similarity double, intent_compatibility double, combined_score double"


def _ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and row lengths of a list column."""
    lists = pa.concat_arrays([c for c in column.chunks]) if column.num_chunks else pa.array([], column.type)
    lengths = np.asarray(lists.value_lengths().fill_null(0))
    return np.asarray(lists.flatten()), lengths


def _one_row(schema: pa.Schema, values: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


_QUERIES = pa.schema([("query_block", pa.int32()), ("query_ids", pa.list_(pa.int64())), *(
    (name, pa.binary()) for name in ("intents", "query_terms", "query_counts", "query_rows", "query_weights"))])
_CASES = pa.schema([("case_block", pa.int32()), ("case_ids", pa.list_(pa.int64())), *(
    (name, pa.binary()) for name in ("compatibility", "case_terms", "case_counts", "case_codes", "case_lengths", "case_weights"))])
PACKED_QUERIES = "query_block int, query_ids array<bigint>, " + ", ".join(f"{n} binary" for n in _QUERIES.names[2:])
PACKED_CASES = "case_block int, case_ids array<bigint>, " + ", ".join(f"{n} binary" for n in _CASES.names[2:])


def pack_queries(table: pa.Table) -> pa.Table:
    """A query block as one row: its vectors' entries in term order."""
    indices, lengths = _ragged(table["indices"])
    weights, _ = _ragged(table["weights"])
    order = np.argsort(indices, kind="stable")
    rows = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[order]
    terms, counts = np.unique(indices, return_counts=True)
    arrays = (np.asarray(table["intent_index"], np.int32), terms.astype(np.int64), counts.astype(np.int64), rows, weights[order].astype(float))
    return _one_row(_QUERIES, [table["_block"][0].as_py(), table["query_id"].to_pylist(), *(a.tobytes() for a in arrays)])


def pack_cases(table: pa.Table) -> pa.Table:
    """A case block as one row: its cases in id order, each entry with its place among the block's terms."""
    table = table.take(pc.sort_indices(table["case_id"], null_placement="at_start"))
    indices, lengths = _ragged(table["indices"])
    weights, _ = _ragged(table["weights"])
    compatibility, _ = _ragged(table["compatibility"])
    terms, codes, counts = np.unique(indices, return_inverse=True, return_counts=True)
    arrays = (compatibility.astype(float), terms.astype(np.int64), counts.astype(np.int64), codes.astype(np.int32),
              lengths.astype(np.int32), weights.astype(float))
    return _one_row(_CASES, [table["_block"][0].as_py(), table["case_id"].to_pylist(), *(a.tobytes() for a in arrays)])


def _added(cells: np.ndarray, queries: tuple, terms: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> None:
    """Add the products of case entries (place of the query term, row, weight) to the cells of (query, case)."""
    flat, (start, count, query_rows, query_weights) = cells.reshape(-1), queries
    counts = count[terms]
    ends, lo = np.cumsum(counts), 0
    while lo < len(terms):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + EXPANSION, side="right")))
        n = counts[lo:hi]
        entry = np.repeat(start[terms[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        cell = query_rows[entry].astype(np.int64) * cells.shape[1] + np.repeat(rows[lo:hi], n)
        product = query_weights[entry] * np.repeat(weights[lo:hi], n)
        if len(cell) * 4 < len(flat):
            np.add.at(flat, cell, product)
        else:
            flat += np.bincount(cell, weights=product, minlength=len(flat))
        lo = hi


def _block_top_k(get, k: int, similarity_weight: float, compatibility_weight: float) -> pa.RecordBatch:
    """The k best cases of a case block for each query of a query block; ``get(name, dtype)`` reads a packed column.

    Terms that many queries and many cases hold are multiplied as dense columns, the others entry by entry. Cases come in
    id order, so of equal scores the first wins, and a later chunk only adds scores above the k-th best so far.
    """
    query_ids, case_ids = get("query_ids", None), get("case_ids", None)
    intents, terms, count = get("intents", np.int32), get("query_terms", np.int64), get("query_counts", np.int64)
    query_rows, query_weights = get("query_rows", np.int32), get("query_weights", float)
    start = np.cumsum(count) - count
    case_terms, case_counts = get("case_terms", np.int64), get("case_counts", np.int64)
    lengths, weights = get("case_lengths", np.int32), get("case_weights", float)
    n_queries, n_cases = len(query_ids), len(case_ids)
    compatibility = get("compatibility", float).reshape(n_cases, -1)
    fits = np.vstack([compatibility.T, np.zeros((1, n_cases))])  # the last line is that of no intent
    intents = np.where((intents >= 0) & (intents < len(fits) - 1), intents, len(fits) - 1)

    place = np.full(len(case_terms), -1)  # of a case term among the query terms
    if len(terms) and len(case_terms):
        at = np.minimum(np.searchsorted(terms, case_terms), len(terms) - 1)
        place = np.where(terms[at] == case_terms, at, -1)
    products = np.where(place >= 0, case_counts * (count[place] if len(count) else 0), 0)
    dense = np.flatnonzero(products * DENSE_SHARE > n_queries * n_cases)
    dense = dense[np.argsort(-products[dense], kind="stable")[:DENSE_TERMS]]
    column = np.full(len(case_terms), -1)
    column[dense] = np.arange(len(dense))
    wide = np.zeros((n_queries, len(dense)))
    for at, term in enumerate(place[dense]):
        own = slice(start[term], start[term] + count[term])
        wide[:, at] = np.bincount(query_rows[own], weights=query_weights[own], minlength=n_queries)
    codes = get("case_codes", np.int32)
    places, columns = place[codes], column[codes]
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])

    keep, best, lo = min(k, n_cases), None, 0
    chunk, step = max(1, CELLS // n_queries), max(4 * k, 64)  # the first chunk only has to give k rows
    while lo < n_cases:
        hi = min(lo + step, n_cases)
        step = chunk
        span = slice(ends[lo], ends[hi])
        rows, own, at, value = np.repeat(np.arange(hi - lo), lengths[lo:hi]), columns[span], places[span], weights[span]
        if len(dense):
            frequent = own >= 0
            cells = np.bincount(rows[frequent] * len(dense) + own[frequent], weights=value[frequent], minlength=(hi - lo) * len(dense))
            similarity = wide @ cells.reshape(hi - lo, len(dense)).T
        else:
            similarity = np.zeros((n_queries, hi - lo))
        rest = (at >= 0) & (own < 0)
        _added(similarity, (start, count, query_rows, query_weights), at[rest], rows[rest], value[rest])
        combined = similarity_weight * similarity
        if compatibility_weight:
            combined += compatibility_weight * fits[:, lo:hi][intents]
        if best is None:
            picks = np.argsort(-np.round(combined, DECIMALS), axis=1, kind="stable")[:, :keep]
            best = [np.take_along_axis(similarity, picks, 1), np.take_along_axis(combined, picks, 1), picks]
        else:
            last = np.round(best[1][:, -1], DECIMALS)
            flat = np.flatnonzero(combined > (last + (0.5 * 10.0**-DECIMALS - SLACK))[:, None])
            row, col = np.divmod(flat, hi - lo)
            found = [similarity.ravel()[flat], combined.ravel()[flat], col + lo]
            above = np.round(found[1], DECIMALS) > last[row]
            row, found = row[above], [f[above] for f in found]
            if len(row):
                changed = np.unique(row)
                line = np.concatenate([np.repeat(changed, keep), row])
                fields = [np.concatenate([b[changed].ravel(), f]) for b, f in zip(best, found)]
                order = np.lexsort((fields[2], -np.round(fields[1], DECIMALS), line))
                line = line[order]
                first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
                picked = order[(first[:, None] + np.arange(keep)).ravel()]
                for b, f in zip(best, fields):
                    b[changed] = f[picked].reshape(len(changed), keep)
        lo = hi
    similarity, combined, picks = best
    fit = fits[intents[:, None], picks]
    columns = [
        query_ids.take(pa.array(np.repeat(np.arange(n_queries), keep))), case_ids.take(pa.array(picks.ravel())),
        *(pa.array(f.ravel()) for f in (similarity, fit, combined)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["query_id", "case_id", "similarity", "intent_compatibility", "combined_score"])


def _merged(best: pa.RecordBatch, found: pa.RecordBatch, queries: int, k: int) -> pa.RecordBatch:
    """The k best rows per query of a block from two sets of case blocks; either holds equally many rows per query."""
    rows = pa.Table.from_batches([best, found]).combine_chunks()
    line = np.concatenate([np.repeat(np.arange(queries), b.num_rows // queries) for b in (best, found)])
    ids = pc.sort_indices(rows["case_id"], null_placement="at_start")
    place = np.empty(len(line), np.int64)
    place[np.asarray(ids)] = np.arange(len(line))
    order = np.lexsort((place, -np.round(np.asarray(rows["combined_score"]), DECIMALS), line))
    each = len(line) // queries
    kept = order.reshape(queries, each)[:, :min(k, each)].ravel()
    return rows.take(pa.array(kept)).combine_chunks().to_batches()[0]


def top_k_of_blocks(k: int, similarity_weight: float, compatibility_weight: float):
    """For ``mapInArrow`` over rows of a packed query block and a packed case block; the rows are :data:`RESULT`.

    A task keeps k rows per query of each query block it meets, over all its case blocks.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {}
        for batch in batches:
            for row in range(batch.num_rows):
                def get(name, dtype):
                    value = batch.column(name)[row]
                    return value.values if dtype is None else np.frombuffer(value.as_buffer(), dtype)

                found, block = _block_top_k(get, k, similarity_weight, compatibility_weight), batch.column("query_block")[row].as_py()
                queries = len(get("query_ids", None))
                best[block] = _merged(best[block], found, queries, k) if block in best else found
        yield from best.values()

    return search


def silhouette_of_block(indices, weights, clusters) -> float:
    """Mean Euclidean silhouette of unit vectors given as index and weight lists."""
    lengths = np.array([len(i) for i in indices])
    terms, columns = np.unique(np.concatenate([np.asarray(i, dtype=np.int64) for i in indices]), return_inverse=True)
    dense = np.zeros((len(lengths), max(len(terms), 1)))
    if len(terms):
        dense[np.repeat(np.arange(len(lengths)), lengths), columns] = np.concatenate(list(weights))
    squares = (dense ** 2).sum(axis=1)
    distance = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * dense @ dense.T, 0.0))
    np.fill_diagonal(distance, 0.0)
    labels, own = np.unique(clusters, return_inverse=True)
    if len(labels) < 2:
        return 0.0
    member = np.eye(len(labels))[own]
    sizes = member.sum(axis=0)
    sums = distance @ member
    lines = np.arange(len(own))
    inner = sums[lines, own] / np.maximum(sizes[own] - 1, 1)
    means = sums / sizes
    means[lines, own] = np.inf
    outer = means.min(axis=1)
    width = np.maximum(inner, outer)
    score = np.where((sizes[own] > 1) & (width > 0), (outer - inner) / np.where(width > 0, width, 1.0), 0.0)
    return float(score.mean())
