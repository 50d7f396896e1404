"""Hard negatives from a multiway hyperplane tree with distance ranges (GNAT), over lifted vectors.

Scores are integer inner products. With one more component, ``sqrt(R - |v|^2)`` for rows and 0 for anchors (R is the
largest squared norm), all rows have the same norm, so ``distance^2 = |anchor|^2 + R - 2 * score``: a window of scores is
an annulus of distances, and the best scores are the nearest rows.

**Tree.** A node has up to ``WAYS`` split points, taken far from each other out of a bounded sample; a row goes to the
nearest one, level by level, down to a leaf. For each split point and each sibling's subtree the node stores the range of
the distances between them, over all rows. A subtree is eliminated for an anchor if for any split point of its node the
anchor's own distance and the range show that all its rows lie outside of all the anchor's annuli. Only the split points
are fitted on the sample (``SAMPLE`` rows, smallest hash of the id first); every row is indexed and the ranges cover every
row, so the search is exact.

**Search.** First the anchor's own leaf gives bounds, then all leaves that are left are scanned exactly: once for the
positives (the annulus of the same label reaches from the fifth best score known to the nearest row), once for the
negatives (one annulus per positive, narrowed by the fifth best of its window that is known). Anchors whose leaves are
neighbours travel in groups of ``GROUP``; a leaf of more than ``CHUNK`` rows is dealt to several tasks. A task holds one
chunk and one group and returns the best few rows per anchor and window.

Defined results: a null label, a null vector and a null or non-finite component take no part, nor does a null id; an
empty vector has score 0 with all; a shorter vector counts as filled up with zeros; of rows that share an id the one with
the smallest label, then vector, takes part; ties go to the smaller id; a negative window (a positive of a score below 0)
holds nothing; components saturate at a long, scores at 2**62; an empty table gives an empty one. Only the id, vector and
label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from caseweave.session import stored

SAMPLE, WAYS, LEVELS = 16_384, 16, 3
LEAF_ROWS, CHUNK, GROUP, PACKED = 4_096, 65_536, 8_192, 1_024
K, CELLS = 5, 2_000_000
FOUND = "anchor_id long, window int, vec_id long, score long"
PACK = "leaf int, chunk int, team int, n int, ids binary, labels binary, vectors binary, low binary, high binary"
LONGEST = 1 << 62


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices, in doubles, longs or Python's integers as they need."""
    most = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, b)]
    bound = a.shape[1] * most[0] * most[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < LONGEST:
        return a @ b.T
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, 1 - LONGEST, LONGEST).astype(np.int64)


def matrix(column: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of longs as rows, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    lengths = np.asarray(column.value_lengths(), np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None] < lengths[:, None]] = np.asarray(column.flatten(), np.int64)
    return out


class Tree:
    """Split points in levels; node ``i`` of a level has the children ``i * WAYS`` to ``i * WAYS + WAYS - 1``."""

    def __init__(self, sample: np.ndarray, largest: float, levels: int, width: int):
        self.largest, self.width, self.points = largest, width, []
        own = np.zeros(len(sample), np.int64)
        lifted = self.lift(sample)
        for level in range(levels):
            points = np.full((WAYS**level, WAYS, width + 1), np.inf)
            for node in range(WAYS**level):
                chosen = self._apart(lifted[own == node][: 3 * WAYS])
                points[node, : len(chosen)] = chosen
            self.points.append(points)
            own = own * WAYS + self.distances(level, own, lifted).argmin(axis=1) if len(own) else own
        self.low = [np.full((WAYS**level, WAYS, WAYS), np.inf) for level in range(levels)]
        self.high = [np.full((WAYS**level, WAYS, WAYS), -np.inf) for level in range(levels)]

    def lift(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.float64)
        return np.concatenate([rows, np.sqrt(np.maximum(0, self.largest - (rows * rows).sum(axis=1)))[:, None]], axis=1)

    @staticmethod
    def _apart(candidates: np.ndarray) -> np.ndarray:
        """Greedily the candidate farthest from those taken; equal ones are taken once."""
        if not len(candidates):
            return candidates
        taken, away = [0], ((candidates - candidates[0]) ** 2).sum(axis=1)
        while len(taken) < WAYS and away.max() > 0:
            taken.append(int(away.argmax()))
            away = np.minimum(away, ((candidates - candidates[taken[-1]]) ** 2).sum(axis=1))
        return candidates[taken]

    def distances(self, level: int, nodes: np.ndarray, lifted: np.ndarray) -> np.ndarray:
        """Distances of each row to the split points of its node; infinite where there is none, 0 to the first of none."""
        out = np.full((len(lifted), WAYS), np.inf)
        for node in np.unique(nodes):
            rows, points = np.flatnonzero(nodes == node), self.points[level][node]
            real = np.flatnonzero(np.isfinite(points[:, 0]))
            if not len(real):
                out[rows, 0] = 0
                continue
            near, far = lifted[rows], points[real]
            squares = (near**2).sum(axis=1)[:, None] + (far**2).sum(axis=1)[None] - 2 * near @ far.T
            out[np.ix_(rows, real)] = np.sqrt(np.maximum(squares, 0))
        return out

    def descend(self, rows: np.ndarray, lifted: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per level the node of each row, its child there, and the distances to the node's split points."""
        lifted = self.lift(rows) if lifted is None else lifted
        nodes, path = np.zeros(len(rows), np.int64), []
        for level in range(len(self.points)):
            away = self.distances(level, nodes, lifted)
            child = away.argmin(axis=1)
            path.append((nodes, child, away))
            nodes = nodes * WAYS + child
        return path

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        nodes, child, _ = self.descend(rows)[-1]
        return nodes * WAYS + child

    def surviving(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which leaves may hold a score in one of the windows ``low`` to ``high`` (anchors x windows) of each anchor."""
        flat = anchors.astype(np.float64)
        squares = (flat * flat).sum(axis=1)[:, None] + self.largest
        slack = 1e-9 * squares + 1e-6
        used = low <= high
        nearest = np.sqrt(np.maximum(0, squares - 2.0 * np.minimum(high, LONGEST) - slack))
        farthest = np.sqrt(np.maximum(0, squares - 2.0 * np.maximum(low, -LONGEST) + slack))
        lifted = np.concatenate([flat, np.zeros((len(flat), 1))], axis=1)
        alive = np.ones((len(anchors), 1), bool)
        edge = 1e-7 * np.sqrt(squares)[:, :, None] + 1e-6
        for level, points in enumerate(self.points):
            going = np.zeros((len(anchors), WAYS ** (level + 1)), bool)
            for node in range(WAYS**level):
                rows = np.flatnonzero(alive[:, node])
                if not len(rows):
                    continue
                real = np.isfinite(points[node, :, 0])
                away = self.distances(level, np.full(len(rows), node), lifted[rows])[:, real, None]
                below, above = self.low[level][node][real][None], self.high[level][node][real][None]
                closest = np.maximum(np.maximum(below - away, away - above).max(axis=1, initial=-np.inf), 0)
                widest = (away + above).min(axis=1, initial=np.inf)
                fit = (closest[:, None, :] <= farthest[rows][:, :, None] + edge[rows]) & (
                    widest[:, None, :] >= nearest[rows][:, :, None] - edge[rows]
                ) & used[rows][:, :, None]
                held = (self.high[level][node].max(axis=0) >= 0) if real.any() else np.arange(WAYS) == 0
                going[np.ix_(rows, np.arange(node * WAYS, node * WAYS + WAYS))] = fit.any(axis=1) & held[None]
            alive = going
        return alive


def admitted(vectors: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """``vec_id``, ``label`` and the integer ``vec`` of the rows that take part, one per id; ``norm`` is its square."""
    sound = F.col(vec_col).isNotNull() & F.forall(
        vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = vectors.where(sound & label.isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("vec")
    )
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")
    double = F.transform("vec", lambda x: x.cast("double"))
    return one.withColumn("norm", F.aggregate(double, F.lit(0.0), lambda n, x: n + x * x))


def planted(rows: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree of ``rows`` and the rows with their ``leaf``, written to the shared folder."""
    size = rows.agg(F.count("*"), F.max("norm"), F.max(F.size("vec"))).first()
    n, width = size[0], max(size[2] or 0, 1)
    levels = 1
    while levels < LEVELS and n > LEAF_ROWS * WAYS**levels:
        levels += 1
    first = rows.select("vec_id", "vec").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    tree = Tree(matrix(first["vec"], width), float(size[1] or 0), levels, width)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaves(matrix(batch.column(2), width)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["vec_id", "label", "vec", "leaf"])

    placed = stored(rows.select("vec_id", "label", "vec").mapInArrow(place, "vec_id long, label long, vec array<long>, leaf int"), "tree-rows")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = [x.copy() for x in tree.low], [x.copy() for x in tree.high]
        for batch in batches:
            for level, (nodes, child, away) in enumerate(tree.descend(matrix(batch.column(0), width))):
                for point in range(WAYS):
                    real = np.isfinite(away[:, point])
                    at = (nodes[real], point, child[real])
                    np.minimum.at(low[level], at, away[real, point])
                    np.maximum.at(high[level], at, away[real, point])
        for level in range(levels):
            seen = np.argwhere(high[level] >= 0)
            at = tuple(seen.T)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), level, np.int32)), *[pa.array(c.astype(np.int32)) for c in seen.T], pa.array(low[level][at]), pa.array(high[level][at])],
                ["level", "node", "point", "child", "low", "high"],
            )

    ranges = placed.select("vec").mapInArrow(measure, "level int, node int, point int, child int, low double, high double")
    for r in ranges.groupBy("level", "node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.low[r.level][r.node, r.point, r.child], tree.high[r.level][r.node, r.point, r.child] = r.low, r.high
    return tree, placed


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` greatest scores of each row, the leftmost of equals first; -1 where no more are left."""
    scores = scores.copy()
    out, lines = np.full((len(scores), k), -1), np.arange(len(scores))
    for place in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        out[:, place] = np.where(scores[lines, at] > -LONGEST, at, -1)
        scores[lines, at] = -LONGEST
    return out


class Search:
    """Scans of leaves for anchors with windows of scores."""

    def __init__(self, tree: Tree, rows: DataFrame, k: int):
        self.tree, self.rows, self.k = tree, rows, k
        counts = {r.leaf: r["count"] for r in rows.groupBy("leaf").count().collect()}  # one row per leaf
        self.chunks = np.ones(WAYS ** len(tree.points), np.int64)
        for leaf, n in counts.items():
            self.chunks[leaf] = -(-n // CHUNK)

    def teams(self, anchors: DataFrame) -> np.ndarray:
        """The group of each leaf's anchors: leaves in order, up to ``GROUP`` anchors together, or several a leaf."""
        counts = {r.leaf: r["count"] for r in anchors.groupBy("leaf").count().collect()}
        first, parts, team, room = np.zeros(len(self.chunks), np.int64), np.ones(len(self.chunks), np.int64), 0, GROUP
        for leaf in range(len(self.chunks)):
            n = counts.get(leaf, 0)
            if n > room:
                team, room = team + 1, GROUP
            first[leaf], parts[leaf] = team, max(1, -(-n // GROUP))
            team, room = team + parts[leaf] - 1, room - n if parts[leaf] == 1 else 0
        return np.stack([first, parts])

    def scan(self, anchors: DataFrame, windows: int, same: bool, home: bool) -> DataFrame:
        """The best ``k`` rows of each window of each anchor in its own leaf (``home``) or in all leaves that survive.

        ``anchors``: ``anchor_id``, ``label``, ``vec``, ``leaf``, ``low`` and ``high`` (lists of ``windows`` scores).
        """
        tree, chunks, k, width, (team_of, parts_of) = self.tree, self.chunks, self.k, self.tree.width, self.teams(anchors)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, types = [part.split()[0] for part in PACK.split(", ")], [pa.int32()] * 4 + [pa.binary()] * 5
            for batch in batches:
                ids, label, leaf = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1, 3))
                vec, low, high = matrix(batch.column(2), width), matrix(batch.column(4), windows), matrix(batch.column(5), windows)
                team = team_of[leaf] + np.abs(ids) % parts_of[leaf]
                if home:
                    alive = leaf[:, None] == np.arange(len(chunks))[None]
                else:
                    alive = tree.surviving(vec, low, high)
                for own in np.unique(team).tolist():
                    for at in np.flatnonzero(alive[team == own].any(axis=0)).tolist():
                        rows = np.flatnonzero((team == own) & alive[:, at])
                        for lo in range(0, len(rows), PACKED):
                            part = rows[lo : lo + PACKED]
                            packed = [x[part].tobytes() for x in (ids, label, vec, low, high)]
                            out = [(at, chunk, own, len(part), *packed) for chunk in range(chunks[at])]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
                            )

        packs = stored(anchors.select("anchor_id", "label", "vec", "leaf", "low", "high").mapInArrow(pack, PACK), "anchor-packs")
        visits = packs.select(*[F.col(c).alias(f"to_{c}") for c in ("leaf", "chunk", "team")]).distinct()
        n_chunks = F.get(F.array(*[F.lit(int(n)) for n in chunks]), F.col("leaf"))
        chunk = F.pmod(F.xxhash64("vec_id"), n_chunks).cast("int")
        dealt = self.rows.join(visits, (F.col("leaf") == F.col("to_leaf")) & (chunk == F.col("to_chunk")))

        def look(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            right = right.sort_by("vec_id")
            ids, label, vec = right["vec_id"].to_numpy(), right["label"].to_numpy(), matrix(right["vec"], width)
            for row in left.to_pylist() if len(ids) else []:
                a_ids, a_label, a_vec, low, high = (np.frombuffer(row[name], np.int64) for name in ("ids", "labels", "vectors", "low", "high"))
                a_vec, low, high = (x.reshape(row["n"], -1) for x in (a_vec, low, high))
                step = max(1, CELLS // len(ids))
                for lo in range(0, row["n"], step):
                    part = slice(lo, lo + step)
                    scores = inner(a_vec[part], vec)
                    fits = (a_label[part][:, None] == label[None]) == same
                    fits &= a_ids[part][:, None] != ids[None]
                    for window in range(windows):
                        below, above = low[part, window], high[part, window]
                        if not (below <= above).any():
                            continue
                        own = np.where(fits & (scores >= below[:, None]) & (scores <= above[:, None]), scores, -LONGEST)
                        at = best(own, k)
                        line, place = np.nonzero(at >= 0)
                        column = at[line, place]
                        found.append((a_ids[part][line], np.full(len(line), window, np.int32), ids[column], scores[line, column]))
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            return pa.Table.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["anchor_id", "window", "vec_id", "score"]
            )

        dealt = dealt.select("to_leaf", "to_chunk", "to_team", "vec_id", "label", "vec").groupBy("to_leaf", "to_chunk", "to_team")
        found = packs.groupBy("leaf", "chunk", "team").cogroup(dealt).applyInArrow(look, FOUND)
        order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        return stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "found")


def mine(
    vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
    n_positives: int = K, n_negatives: int = K, floor_pct: int = 80,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows that ``anchor`` (a condition on the id, here ``vec_id``) holds for.
    """
    tree, rows = planted(stored(admitted(vectors, id_col, vec_col, label), "admitted"))
    own = rows.where(anchor).withColumnRenamed("vec_id", "anchor_id")
    ends = lambda low, high: [low.alias("low"), high.alias("high")]
    columns = ["anchor_id", "label", "vec", "leaf"]

    positives, least = Search(tree, rows, n_positives), F.lit(-LONGEST)
    everything = own.select(*columns, *ends(F.array(least), F.array(F.lit(LONGEST))))
    near = positives.scan(everything, 1, True, True)
    bound = near.where(F.col("rank") == n_positives).select("anchor_id", F.col("score").alias("bound"))
    bounded = own.join(bound, "anchor_id", "left").select(
        *columns, *ends(F.array(F.coalesce("bound", least)), F.array(F.lit(LONGEST)))
    )
    chosen = positives.scan(bounded, 1, True, False).select(
        "anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )

    negatives, top = Search(tree, rows, n_negatives), F.col("positive_score")
    # 100 * negative >= floor_pct * positive, in whole numbers.
    lowest = F.when(top >= 0, F.ceil((top.cast("decimal(30,0)") * floor_pct) / 100).cast("long")).otherwise(F.lit(LONGEST))

    def windows(known: DataFrame | None) -> DataFrame:
        marked = chosen.withColumn("low", lowest)
        if known is not None:
            fifth = known.where(F.col("rank") == n_negatives).select("anchor_id", "window", F.col("score").alias("fifth"))
            marked = marked.join(fifth, ["anchor_id", "window"], "left").withColumn("low", F.greatest("low", F.coalesce("fifth", "low")))
        per_anchor = marked.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", F.struct("low", top.alias("high"))))).alias("w"))
        span = F.sequence(F.lit(0), F.lit(n_positives - 1))
        return own.join(per_anchor, "anchor_id").select(
            *columns, F.transform(span, lambda i: F.coalesce(F.try_element_at("w", i)["low"], F.lit(1).cast("long"))).alias("low"),
            F.transform(span, lambda i: F.coalesce(F.try_element_at("w", i)["high"], F.lit(0).cast("long"))).alias("high"),
        )

    first = negatives.scan(windows(None), n_positives, False, True)
    found = negatives.scan(windows(first), n_positives, False, False)
    return found.join(chosen, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
