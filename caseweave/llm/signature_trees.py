"""Jaccard join of word n-gram sets with signature trees: which documents are linked, as connected components.

Equal sets are one node. The join has two parts.

**Dealing.** Sets that can be linked must meet. By size a set belongs to a band. Sets of a larger band are cut into
parts by a hash of their n-grams; sets that are similar enough differ in at most D n-grams, so among D + 1 + S parts at
least S + 1 are the same in both. A set may therefore pass over S of its parts: its empty ones (with more than S of them,
and a partner that differs in just the others, a link would be missed: far less likely than two 64-bit hashes colliding)
and, up to that number, those whose contents the most sets share. Two sets pass over their most shared parts in one
order, so one common part is left. That keeps a line which many texts hold from drawing them together. Sets of up to ``SMALL`` n-grams meet on one of their rarest n-grams (prefix filter by document
frequency). The sets of a meeting place are hung under the smallest of them, so k sets make k - 1 edges. The components
of these edges are the groups in which all links lie.

**Trees.** A group is built into a tree: leaves hold a few sets, every node holds the OR of its sets' bitmaps, the range
of their sizes and how many n-grams a bitmap can hide. A pair of nodes is dropped when the sizes are too far apart, when
the most n-grams that they can share are too few, or when all their sets are linked already; otherwise its children are
paired. Pairs of sets that remain are compared exactly. A group with more than ``BLOCK`` n-grams is cut into blocks, one
tree each; sets whose rarest common key is the same lie in one block. Two blocks are then traversed with those of their
sets that share a key with a set of the other block in another component, so texts go only where a link can be, and no
task holds more than two blocks.

Similarities are compared in integers. Defined results: a null text, an empty one and one without words have no
n-grams and are linked with nothing; a shorter text than ``n`` words has its whole sequence as its one n-gram; rows that
share an id are each compared by their own text and returned; a row with a null id is linked with rows of an equal set
only and never names a component; an empty table gives an empty one; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from caseweave.llm.byte_bpe import slices
from caseweave.llm.components import components
from caseweave.llm.hot import looked_up
from caseweave.session import discard, stored

SMALL, RATIO_PCT = 128, 150
BLOCK, BROADCAST_ROWS = 500_000, 500_000
BITS, LEAF, FAN = 4096, 8, 4
FEW = 4  # a part that so few rows share is never passed over
SETS = (
    "doc_id long, node long, n_shingles long, keys array<long>, spare int, above array<long>, above_spare int, small array<long>"
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """64-bit hashes of the word n-grams of texts, many texts at once."""

    def __init__(self, n: int):
        self.n = n
        self.values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """The distinct n-grams of each text, in order of their hashes."""
        data = np.frombuffer(b"".join([t.lower() + b"\n" for t in texts]), np.uint8)  # bytes.lower: A-Z only
        ends = np.cumsum([len(t) + 1 for t in texts])
        solid = ~self.space[data]
        edge = np.diff(np.concatenate([[False], solid, [False]]).view(np.int8))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return [np.zeros(0, np.uint64)] * len(texts)
        # A word's hash: the sum of its bytes' values, each rotated by its place, then mixed with the length.
        place = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
        power = np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        weighed = np.where(solid, self.values[data] * power[place], np.uint64(0))
        word = mixed(np.add.reduceat(weighed, starts) + (stops - starts).astype(np.uint64))
        first = np.searchsorted(starts, np.concatenate([[0], ends[:-1]]))
        counts = np.diff(np.append(first, len(word)))
        grams = word.copy()
        for k in range(1, self.n):  # positions near the end of a text are not used below
            grams[: len(word) - k] = mixed(grams[: len(word) - k] * np.uint64(0x9FB21C651E98DF25) + word[k:])
        out = []
        for at, count in zip(first.tolist(), counts.tolist(), strict=True):
            if count >= self.n:
                out.append(np.unique(grams[at : at + count - self.n + 1]))
            elif count:  # the whole sequence, told from a full n-gram by its length
                own = np.full(1, count, np.uint64)
                for k in range(at, at + count):
                    own = mixed(own * np.uint64(0x9FB21C651E98DF25) + word[k])
                out.append(own)
            else:
                out.append(np.zeros(0, np.uint64))
        return out


class Bands:
    """The bands of sizes and the number of parts of each."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent, bounds = percent, [SMALL + 1]
        while bounds[-1] < largest:
            bounds.append(-(-bounds[-1] * RATIO_PCT // 100))
        self.lower = np.array(bounds[:-1])
        apart = [(100 - percent) * 2 * (upper - 1) // (100 + percent) for upper in bounds[1:]]
        self.more = np.array([6 + d // 8 for d in apart])  # S of the module's account
        self.parts = np.array(apart) + 1 + self.more

    def of(self, size: int) -> list[int]:
        """The bands in which a set of ``size`` can be linked to one of at least its size."""
        own = int(np.searchsorted(self.lower, size, "right")) - 1
        above = own + 1
        near = above < len(self.lower) and size * 100 >= self.percent * int(self.lower[above])
        return ([own] if own >= 0 else []) + ([above] if near else [])

    def keys(self, shingles: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """For the set's own band and the one above: the hashed contents of its parts, and how many it may pass over."""
        out = []
        for band in self.of(len(shingles)):
            parts = int(self.parts[band])
            part = (mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)).astype(np.int64)
            total = np.zeros(parts, np.uint64)
            np.add.at(total, part, mixed(shingles))
            used = np.flatnonzero(np.bincount(part, minlength=parts))
            keys = mixed(total[used] + mixed(used.astype(np.uint64) + np.uint64((band + 1) << 32)))
            out.append((keys, max(0, int(self.more[band]) - (parts - len(used)))))
        return out + [(np.zeros(0, np.uint64), 0)] * (2 - len(out))


def node_of(shingles: np.ndarray) -> int:
    """The number of a set: a hash of its n-grams and its size."""
    total = np.add.reduce(mixed(shingles + np.uint64(0x1234567)), keepdims=True) + np.uint64(len(shingles))
    return int(mixed(total).view(np.int64)[0])


def lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def sets_of(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Each document's node (a hash of its set), the size of its set, and its keys; written to the shared folder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bands = Shingler(n), Bands(percent)
        none = np.zeros(0, np.uint64)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for start, stop in slices([len(t) for t in texts]):
                found = shingler(texts[start:stop])
                sizes = np.array([len(f) for f in found], np.int64)
                node, keyed = [node_of(f) for f in found], [bands.keys(f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start), pa.array(node, pa.int64()), pa.array(sizes),
                        lists([k[0][0] for k in keyed]), pa.array([k[0][1] for k in keyed], pa.int32()),
                        lists([k[1][0] for k in keyed]), pa.array([k[1][1] for k in keyed], pa.int32()),
                        lists([f if len(f) <= SMALL else none for f in found]),
                    ],
                    ["doc_id", "node", "n_shingles", "keys", "spare", "above", "above_spare", "small"],
                )

    return stored(docs.mapInArrow(cut, SETS), "shingle-sets")


def meetings(sets: DataFrame, percent: int) -> DataFrame:
    """``node``, ``key``, ``n``: the keys that each node shares with others and does not pass over; ``n`` rows have it."""
    # The tag is the band (own, above, small) and the number of parts to pass over, in one column of the large shuffle.
    parts = sets.select("node", (F.col("spare") * 3).alias("tag"), F.explode("keys").alias("key")).unionByName(
        sets.select("node", (F.col("above_spare") * 3 + 1).alias("tag"), F.explode("above").alias("key"))
    )
    small = sets.where(f"n_shingles BETWEEN 1 AND {SMALL}").select("node", "n_shingles", F.explode("small").alias("key")).distinct()
    frequency = small.groupBy("key").agg(F.count("*").alias("df"))
    rare_first = Window.partitionBy("node").orderBy("df", "key")
    prefix = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    rarest = small.join(frequency.where("df > 1"), "key", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn(
        "place", F.row_number().over(rare_first)
    ).where(F.col("place") <= prefix).where("df > 1").select("node", F.xxhash64("key", F.lit("small")).alias("key"))
    keys = parts.unionByName(rarest.select("node", F.lit(2).alias("tag"), "key"))
    # One shuffle of all keys; most are of one set and go. A set has many keys, so many copies of one text make many
    # large keys and not one.
    met = keys.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1").distinct()
    return stored(
        met.withColumn("place", F.row_number().over(Window.partitionBy("node", "tag").orderBy(F.desc("n"), "key")))
        .where((F.col("place") > F.floor(F.col("tag") / 3)) | (F.col("n") <= FEW)).select("node", "key", "n"),
        "shared-keys",
    )


def groups(shared: DataFrame) -> DataFrame:
    """``node``, ``label`` of its group, and ``home``: the smallest node of the rarest key that it shares."""
    roots = shared.groupBy("key").agg(F.min("node").alias("root"), F.count(F.lit(1)).alias("rows"))
    hung = stored(looked_up(shared, roots, "key", "rows", shared.count()).select("node", "root", "n"), "hung")
    labels = components(hung.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    homes = hung.groupBy("node").agg(F.min(F.struct("n", "root")).alias("least")).select("node", F.col("least.root").alias("home"))
    found = stored(labels.join(homes, "node"), "groups")
    discard(hung, labels)
    return found


class Tree:
    """Sets in order of likeness, with nodes over runs of them; level 0 holds runs of LEAF."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray):
        order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))
        self.sets = [sets[i] for i in order]
        self.order, self.labels = np.array(order), labels
        self.size = np.array([len(s) for s in self.sets])
        bits = np.zeros((len(sets), BITS // 64), np.uint64)
        for row, own in zip(bits, self.sets, strict=True):
            place = mixed(own) % np.uint64(BITS)
            np.bitwise_or.at(row, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        self.bits = bits
        self.hidden = self.size - np.bitwise_count(bits).sum(axis=1)
        self.levels = [self._level(LEAF)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._level(LEAF * FAN ** len(self.levels)))

    def _level(self, width: int) -> tuple[np.ndarray, ...]:
        at = np.arange(0, len(self.sets), width)
        return (
            at, np.append(at[1:], len(self.sets)), np.bitwise_or.reduceat(self.bits, at), np.minimum.reduceat(self.size, at),
            np.maximum.reduceat(self.size, at), np.maximum.reduceat(self.hidden, at),
        )


class Linker:
    """Dual traversal of two trees, or of one with itself, over shared labels that linked sets take on."""

    def __init__(self, labels: np.ndarray, percent: int):
        self.labels, self.percent, self.links, self.compared = labels, percent, [], 0

    def _needed(self, size_a, size_b):
        """The fewest common n-grams of linked sets of these sizes."""
        return -(-(size_a + size_b) * self.percent // (100 + self.percent))

    def run(self, left: Tree, right: Tree) -> None:
        same = left is right
        stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
        while stack:
            level_a, a, level_b, b = stack.pop()
            if not self._possible(left, level_a, a, right, level_b, b):
                continue
            if not level_a and not level_b:
                self._compare(left, a, right, b, same and a == b)
                continue
            down_a = level_a >= level_b
            down_b = level_b >= level_a
            ahead_a = range(a * FAN, min(a * FAN + FAN, len(left.levels[level_a - 1][0]))) if down_a else (a,)
            ahead_b = range(b * FAN, min(b * FAN + FAN, len(right.levels[level_b - 1][0]))) if down_b else (b,)
            ahead = [(level_a - down_a, i, level_b - down_b, j) for i in ahead_a for j in ahead_b if not same or i <= j]
            stack += sorted(ahead, key=lambda pair: -abs(pair[1] - pair[3]))  # the nearest are taken first

    def _possible(self, left: Tree, level_a: int, a: int, right: Tree, level_b: int, b: int) -> bool:
        start_a, stop_a, bits_a, low_a, high_a, hidden_a = (x[a] for x in left.levels[level_a])
        start_b, stop_b, bits_b, low_b, high_b, hidden_b = (x[b] for x in right.levels[level_b])
        if high_a * 100 < low_b * self.percent or high_b * 100 < low_a * self.percent:
            return False
        common = int(np.bitwise_count(bits_a & bits_b).sum())
        if min(high_a, high_b, common + hidden_a, common + hidden_b) < self._needed(low_a, low_b):
            return False
        own_a = self.labels[left.labels[left.order[start_a:stop_a]]]
        own_b = self.labels[right.labels[right.order[start_b:stop_b]]]
        return bool((own_a != own_a[0]).any() or (own_b != own_a[0]).any())

    def _compare(self, left: Tree, a: int, right: Tree, b: int, same: bool) -> None:
        rows_a = np.arange(left.levels[0][0][a], left.levels[0][1][a])
        rows_b = np.arange(right.levels[0][0][b], right.levels[0][1][b])
        common = np.bitwise_count(left.bits[rows_a][:, None] & right.bits[rows_b][None]).sum(axis=2, dtype=np.int64)
        size_a, size_b = left.size[rows_a][:, None], right.size[rows_b][None]
        most = np.minimum(common + left.hidden[rows_a][:, None], common + right.hidden[rows_b][None])
        maybe = np.minimum(most, np.minimum(size_a, size_b)) >= self._needed(size_a, size_b)
        for i, j in np.argwhere(maybe).tolist():
            if same and i >= j:
                continue
            one, two = left.labels[left.order[rows_a[i]]], right.labels[right.order[rows_b[j]]]
            if self.labels[one] == self.labels[two]:
                continue
            self.compared += 1
            x, y = left.sets[rows_a[i]], right.sets[rows_b[j]]
            shared = len(x) + len(y) - len(np.union1d(x, y))
            if shared >= self._needed(len(x), len(y)):
                self.links.append((one, two))
                keep, gone = self.labels[one], self.labels[two]
                self.labels[self.labels == gone] = keep


def traverse(rows: list[tuple[int, int, int, str]], shingler: Shingler, percent: int) -> list[tuple[int, int]]:
    """The links found among the rows (``side``, ``node``, ``label``, ``text``) of a task, as pairs of nodes.

    All rows of side 0 are compared with each other, or with those of side 1 if there are any. Sets with one label
    are linked already.
    """
    texts = [row[3].encode() for row in rows]
    sets = [own for start, stop in slices([len(text) for text in texts]) for own in shingler(texts[start:stop])]
    real = [i for i, row in enumerate(rows) if len(sets[i]) and node_of(sets[i]) == row[1]]  # not another text of the id
    rows, sets = [rows[i] for i in real], [sets[i] for i in real]
    sides = sorted({row[0] for row in rows})
    numbers = {label: i for i, label in enumerate(dict.fromkeys(row[2] for row in rows))}
    first = [numbers[row[2]] for row in rows]
    linker = Linker(np.array(first, np.int64), percent)  # rows of one known component start with one label
    trees = []
    for side in sides:
        own = [i for i, row in enumerate(rows) if row[0] == side]
        trees.append(Tree([sets[i] for i in own], np.array(own)))
    if trees:
        linker.run(trees[0], trees[-1])
    return [(rows[a][1], rows[b][1]) for a, b in linker.links]


def linked(tasks: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` of all tasks. ``tasks``: ``task``, ``side``, ``node``, ``label``, ``text``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, task, rows = Shingler(n), None, []

        def done() -> Iterator[pa.RecordBatch]:
            found = traverse(rows, shingler, percent) if len(rows) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

        for batch in batches:
            for own, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != task:
                    yield from done()
                    task, rows = own, []
                rows.append(tuple(row))
        yield from done()

    ordered = tasks.select("task", "side", "node", "label", "text").repartition("task").sortWithinPartitions("task", "side", "node")
    return ordered.mapInArrow(walk, "a long, b long")


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85, block: int = BLOCK
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest id that links lead to) of each row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = sets_of(rows, n, percent)
    sets = stored(keyed.select("doc_id", "node", "n_shingles"), "sets")
    shared = meetings(keyed, percent)
    discard(keyed)
    grouped = groups(shared)
    members = stored(
        sets.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
        .where("doc_id IS NOT NULL").join(grouped, "node"),
        "group-members",
    )
    n_members = members.count()
    # Groups of more than a block are cut into blocks of about the same size; a home of moderate size stays together.
    cuts = members.groupBy("label").agg(F.ceil(F.sum("n") / block).cast("int").alias("n_blocks"), F.count(F.lit(1)).alias("rows"))
    homes = members.groupBy("home").agg(F.sum("n").alias("held"), F.count(F.lit(1)).alias("rows"))
    dealt = looked_up(looked_up(members, cuts, "label", "rows", n_members), homes, "home", "rows", n_members)
    kin = F.when(F.col("held") * 4 <= block, F.col("home")).otherwise(F.col("node"))
    dealt = stored(dealt.withColumn("block", F.pmod(F.xxhash64(kin), F.col("n_blocks")).cast("int")).drop("home", "held"), "dealt")
    discard(grouped, members)
    wanted = F.broadcast(dealt) if n_members <= BROADCAST_ROWS else dealt
    one = rows.join(wanted, "doc_id").select(
        F.xxhash64("label", "block").alias("task"), F.lit(0).alias("side"), "node", F.col("node").alias("label"), "text"
    )
    links = stored(linked(one, n, percent), "links")
    large = dealt.where("n_blocks > 1")
    if large.take(1):
        links = across_blocks(rows, large, shared, links, n, percent)
    discard(shared, dealt)
    labels = components(links).withColumnRenamed("label", "component")
    nodes = sets.select("doc_id", "node", "n_shingles")
    classed = nodes.join(labels, "node", "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node"))
    )
    smallest = classed.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return classed.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def across_blocks(rows: DataFrame, large: DataFrame, shared: DataFrame, links: DataFrame, n: int, percent: int) -> DataFrame:
    """The links found so far and those between the blocks of groups of several (``large``).

    Linked sets share a key. So a set goes to another block if sets there have a key of it, are of sizes that can be linked
    to its own, and are not known to be of its component; ids and sizes decide that, and only then texts are read. A
    set's other blocks are gathered over its keys before they become rows: one row per set and block that it goes to.
    """
    labels = components(links)
    own = labels.withColumnRenamed("label", "component")
    placed = large.select("node", "doc_id", "label", "block", F.col("n").alias("size")).join(own, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    held = stored(shared.select("node", "key").join(placed, "node"), "keys-of-blocks")
    blocks = held.groupBy("key", "block").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("size").alias("least"),
        F.max("size").alias("most"), F.count(F.lit(1)).alias("rows"),
    )
    # A key's blocks are blocks of one group.
    blocks = blocks.groupBy("key").agg(
        F.collect_list(F.struct("block", "low", "high", "least", "most")).alias("blocks"), F.sum("rows").alias("rows"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).where((F.size("blocks") > 1) & (F.col("low") < F.col("high"))).drop("low", "high")
    met = looked_up(held, blocks, "key", "rows", held.count())

    def open_to(o):
        known = (o["low"] == F.col("component")) & (o["high"] == F.col("component"))
        apart = (o["most"] * 100 < F.col("size") * percent) | (F.col("size") * 100 < o["least"] * percent)
        return (o["block"] != F.col("block")) & ~known & ~apart

    others = F.transform(F.filter("blocks", open_to), lambda o: o["block"])
    met = met.select("doc_id", "node", "label", "block", "component", others.alias("others")).where(F.size("others") > 0)
    met = met.groupBy("doc_id", "node", "label", "block", "component").agg(F.array_distinct(F.flatten(F.collect_set("others"))).alias("others"))
    sent = met.withColumn("other", F.explode("others")).select(
        "doc_id", "node", "component", F.xxhash64("label", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    )
    sent = stored(sent, "sent-sets")
    discard(held)
    wanted = F.broadcast(sent) if sent.count() <= BROADCAST_ROWS else sent
    tasks = rows.join(wanted, "doc_id").select("task", "side", "node", F.col("component").alias("label"), "text")
    found = stored(links.unionByName(linked(tasks, n, percent)), "links")
    discard(sent, links, labels)
    return found
