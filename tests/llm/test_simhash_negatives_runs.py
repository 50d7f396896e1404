import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from caseweave.llm import hot, negatives, runs, simhash
from tests.llm.fixtures import awkward, clashing, documents, prose

VECTORS = "vec_id long, embedding array<float>, label int"


# --- SimHash -----------------------------------------------------------------------------------------------------------

def brute_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, radius=3):
    """Smallest id reachable over links, for (id, fingerprint) pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (own, _) in enumerate(prints):
        if own is not None:
            least[find(i)] = min(least.get(find(i), own), own)
    return Counter((own, f"{p:016x}", least.get(find(i))) for i, (own, p) in enumerate(prints))


def simhash_rows():
    rows = awkward() + [(50 + i, "q" * i, "en", "s", 0) for i in range(3)]
    for family in range(12):
        words = prose(family, 300).split()
        for i in range(6):
            rng = random.Random(100 * family + i)
            own = list(words)
            for _ in range(i):
                own[rng.randrange(len(own))] = f"w{rng.random()}"
            rows.append((100 + len(rows), " ".join(own), "en", "s", 0))
    return rows


@pytest.mark.parametrize(("bucket", "broadcast"), [(simhash.BUCKET, 500_000), (3, 500_000), (3, 0)])
def test_simhash_against_brute_force(spark, monkeypatch, bucket, broadcast):
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(simhash, "BUCKET", 64)  # keeps the last level of splits small
    rows = simhash_rows()
    got = simhash.join(clashing(documents(spark, rows)), bucket=bucket)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == brute_classes([(r[0], brute_fingerprint(r[1])) for r in rows])


def test_simhash_of_no_rows(spark):
    assert simhash.join(documents(spark, [])).count() == 0


def test_fingerprints_of_very_long_texts_do_not_depend_on_pieces():
    text = prose(9, 3000) * 400  # some 8 MB
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    short = prose(8, 500).encode()
    assert {simhash.fingerprint(short, size=size) for size in (1, 7, 100, 1 << 20)} == {brute_fingerprint(short.decode())}
    assert simhash.fingerprint(b"x" * 3_000_000) == brute_fingerprint("x" * 3_000_000)


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 200, 20])
def test_hot_buckets_lose_no_link(spark, bucket):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(700):  # most agree in most bits, so whole buckets are hot
        value = rng.choice([centre, *list(prints)[:40]])
        for _ in range(rng.randrange(1, 7)):
            value ^= 1 << rng.randrange(64)
        prints.add(value)
    prints |= {rng.getrandbits(64) for _ in range(100)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "node long"), bucket=bucket).collect()
    assert len(edges) < 60 * len(prints)  # not all pairs
    parent = {s: s for s in signed}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        parent[find(a)] = find(b)
    wanted = brute_classes([(s, s & (2**64 - 1)) for s in signed])
    classes = {}
    for s in signed:
        classes.setdefault(find(s), []).append(s)
    assert {frozenset(c) for c in classes.values()} == {
        frozenset(s for s, _, c in wanted if c == least) for least in {c for _, _, c in wanted}
    }


def test_levels_share_blocks_and_end_in_small_buckets():
    found = simhash.levels()
    assert all(len(masks) == 4 ** (i + 1) for i, masks in enumerate(found)) and 64 - min(map(len, found[-1])) <= 12
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        for masks in found:
            assert any(not (a ^ b) & (simhash.mask_of(bits) & (2**64 - 1)) for bits in masks)


def test_lookup_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(hot, "FREQUENT", 4)
    rows = spark.createDataFrame([(i, i % 3 if i < 60 else i) for i in range(100)], "at long, key long")
    values = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("at").alias("least"))
    got = hot.looked_up(rows, values, "key", "n", 100).collect()
    assert sorted((r["at"], r.least) for r in got) == [(i, i % 3 if i < 60 else i) for i in range(100)]


# --- Hard negatives ----------------------------------------------------------------------------------------------------

def brute_negatives(rows, every=100, k=5):
    best = {}
    for vec_id, vec, label in rows:
        if vec_id is None or vec is None or label is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        own = ((label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in vec])
        best[vec_id] = min(best.get(vec_id, own), own)
    width = max((len(v) for _, v in best.values()), default=0)
    full = {i: np.array(v + [0] * (width - len(v)), object) for i, (_, v) in best.items()}
    out = Counter()
    for a in best:
        if a % every:
            continue
        scored = sorted((-int((full[a] * full[b]).sum()), b) for b in best if b != a)
        positives = [(i, -s) for s, i in scored if best[i][0] == best[a][0]][:k]
        for p, top in positives:
            fits = [(i, -s) for s, i in scored if best[i][0] != best[a][0] and 80 * top <= -100 * s <= 100 * top][:k]
            out.update((a, p, rank, i, top, s) for rank, (i, s) in enumerate(fits, 1))
    return out


def vector_rows(n=900, width=6, seed=2, clusters=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(clusters)] + 0.2 * rng.normal(size=width)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v) * rng.choice([0.5, 1, 1.3])], int(rng.integers(4))))
    same = rows[5][1]
    rows += [(n + i, same, i % 3) for i in range(80)]  # copies: ties everywhere
    rows += [
        (2000, None, 1), (2001, [1.0] * width, None), (None, [1.0] * width, 1), (2002, [1.0, None, *[0.0] * (width - 2)], 1),
        (2003, [float("nan")] * width, 1), (2004, [float("inf")] * width, 2), (2100, [0.0] * width, 1), (2200, [], 2),
        (2300, [0.5, 0.5], 3), (100, rows[100][1], rows[100][2]), (200, [0.1] * width, 0),
    ]
    return rows


def mined(df, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(df, F.col("vec_id") % 100 == 0, label, **options)


@pytest.mark.parametrize(("leaf", "ways", "chunk", "group"), [(4096, 16, 65_536, 8_192), (40, 4, 50, 3)])
def test_negatives_against_brute_force(spark, monkeypatch, leaf, ways, chunk, group):
    for name, value in (("LEAF_ROWS", leaf), ("WAYS", ways), ("CHUNK", chunk), ("GROUP", group), ("PACKED", 2), ("CELLS", 300)):
        monkeypatch.setattr(negatives, name, value)
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("vec", "leaf", "rank", "chunk", "score", "anchor_id"):
        df = df.withColumn(name, F.lit("mine"))
    assert Counter(map(tuple, mined(df).collect())) == brute_negatives(rows)


def test_negatives_of_no_rows_and_of_few(spark):
    assert mined(spark.createDataFrame([], VECTORS)).count() == 0
    few = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 2), (2, [0.95, 0.1], 1)]  # the label of 0 becomes 2
    assert Counter(map(tuple, mined(spark.createDataFrame(few, VECTORS)).collect())) == brute_negatives(few)


def test_tree_eliminates_leaves_and_keeps_what_is_needed(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF_ROWS", 30)
    rows = vector_rows(3000, 4, clusters=60)
    label = F.col("label")
    tree, placed = negatives.planted(negatives.admitted(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding", label))
    table = placed.toArrow()
    vec, leaf = negatives.matrix(table["vec"], tree.width), table["leaf"].to_numpy()
    scores = negatives.inner(vec[:200], vec)
    low = np.sort(scores, axis=1)[:, [-6]]
    alive = tree.surviving(vec[:200], low, low + 10**6)
    for i in range(200):
        assert alive[i, leaf[scores[i] >= low[i]]].all()
    assert alive.mean() < 0.2


def test_inner_products_are_exact_at_any_size():
    for big in (10, 1 << 28, 1 << 40):
        a, b = np.array([[big, -3, big - 1]]), np.array([[big, big, 7], [1, 2, 3]])
        wanted = [min(sum(int(x) * int(y) for x, y in zip(a[0], row)), 1 << 62) for row in b]
        assert negatives.inner(a, b)[0].tolist() == wanted


# --- Runs --------------------------------------------------------------------------------------------------------------

def brute_runs(w, least=24, times=3):
    n, out = len(w), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            size = i - s + p
            seg = w[s : s + size]
            if size >= max(least, times * p) and all(seg[q:] != seg[: size - q] for q in range(1, p)):
                out.append((s, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, size, p in found for i in range(s + p, s + size)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def run_rows():
    rng = random.Random(6)
    rows = [r for r in awkward() if r[0] != 9]
    for i in range(150):
        words = [rng.choice("abcdefghij" if i % 3 else "ab") for _ in range(rng.randrange(1, 120))]
        for _ in range(3):
            at, p, size = rng.randrange(len(words)), rng.randrange(1, 12), rng.randrange(10, 60)
            words[at : at + size] = [words[min(at + j % p, len(words) - 1)] for j in range(len(words[at : at + size]))]
        rows.append((1000 + i, rng.choice([" ", "\n", " \t"]).join(words), "en", "s", 0))
    return rows


def test_runs_against_brute_force(spark):
    rows = run_rows()
    got = runs.find(clashing(documents(spark, rows))).collect()
    assert Counter(map(tuple, got)) == Counter(brute_row(r[0], r[1]) for r in rows)
    assert sum(r.n_runs > 0 for r in got) > 40 and max(r.n_runs for r in got) > 1


def test_runs_of_no_rows(spark):
    assert runs.find(documents(spark, [])).count() == 0


@pytest.mark.parametrize(("least", "times"), [(24, 3), (4, 2), (6, 3)])
def test_automaton_finds_all_runs(least, times):
    rng = random.Random(least)
    for trial in range(400):
        words = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(70))]
        if len(words) > 3 and trial % 2:
            at, p = rng.randrange(len(words)), rng.randrange(1, 9)
            words = words[:at] + [words[at + (i - at) % p] if at + p <= len(words) else words[at] for i in range(at, len(words))]
        assert runs.runs(words, least, times) == brute_runs(words, least, times)


def test_stretches_hold_all_runs_and_pass_over_prose():
    words = [hash(w) % 2**31 for w in prose(1, 3000).split()]
    assert runs.stretches(np.array(words)) == []
    words[700:760] = words[700:705] * 12
    assert [(a <= 700, b >= 760) for a, b in runs.stretches(np.array(words))] == [(True, True)]


def test_runs_of_a_very_long_text():
    words = [b"a"] * 300_000 + [b"%d" % i for i in range(300_000)] + [b"x", b"y"] * 50_000
    n_runs, start, length, period, exponent, listed, kept = runs.summary(words)
    assert (n_runs, start, length, period, exponent) == (2, 0, 300_000, 1, 300_000_000)
    assert listed == b"0,300000,1\n600000,100000,2\n" and len(kept) == 300_003
