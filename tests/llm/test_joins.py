import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.llm import chunks, hamming, signature_trees
from caseweave.llm.components import components
from tests.llm.fixtures import awkward, clashing, documents, prose


def shingles(text, n):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_components(rows, n, percent):
    sets = {row[0]: shingles(row[1], n) for row in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return Counter((i, len(sets[i]), find(i)) for i in ids)


def changed(text, places, seed):
    words = text.split(" ")
    rng = np.random.default_rng(seed)
    for i in rng.choice(len(words), places, replace=False):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


def near_rows():
    rows = []
    for size in (8, 20, 40, 120, 160, 500):  # around every way of dealing
        for family in range(3):
            base = prose(1000 * size + family, size)
            for i, places in enumerate((0, 0, 1, 1, 2, 3, max(1, size // 60), max(1, size // 50), size // 40, size // 30, size // 20)):
                rows.append((len(rows) + 100, changed(base, min(places, size), i), "en", "s", 0))
    for i in range(10):  # lengths that grow
        rows.append((900 + i, prose(77, 100 + 9 * i), "en", "s", 0))
    unique = {r[0]: r for r in awkward() if r[0] is not None}
    return rows + list(unique.values())


@pytest.mark.parametrize(("n", "percent", "block"), [(4, 85, 4_000_000), (4, 85, 400), (5, 80, 4_000_000), (2, 60, 1500)])
def test_signature_trees_against_brute_force(spark, n, percent, block):
    rows = near_rows()
    got = signature_trees.join(clashing(documents(spark, rows)), n=n, percent=percent, block=block).collect()
    assert Counter(map(tuple, got)) == brute_components(rows, n, percent)


def test_signature_trees_with_shuffled_texts_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(signature_trees, "BROADCAST_ROWS", -1)
    got = Counter(map(tuple, signature_trees.join(documents(spark)).collect()))
    assert sum(got.values()) == len(awkward())
    found = {r[0]: r for r in got}
    assert found[1][2] == found[2][2] == 1 and found[3][2] == 1 and got[7, 1, 7] == 2 and found[13][2] == 7
    assert found[4] == (4, 0, 4) and found[5] == (5, 0, 5) and found[6] == (6, 0, 6)
    assert (None, 0, None) in got and found[12][2] == 12
    assert signature_trees.join(documents(spark, [])).count() == 0


def test_sets_go_once_and_only_to_blocks_of_near_sizes(spark, monkeypatch):
    kept, sent = signature_trees.stored, []
    monkeypatch.setattr(signature_trees, "stored", lambda df, name: sent.extend(df.collect() if name == "sent-sets" else []) or kept(df, name))
    large = [(1, 11, 7, 0, 10), (2, 12, 7, 1, 10), (3, 13, 7, 2, 30), (4, 14, 7, 3, 9)]  # the third is too large for the others
    frame = spark.createDataFrame(large, "node long, doc_id long, label long, block int, n long")
    shared = spark.createDataFrame([(row[0], key, 4) for row in large for key in (5, 6, 8)], "node long, key long, n long")
    links = kept(spark.createDataFrame([(4, 2)], "a long, b long"), "links")  # the last is linked to the second already
    rows = spark.createDataFrame([(row[1], "a text") for row in large], "doc_id long, text string")
    signature_trees.across_blocks(rows, frame, shared, links, 4, 85)
    met = defaultdict(list)
    for row in sent:
        met[row["task"]].append(row["node"])
    assert sorted(map(sorted, met.values())) == [[1, 2], [1, 4]]


def test_trees_prune_and_agree():
    rng = np.random.default_rng(3)
    sets = []
    for family in range(30):
        base = rng.integers(0, 2**63, 60 + 20 * (family % 5), dtype=np.uint64)
        sets += [np.unique(np.concatenate([base[: len(base) - k], rng.integers(0, 2**63, k, dtype=np.uint64)])) for k in (0, 2, 5, 9, 14)]
    linker = signature_trees.Linker(np.arange(len(sets)), 85)
    tree = signature_trees.Tree(sets, np.arange(len(sets)))
    linker.run(tree, tree)
    expected = np.arange(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(np.intersect1d(a, sets[j]))
            if 100 * shared >= 85 * (len(a) + len(sets[j]) - shared):
                expected[expected == expected[i]] = expected[j]
    def classes(labels):
        return {frozenset(np.flatnonzero(labels == x).tolist()) for x in set(labels.tolist())}

    assert classes(linker.labels) == classes(expected)
    assert linker.compared < len(sets) * 4  # of the 11,175 pairs


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 80)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def passage_rows():
    passage = prose(9, 52).replace("\n", " ")
    rows = [(i, prose(500 + i, 60 + 7 * i) + " " + (passage if i % 3 == 0 else "") + " " + prose(700 + i, 80), "en", "s", 0) for i in range(30)]
    return passage, rows


def test_passages_are_found_and_clean_documents_left_alone(spark):
    passage, rows = passage_rows()
    found = chunks.passages(clashing(documents(spark, rows))).collect()
    assert {r["doc_id"] for r in found} == {r[0] for r in rows if r[0] % 3 == 0}
    texts = {r[0]: r[1].encode() for r in rows}
    for r in found:
        assert texts[r["doc_id"]][r["start"] : r["stop"]].decode().strip() in passage and r["n_words"] >= 22 and r["first_doc_id"] == 0
        assert bool(r["lost"]) == (r["doc_id"] != 0)


def test_deduplicated_texts(spark, monkeypatch):
    _, rows = passage_rows()
    df = clashing(documents(spark, rows + [(100 + r[0], *r[1:]) for r in awkward() if r[0] is not None]))
    kept = chunks.deduplicated(df)
    assert kept.columns == df.columns
    out = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    texts = {r[0]: r[1] for r in rows}
    for (doc_id, text), n in out.items():
        if doc_id in texts and (doc_id % 3 or doc_id == 0):
            assert text == texts[doc_id] and n == 1
        elif doc_id in texts:
            assert len(text) < len(texts[doc_id]) - 100 and text[:300] == texts[doc_id][:300] and text[-300:] == texts[doc_id][-300:]
    assert out[104, None] == 1 and out[105, ""] == 1 and out[107, "one two"] == 2
    assert (102, awkward()[1][1]) not in out  # a copy loses all but its first words, which no cut ends
    monkeypatch.setattr(chunks, "BROADCAST_ROWS", -1)
    assert Counter((r["doc_id"], r["text"]) for r in chunks.deduplicated(df).collect()) == out
    assert chunks.deduplicated(documents(spark, [])).count() == 0


def test_chunks_resist_insertions():
    chunker = chunks.Chunker()
    text = prose(4, 2000).encode()
    before = chunker([text])[1].tolist()
    after = chunker([b"put in front " + text[:5000] + b" put in " + text[5000:]])[1].tolist()
    assert len(set(before) - set(after)) <= 6 and len(set(after) - set(before)) <= 8


def unspaced(seed, n):
    return "".join(map(chr, np.random.default_rng(seed).integers(0x4E00, 0x9FA5, n)))


def test_chunks_of_unspaced_text_resist_insertions():
    chunker, text = chunks.Chunker(), unspaced(1, 4000)
    before = chunker([text.encode()])[1].tolist()
    after = chunker([(unspaced(2, 1) + text[:1500] + unspaced(3, 2) + text[1500:]).encode()])[1].tolist()
    assert len(before) > 200 and len(set(before) - set(after)) <= 6 and len(set(after) - set(before)) <= 8


def test_unspaced_passages_are_found_and_removed(spark):
    passage = unspaced(5, 400)
    rows = [(i, unspaced(10 + i, 100 + 7 * i) + (passage if i % 3 == 0 else "") + unspaced(40 + i, 150), "zh", "s", 0) for i in range(9)]
    rows += [(20 + i, f"few{i}" + " " * 3000 + f"words{i}", "en", "s", 0) for i in range(2)]  # white space is no passage
    found = chunks.passages(documents(spark, rows)).collect()
    assert {r["doc_id"] for r in found} == {0, 3, 6} and all(r["stop"] - r["start"] > 900 for r in found)
    texts = {r["doc_id"]: r["text"] for r in chunks.deduplicated(documents(spark, rows)).collect()}
    assert all(texts[i] == text if i not in (3, 6) else len(texts[i]) < len(text) - 300 for i, text, *_ in rows)
    assert not any("\ufffd" in t for t in texts.values())


def test_chunks_of_a_text_do_not_depend_on_its_neighbours():
    chunker = chunks.Chunker()
    texts = [(r[1] or "").encode() for r in awkward()]
    counts, digests, sizes, words = chunker(texts)
    assert [sum(sizes[a:b]) for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts), strict=True)] == [len(t) for t in texts]
    assert sum(words) == sum(len(t.split()) for t in texts)
    assert digests.tolist() == [d for t in texts for d in chunker([t])[1].tolist()]
    assert max(sizes) <= chunks.MOST + 3


VECTORS = "vec_id long, embedding array<float>, label int"


def brute_neighbours(rows, k):
    sound = {}
    for vec_id, vector, _ in rows:
        if vec_id is None or vector is None or len(vector) != 16 or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        vector = [float(np.float32(x)) for x in vector]
        sound[vec_id] = min(sound.get(vec_id, vector), vector)
    ids = np.array(sorted(sound))
    matrix = np.array([sound[i] for i in ids])
    out = {}
    for i in ids[ids % 20 == 0]:
        score = (matrix * sound[i]).sum(axis=1)
        others = np.flatnonzero(ids != i)
        order = others[np.lexsort((ids[others], -score[others]))][:k]
        out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def vector_rows(n=600, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=16) * rng.uniform(0.5, 2)], 0) for i in range(n)]
    rows += [(n + i, rows[0][1], 0) for i in range(30)]  # copies tie
    nan, inf = float("nan"), float("inf")
    odd = [None, [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 7, []]
    return rows + [(2000 + 20 * i, v, 1) for i, v in enumerate(odd)] + [(None, rows[1][1], 0), (20, rows[20][1], 0), (40, rows[3][1], 0)]


def test_neighbours_are_found(spark, monkeypatch):
    monkeypatch.setattr(hamming, "VECTOR_BLOCK", 200)
    monkeypatch.setattr(hamming, "QUERY_BLOCK", 10)
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).withColumn("vector", F.lit("mine")).withColumn("block", F.lit(1))
    got = defaultdict(list)
    for r in sorted(hamming.search(df, F.col("vec_id") % 20 == 0, k=20).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    expected = brute_neighbours(rows, 20)
    assert got.keys() == expected.keys() and all(len(v) == 20 for v in got.values())
    true = {i: dict(v) for i, v in brute_neighbours(rows, 10_000).items()}
    for i, own in got.items():
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and all(abs(true[i][j] - s) < 1e-12 for j, s in own)
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in expected[i]}) for i in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_few_vectors(spark):
    rows = vector_rows(9)[:9]
    got = [tuple(r)[:3] for r in hamming.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 4 == 0).select("query_id", "rank", "vec_id").collect()]
    assert Counter(q for q, _, _ in got) == {0: 8, 4: 8, 8: 8}
    assert hamming.search(spark.createDataFrame(rows[:1], VECTORS), F.col("vec_id") == 0).count() == 0
    assert hamming.search(spark.createDataFrame([], VECTORS), F.col("vec_id") == 0).count() == 0


def test_every_code_within_the_radius_is_retrieved():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, (500, 4), dtype=np.uint16)
    codes[250:] = codes[:250] ^ rng.integers(0, 4, (250, 4), dtype=np.uint16)
    index = hamming.Index(codes)
    for radius in (0, 3, 7, 12, 25, 64):
        masks = hamming.probe_masks(radius, 4)
        for code in codes[:20]:
            expected = np.flatnonzero(hamming.distances(codes, code) <= radius)
            assert np.array_equal(index.within(code, radius, masks), expected)
