import random

import pytest
from pyspark.sql import functions as F

from caseweave.functions import lexicon
from caseweave.operators import blocks, postings, retrieval, similarity, tfidf
from caseweave.plans import triage as triage_plan


def _vectors(spark, rows, name, extra="int"):
    """Rows (id, {term: weight}, extra) as unit vectors."""
    packed = []
    for key, weights, own in rows:
        norm = sum(w * w for w in weights.values()) ** 0.5
        terms = sorted(weights)
        packed.append((key, terms, [weights[t] / norm for t in terms], own))
    column = "intent_index" if name == "query_id" else "compatibility"
    return spark.createDataFrame(packed, f"{name} long, indices array<int>, weights array<double>, {column} {extra}").repartition(3)


def _tables(seed, n_queries=40, n_cases=160, vocabulary=60):
    """Zipf-like terms, copies that tie, empty vectors, compatibilities that repeat."""
    rng = random.Random(seed)

    def weights(longest):
        terms = {min(int(rng.paretovariate(0.7)) - 1, vocabulary - 1) for _ in range(rng.randint(0, longest))}
        return {t: rng.choice([0.3, 1.0, 2.5]) for t in terms}

    queries = [(q, weights(9), rng.choice([-1, 0, 1, 2])) for q in range(n_queries)] + [(900, {}, 0), (901, {}, -1), (902, {9999: 1.0}, 1)]
    cases = [(c, weights(14), [rng.choice([0.0, 0.25, 0.5, 1.0]), 0.0, rng.choice([0.0, 1.0])]) for c in range(n_cases)]
    cases += [(n_cases + c, cases[c][1], cases[c][2]) for c in range(30)]
    return queries, cases


def _expected(queries, cases, k, ws, wc):
    norm = lambda w: sum(x * x for x in w.values()) ** 0.5 or 1.0
    found = {}
    for q, own, intent in queries:
        scored = []
        for c, other, compat in cases:
            sim = sum(w * other.get(t, 0.0) for t, w in own.items()) / (norm(own) * norm(other))
            fit = compat[intent] if 0 <= intent < len(compat) else 0.0
            scored.append((-round(ws * sim + wc * fit, blocks.DECIMALS), c, sim, fit))
        found[q] = [(c, pytest.approx(sim, abs=1e-9), fit) for _, c, sim, fit in sorted(scored)[:k]]
    return found


def _found(ranked):
    found = {}
    for r in sorted(ranked.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(found.setdefault(r["query_id"], [])) + 1
        found[r["query_id"]].append((r["case_id"], r["similarity"], r["intent_compatibility"]))
    return found


@pytest.mark.parametrize(("k", "ws", "wc"), [(3, 0.75, 0.25), (5, 1.0, 0.0), (4, 0.0, 1.0), (250, 0.5, 0.5)])
@pytest.mark.parametrize(("least", "slice_", "seeds"), [(16, 50_000, 256), (2, 7, 5)])
def test_search_equals_brute_force(spark, monkeypatch, k, ws, wc, least, slice_, seeds):
    for name, value in (("LEAST", least), ("SLICE", slice_), ("SEEDS", seeds)):
        monkeypatch.setattr(postings, name, value)
    queries, cases = _tables(k)
    index = postings.build(_vectors(spark, cases, "case_id", "array<double>"), depth=k)
    got = _found(postings.search(_vectors(spark, queries, "query_id"), index, k, ws, wc))
    assert got == _expected(queries, cases, k, ws, wc)


def test_search_of_common_terms_shuffles_no_products(spark, monkeypatch):
    monkeypatch.setattr(postings, "FEW_PRODUCTS", 0)
    cases = [(c, {0: 1.0, 1: 1.0 + c % 3, 2 + c % 5: 2.0}, [c % 2 / 2]) for c in range(120)]
    queries = [(q, {0: 1.0, 1: 2.0, 2 + q % 5: 1.0}, q % 2 - 1) for q in range(40)]
    index = postings.build(_vectors(spark, cases, "case_id", "array<double>"), depth=3)
    ranked = postings.search(_vectors(spark, queries, "query_id"), index, 3, 0.75, 0.25)
    assert "CartesianProduct" in ranked._jdf.queryExecution().executedPlan().toString()
    assert _found(ranked) == _expected(queries, cases, 3, 0.75, 0.25)
    rare = [(q, {2 + q: 1.0, 1000 + q: 2.0}, -1) for q in range(5)]  # few postings share a term with them
    ranked = postings.search(_vectors(spark, rare, "query_id"), index, 3)
    assert "CartesianProduct" not in ranked._jdf.queryExecution().executedPlan().toString()
    assert _found(ranked) == _expected(rare, cases, 3, 1.0, 0.0)


def test_top_k_takes_the_index_beyond_a_small_product(spark, monkeypatch):
    queries, cases = _tables(11)
    q, c = _vectors(spark, queries, "query_id"), _vectors(spark, cases, "case_id", "array<double>")
    small = _found(similarity.top_k(q, c, 3, 0.75, 0.25))
    monkeypatch.setattr(similarity, "SMALL_PRODUCT", 0)
    large = similarity.top_k(q, c, 3, 0.75, 0.25)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" not in plan
    assert _found(large) == {i: [(x, pytest.approx(s, abs=1e-9), f) for x, s, f in own] for i, own in small.items()}


def test_no_cases_and_no_queries(spark):
    queries, cases = _tables(2)
    none = postings.build(_vectors(spark, cases, "case_id", "array<double>").limit(0), depth=3)
    assert postings.search(_vectors(spark, queries, "query_id"), none, 3).count() == 0
    index = postings.build(_vectors(spark, cases, "case_id", "array<double>"), depth=3)
    assert postings.search(_vectors(spark, queries, "query_id").limit(0), index, 3).count() == 0
    with pytest.raises(ValueError):
        postings.search(_vectors(spark, queries, "query_id"), index, 4)


def _grown(copies):
    """Topics of their own terms beside three terms that all cases share."""
    rng = random.Random(3)
    rows = []
    for topic in range(20 * copies):
        for _ in range(12):
            own = {100 + 10 * topic + rng.randrange(10): 3.0 for _ in range(5)}
            rows.append((len(rows), own | {t: 0.4 for t in range(3)}, [0.0]))
    return rows


def test_candidates_grow_with_what_can_be_among_the_best(spark):
    queries = [(q, {100 + 10 * q: 3.0, 101 + 10 * q: 2.0, 102 + 10 * q: 2.0, 0: 0.4, 1: 0.4}, -1) for q in range(20)]
    counts = []
    for copies in (1, 4):
        rows = _grown(copies)
        index = postings.build(_vectors(spark, rows, "case_id", "array<double>"), depth=3)
        counts.append(postings.candidates(_vectors(spark, queries, "query_id"), index, 3).count())
    assert counts[1] <= 1.2 * counts[0] < 20 * 12 * 20 / 10  # all pairs share the three terms


def test_a_kept_index_is_versioned_and_read_by_folder(spark, tmp_path):
    queries, cases = _tables(5)
    path = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        postings.load(spark, path)
    postings.build(_vectors(spark, cases[:50], "case_id", "array<double>"), path, depth=3, folders=16)
    postings.build(_vectors(spark, cases, "case_id", "array<double>"), path, depth=3, folders=16)
    (tmp_path / "index" / "version=3" / "postings").mkdir(parents=True)  # a version that was never completed
    index = postings.load(spark, path)
    got = _found(postings.search(_vectors(spark, queries, "query_id"), index, 3, 0.75, 0.25))
    assert got == _expected(queries, cases, 3, 0.75, 0.25)
    old = postings.load(spark, path, version=1)
    assert _found(postings.search(_vectors(spark, queries, "query_id"), old, 3)) == _expected(queries, cases[:50], 3, 1.0, 0.0)
    wanted = spark.createDataFrame([(7,), (9,)], "term int")
    read = index.of_terms(wanted)
    folders = {r[0] for r in wanted.select(postings._folder(16)).collect()}
    assert {r[0] for r in read.select("folder").distinct().collect()} <= folders
    assert "PartitionFilters: [folder" in read._jdf.queryExecution().executedPlan().toString().replace("isnotnull", "folder")
    assert len({f.split("folder=")[1].split("/")[0] for f in read.inputFiles()}) == len(
        {f.split("folder=")[1].split("/")[0] for f in index.postings.inputFiles()}
    )  # inputFiles lists all folders; only the filter above prunes them


def test_triage_with_an_index_reads_no_case_vector_anew(spark, tmp_path):
    cases = spark.createDataFrame(
        [(1, "app crash error", "reinstall"), (2, "app crash bug", "restart"), (3, "lost playlist", "restore"), (4, "app crash error", "no")],
        "support_tweet_id long, customer_text string, support_text string",
    )
    model = tfidf.fit(tfidf.document_text(cases, "support_tweet_id", "customer_text"), tfidf.TfidfParams(max_df=1.0))
    index = retrieval.index_cases(cases, model, str(tmp_path / "index"))
    messages = spark.createDataFrame([(1, "app crash"), (2, "zzz"), (3, "lost my playlist")], "query_id long, query string")
    plain = triage_plan.triage(messages, cases, model, top_k=2)
    indexed = triage_plan.triage(messages, cases, model, top_k=2, index=index)
    columns = [c for c in plain.columns if not c.startswith("retrieved_cases")]
    key = lambda df: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.select(*columns).collect())
    assert key(plain) == key(indexed)
    assert len(lexicon.INTENT_KEYWORDS) == index.leaders.where("intent_index >= 0").select(F.countDistinct("intent_index")).first()[0]
