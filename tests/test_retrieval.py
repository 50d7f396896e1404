import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from caseweave.functions import lexicon
from caseweave.operators import blocks, cases as case_ops, retrieval, similarity, tfidf
from caseweave.plans import triage as triage_plan

WORDS = "app crash login song playlist refund error phone music card été plan".split()


def _texts(n, seed, longest=12):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def _grams(text, stop=()):
    words = [w for w in re.findall(r"\w\w+", text.lower()) if w not in stop]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def _brute_fit(texts, min_df=2, max_df=0.95, limit=50_000, stop=()):
    counted = [_grams(t, stop) for t in texts]
    df, total = Counter(), Counter()
    for grams in counted:
        df.update(grams.keys())
        total.update(grams)
    kept = [t for t in df if min_df <= df[t] <= max_df * len(texts)]
    kept = sorted(kept, key=lambda t: (-total[t], t))[:limit]
    return {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}


def _brute_vector(text, idf, stop=()):
    raw = {t: (1 + math.log(n)) * idf[t] for t, n in _grams(text, stop).items() if t in idf}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / norm for t, w in raw.items()}


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)


def _vectors(spark, texts, model):
    rows = tfidf.postings(tfidf.transform(_docs(spark, texts), model), model).collect()
    found = {}
    for r in rows:
        found.setdefault(r["id"], {})[r["term"]] = r["weight"]
    return found


@pytest.mark.parametrize("params, stop", [
    ({}, ()), ({"min_df": 3, "max_df": 0.3, "max_features": 25}, ("app", "song")), ({"max_features": None}, ()),
])
def test_weights_equal_brute_force(spark, params, stop):
    texts = _texts(60, 1)
    model = tfidf.fit(_docs(spark, texts), tfidf.TfidfParams(**params, stop_words=stop))
    idf = _brute_fit(texts, params.get("min_df", 2), params.get("max_df", 0.95), params.get("max_features", 50_000), stop)
    assert {r["term"]: pytest.approx(r["idf"]) for r in model.vocabulary.collect()} == idf
    assert sorted(r["index"] for r in model.vocabulary.collect()) == list(range(model.size))
    found = _vectors(spark, texts, model)
    for i, text in enumerate(texts):
        assert found.get(i, {}) == pytest.approx(_brute_vector(text, idf, stop))


def test_large_vocabulary_path_numbers_terms_alike(spark, monkeypatch):
    texts = _texts(40, 2)
    expected = {r["term"]: r["index"] for r in tfidf.fit(_docs(spark, texts)).vocabulary.collect()}
    monkeypatch.setattr(tfidf, "SMALL_VOCABULARY", 3)
    assert {r["term"]: r["index"] for r in tfidf.fit(_docs(spark, texts)).vocabulary.collect()} == expected


def test_empty_and_unknown_texts_keep_their_row(spark):
    model = tfidf.fit(_docs(spark, _texts(40, 3)))
    rows = {r["id"]: r for r in tfidf.transform(_docs(spark, ["", None, "zzz yyy", "app"]), model).collect()}
    assert len(rows) == 4 and [len(rows[i]["indices"]) for i in range(4)] == [0, 0, 0, 1]


def test_keyword_scores_average_over_all_texts(spark):
    texts = _texts(50, 4)
    model, vectors = tfidf.fit_transform(_docs(spark, texts))
    idf = _brute_fit(texts)
    sums = Counter()
    for text in texts:
        for term, weight in _brute_vector(text, idf).items():
            sums[term] += weight
    got = {r["term"]: r["tfidf_score"] for r in tfidf.keyword_scores(vectors, model).collect()}
    assert got == pytest.approx({t: s / len(texts) for t, s in sums.items()})


def _expected_top(queries, cases, model_idf, k, intents=None):
    vectors = [_brute_vector(c, model_idf) for c in cases]
    found = {}
    for q, text in enumerate(queries):
        query = _brute_vector(text, model_idf)
        scored = []
        for c, vector in enumerate(vectors):
            sim = sum(w * vector.get(t, 0.0) for t, w in query.items())
            if intents is None:
                scored.append((-round(sim, blocks.DECIMALS), c))
            else:
                words = lexicon.INTENT_KEYWORDS.get(intents[q] or "", [])
                fit = sum(w in cases[c].lower() for w in words) / len(words) if words else 0.0
                scored.append((-round(0.75 * sim + 0.25 * fit, blocks.DECIMALS), c))
        found[q] = [(c, pytest.approx(-s, abs=1e-8)) for s, c in sorted(scored)[:k]]
    return found


def _collect(ranked, column):
    found = {}
    for r in sorted(ranked.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["case_id"], r[column]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_top_k_copies_no_vector_per_block_of_the_other_side(spark, monkeypatch):
    for name in ("CASE_ENTRIES", "QUERY_ENTRIES", "SMALL_PRODUCT"):
        monkeypatch.setattr(similarity, name, 20)
    rng = random.Random(4)
    rows = [(i, sorted(rng.sample(range(12), 4)), [0.5] * 4) for i in range(60)]
    cases = spark.createDataFrame(rows, "case_id long, indices array<int>, weights array<double>")
    ranked = similarity.top_k(cases.withColumnRenamed("case_id", "query_id"), cases, 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "CoGroup" not in plan
    common = [[len({*a[1]} & {*b[1]}) / 4 for b in rows] for a in rows]
    best = {i: sorted((-x, j) for j, x in enumerate(line))[:3] for i, line in enumerate(common)}
    assert _collect(ranked, "similarity") == {i: [(j, pytest.approx(-x)) for x, j in own] for i, own in best.items()}


def _packed_pair(query_table, case_table, block):
    own = case_table.filter(pc.equal(case_table["_block"], block))
    sides = blocks.pack_queries(query_table), blocks.pack_cases(own)
    return pa.table([c for side in sides for c in side.columns], [n for side in sides for n in side.column_names])


def test_a_task_keeps_k_rows_per_query_over_all_its_case_blocks():
    rng = random.Random(5)
    vectors = [sorted(rng.sample(range(10), 4)) for _ in range(40)]
    table = pa.table({
        "_block": pa.array([n * 7 % 5 for n in range(40)], pa.int32()), "case_id": pa.array(range(40), pa.int64()),
        "indices": pa.array(vectors, pa.list_(pa.int32())), "weights": pa.array([[0.5] * 4] * 40),
        "compatibility": pa.array([[]] * 40, pa.list_(pa.float64())),
    })
    asked = pa.table({
        "_block": pa.array([0] * 9, pa.int32()), "query_id": pa.array([*range(8), 7], pa.int64()),  # an id that comes twice
        "intent_index": pa.array([-1] * 9, pa.int32()), "indices": table["indices"].slice(0, 9), "weights": table["weights"].slice(0, 9),
    })
    pairs = [batch for block in range(5) for batch in _packed_pair(asked, table, block).to_batches()]
    # A block holds 8 cases, less than k; equal scores cross the blocks.
    found = [r for b in blocks.top_k_of_blocks(9, 1.0, 0.0)(iter(pairs)) for r in b.to_pylist()]
    assert len(found) == 9 * 9
    expected = []
    for query, own in zip([*range(8), 7], vectors):
        scored = sorted((-len({*own} & {*v}) / 4, n) for n, v in enumerate(vectors))[:9]
        expected += [(query, n, -score) for score, n in scored]
    assert [(r["query_id"], r["case_id"], pytest.approx(r["similarity"])) for r in found] == expected


def test_top_k_is_the_same_in_few_tasks(spark, monkeypatch):
    for name in ("CASE_ENTRIES", "QUERY_ENTRIES", "SMALL_PRODUCT"):
        monkeypatch.setattr(similarity, name, 20)
    rng = random.Random(6)
    rows = [(i, sorted(rng.sample(range(12), 4)), [0.5] * 4) for i in range(60)]
    cases = spark.createDataFrame(rows, "case_id long, indices array<int>, weights array<double>")
    queries, tops = cases.withColumnRenamed("case_id", "query_id"), []
    for tasks in (8, 1):
        monkeypatch.setattr(similarity, "TASKS", tasks)
        tops.append(sorted(similarity.top_k(queries, cases, 3).select("query_id", "rank", "case_id").collect()))
    assert tops[0] == tops[1] and len(tops[0]) == 180


@pytest.mark.parametrize("entries, rows, cells, expansion", [
    (10**6, 10**4, 10**6, 10**6), (50, 7, 10**6, 10**6), (200, 20, 64, 50),
])
def test_top_k_equals_brute_force_for_any_block_size(spark, monkeypatch, entries, rows, cells, expansion):
    monkeypatch.setattr(similarity, "CASE_ENTRIES", entries)
    monkeypatch.setattr(similarity, "QUERY_ENTRIES", entries)
    monkeypatch.setattr(similarity, "QUERY_ROWS", rows)
    monkeypatch.setattr(blocks, "CELLS", cells)
    monkeypatch.setattr(blocks, "EXPANSION", expansion)
    # Copies make ties, empty texts make queries without any similarity.
    cases = _texts(50, 5) + ["app crash"] * 6
    queries = _texts(17, 6) + ["", "app crash", "zzz"]
    model = tfidf.fit(_docs(spark, cases))
    query_table = _docs(spark, queries).withColumnsRenamed({"id": "query_id", "text": "query"})
    corpus = _docs(spark, cases).withColumnsRenamed({"id": "tweet_id", "text": "clean_text"})
    ranked = retrieval.retrieve_messages(query_table, corpus, model, 5)
    assert _collect(ranked, "similarity") == _expected_top(queries, cases, _brute_fit(cases), 5)


def test_intent_aware_retrieval_equals_brute_force(spark):
    cases, queries = [t for t in dict.fromkeys(_texts(40, 7)) if t], _texts(12, 8) + ["nothing here", ""]
    intents = ["APP_TECHNICAL", "ACCOUNT_LOGIN", "OTHER", None, "PLAYLIST_LIBRARY", "NO_SUCH_INTENT", "BILLING_PAYMENT"] * 2
    model = tfidf.fit(_docs(spark, cases))
    query_table = spark.createDataFrame(
        [(i, q, t) for i, (q, t) in enumerate(zip(queries, intents))], "query_id long, query string, intent string"
    )
    corpus = _docs(spark, cases).withColumnsRenamed({"id": "support_tweet_id", "text": "customer_text"})
    corpus = corpus.withColumn("support_text", F.lit("a reply"))
    ranked = retrieval.retrieve(query_table, corpus, model, 4)
    assert _collect(ranked, "combined_score") == _expected_top(queries, cases, _brute_fit(cases), 4, intents)


def test_retrieval_cites_answered_cases_of_distinct_questions(spark):
    rows = [(1, "app crash", ""), (2, "app crash", "restart"), (3, "app crash", "reinstall"), (4, "app crash login", None),
            (5, "login app", "reset"), (6, " ", "hello"), (7, None, "hello")]
    corpus = spark.createDataFrame(rows, "support_tweet_id long, customer_text string, support_text string")
    model = tfidf.fit(tfidf.document_text(corpus, "support_tweet_id", "customer_text"), tfidf.TfidfParams(max_df=1.0))
    query_table = spark.createDataFrame([(1, "app crash", None)], "query_id long, query string, intent string")
    ranked = retrieval.retrieve(query_table, corpus, model, 3)
    assert [r["case_id"] for r in ranked.orderBy("rank").collect()] == [2, 5]


def test_fewer_cases_than_k(spark):
    cases = ["app crash", "app crash login", "login app"]
    model = tfidf.fit(_docs(spark, cases), tfidf.TfidfParams(max_df=1.0))
    query_table = spark.createDataFrame([(1, "app"), (2, "")], "query_id long, query string")
    corpus = _docs(spark, cases).withColumnsRenamed({"id": "tweet_id", "text": "clean_text"})
    found = _collect(retrieval.retrieve_messages(query_table, corpus, model, 5), "similarity")
    assert {len(rows) for rows in found.values()} == {3}
    assert [c for c, _ in found[2]] == [0, 1, 2]


@pytest.mark.parametrize("values", [[0.5], [0.0, 1.0], [0.2, 0.2, 0.2, 0.9], list(np.random.default_rng(3).random(501)),
                                    [0.0] * 50 + [0.3, 0.30001, 0.30002]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert similarity.exact_median(df, "v").first()[0] == pytest.approx(float(np.median(values)), abs=1e-15)


def _turns(spark):
    rows = [
        ("b", 10, 1, 1, "customer", "My APP  crashes"), ("b", 10, 2, 2, "support", "Please\nreinstall"),
        ("b", 10, 3, 3, None, "system note"), ("b", 10, 4, 10, "support", "  "),
        ("b", 20, 1, 11, "support", "only support"),
        ("b", 30, 1, 21, "customer", "my app crashes"), ("b", 30, 2, 30, "support", "please reinstall"),
        ("c", 40, 1, 31, "customer", "other brand"),
    ]
    return spark.createDataFrame(
        rows, "brand string, support_tweet_id long, position long, tweet_id long, speaker string, text string"
    )


def test_cases_from_turns_and_threads(spark):
    cases = case_ops.cases_from_turns(_turns(spark), "B")
    rows = {r["support_tweet_id"]: r for r in cases.collect()}
    assert set(rows) == {10, 30}
    assert rows[10]["tweet_ids"] == [1, 2, 3]
    assert rows[10]["case_text"] == "my app crashes please reinstall"
    assert [r["support_tweet_id"] for r in case_ops.unique_cases(cases).collect()] == [10]
    golden = spark.createDataFrame([(2,)], "tweet_id long")
    assert [r["support_tweet_id"] for r in case_ops.without_overlap(cases, golden).collect()] == [30]
    threads = _turns(spark).where("brand = 'b'").groupBy("support_tweet_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "tweet_id", "speaker", "text"))).alias("conversation")
    )
    again = case_ops.cases_from_threads(threads).select(*cases.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, cases.collect()))


def test_triage_end_to_end(spark):
    cases = spark.createDataFrame([
        (1, "app keeps crashing on my phone error bug", "@1 please reinstall the app https://x"),
        (2, "app crashing error on phone", "restart it"),
        (3, "lost my playlist and saved songs", "we can restore it"),
        (4, "lost my playlist", None),
    ], "support_tweet_id long, customer_text string, support_text string")
    model = tfidf.fit(tfidf.document_text(cases, "support_tweet_id", "customer_text"), tfidf.TfidfParams(max_df=1.0))
    messages = spark.createDataFrame(
        [(1, "app keeps crashing error on phone"), (2, "someone hacked me"), (3, "zzz"), (4, "lost my playlist")],
        "query_id long, query string",
    )
    results = triage_plan.triage(messages, cases, model, top_k=2)
    assert results.columns == ["query_id", *triage_plan.RESULT_COLUMNS]
    rows = {r["query_id"]: r for r in results.collect()}
    assert rows[1]["action"] == "ANSWER" and rows[1]["grounded"]
    assert rows[1]["response"] in ("please reinstall the app", "restart it")
    assert (rows[2]["action"], rows[2]["needs_escalation"]) == ("ESCALATE", True)
    assert (rows[3]["action"], rows[3]["intent"]) == ("CLARIFY", "OTHER")
    assert rows[4]["intent"] == "PLAYLIST_LIBRARY" and len(rows[4]["retrieved_cases"]) == 2
    requests = messages.withColumnRenamed("query", "message").union(spark.createDataFrame([(5, "")], "query_id long, message string"))
    served, rejected = triage_plan.serve(requests, cases, model, top_k=1)
    assert "historical_cases" in served.columns and "retrieved_cases" not in served.columns
    assert {r["query_id"]: len(r["historical_cases"]) for r in served.collect()} == {1: 1, 2: 1, 3: 1, 4: 1}
    assert [r["query_id"] for r in rejected.collect()] == [5]


def test_triage_without_cases_clarifies(spark):
    cases = spark.createDataFrame([], "support_tweet_id long, customer_text string, support_text string")
    model = tfidf.fit(_docs(spark, _texts(20, 9)))
    messages = spark.createDataFrame([(1, "app song")], "query_id long, query string")
    row = triage_plan.triage(messages, cases, model).first()
    assert (row["action"], row["retrieval_similarity"], row["retrieved_cases"]) == ("CLARIFY", 0.0, [])


def test_transform_shuffles_a_row_per_text_and_not_per_term(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "TEXTS", 3)
    texts = _texts(20, 7) + ["", "the app the app", "zzz"]
    docs = _docs(spark, texts).unionByName(spark.createDataFrame([(0, "app crash"), (900, None)], "id long, text string"))
    params = tfidf.TfidfParams(min_df=1, max_df=1.0, stop_words=("the",))
    model, vectors = tfidf.fit_transform(docs, params)
    assert "Generate" not in vectors._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tfidf, "SMALL_VOCABULARY", 0)  # entries are joined and grouped instead
    expected = {r["id"]: r for r in tfidf.transform(docs, model).collect()}
    found = {r["id"]: r for r in vectors.collect()}
    assert found.keys() == expected.keys()
    for key, row in found.items():
        assert row["indices"] == expected[key]["indices"]
        assert row["weights"] == pytest.approx(expected[key]["weights"], abs=1e-12)
    counted = tfidf._exploded(tfidf.term_counts(docs, params.stop_words))
    totals = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, model.vocabulary.select("term", "df", "total").collect()))
