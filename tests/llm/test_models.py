import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseweave.llm import chunks, line_quality, mixing, queries, signature_trees, toxicity
from tests.llm.fixtures import awkward, clashing, documents, prose


def domain_rows(n=240):
    rows = []
    for i in range(n):
        kind = ("red", "green", "blue")[i % 12 // 4 if i % 12 < 9 else 0]
        rows.append((i, prose(i, 30 + i % 50) + f" {kind} {kind}ish " * 5, kind, "s", 0))
    return rows


WEIGHTS = {"red": 0.2, "green": 0.5, "blue": 0.3}


def fitted(spark, rows, **limits):
    docs = documents(spark, rows)
    labelled = docs.where("doc_id % 2 = 0").selectExpr("doc_id AS id", "lang AS domain")
    members = mixing.posteriors(clashing(docs), labelled, list(WEIGHTS))
    return mixing.fit_rates(members, WEIGHTS, **limits)


def test_rates_meet_the_targets(spark):
    rated, held, targets = fitted(spark, domain_rows(), most=50.0)
    rows = rated.collect()
    assert len(rows) == 240 and all(r["rate"] >= 0 and abs(sum(r["p"]) - 1) < 1e-5 for r in rows)
    total = np.sum([np.array(r["p"]) * r["n_tokens"] * r["rate"] for r in rows], axis=0)
    assert np.allclose(total, targets, rtol=1e-3) and np.allclose(held, targets, rtol=1e-3)
    assert np.allclose(total / total.sum(), list(WEIGHTS.values()), atol=1e-3)
    truth = {i: ("red", "green", "blue").index(kind) for i, _, kind, _, _ in domain_rows()}
    assert np.mean([int(np.argmax(r["p"])) == truth[r["id"]] for r in rows]) > 0.95


def test_rates_equal_plain_projected_gradient(spark):
    rated, _, targets = fitted(spark, domain_rows(), budget=9000.0, least=0.4, most=1.3, max_steps=12, tolerance=0.0)
    rows = rated.collect()
    p, n = np.array([r["p"] for r in rows]), np.array([r["n_tokens"] for r in rows])
    second = (p * n[:, None]).T @ p
    rate = np.ones(len(rows))
    for _ in range(12):
        off = (p * (n * rate)[:, None]).sum(axis=0) - targets
        rate = np.clip(rate - p @ np.linalg.solve(second, off), 0.4, 1.3)
    assert np.allclose(rate, [r["rate"] for r in rows], atol=1e-5)


def test_production_rates_meet_targets_far_from_the_shares(spark):
    kinds = ["blue"] * 8 + ["green"] * 24 + ["red"] * 368
    rows = [(i, prose(i, 30 + i % 50) + f" {kind} {kind}ish" * 8, kind, "s", 0) for i, kind in enumerate(kinds)]
    docs = documents(spark, rows)
    found = queries.language_rates(docs, docs.selectExpr("doc_id"), WEIGHTS).collect()
    total = np.sum([np.array(r["p"]) * r["n_tokens"] * r["rate"] for r in found], axis=0)
    assert np.allclose(total / total.sum(), list(WEIGHTS.values()), atol=1e-3)
    assert len(found) == len(rows) and max(r["rate"] for r in found) > 8 and min(r["rate"] for r in found) >= 0


def test_missed_targets_are_logged(spark, caplog):
    docs = documents(spark, domain_rows(60))
    members = mixing.posteriors(docs, docs.selectExpr("doc_id AS id", "lang AS domain"), list(WEIGHTS))
    _, held, targets = mixing.fit_rates(members, WEIGHTS, most=1.0)
    assert not np.allclose(held, targets, rtol=1e-2) and "targets missed" in caplog.text


def test_stored_steps_change_no_rate(spark, monkeypatch):
    limits = {"budget": 9000.0, "least": 0.4, "most": 1.3, "max_steps": 12, "tolerance": 0.0}
    whole = {r["id"]: r["rate"] for r in fitted(spark, domain_rows(), **limits)[0].collect()}
    monkeypatch.setattr(mixing, "FOLDED", 5)
    assert {r["id"]: r["rate"] for r in fitted(spark, domain_rows(), **limits)[0].collect()} == pytest.approx(whole, abs=2e-6)


def test_mixing_takes_documents_by_their_rates(spark):
    rated, _, _ = fitted(spark, domain_rows())
    docs = clashing(documents(spark, domain_rows()))
    taken = mixing.mix(docs, rated)
    assert taken.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    for r in rated.collect():
        assert counts.get(r["id"], 0) in (math.floor(r["rate"]), math.floor(r["rate"]) + 1)
    assert abs(sum(counts.values()) - rated.agg(F.sum("rate")).first()[0]) < 40


def test_mixing_of_odd_rows(spark):
    docs = documents(spark)
    labelled = docs.where("doc_id <= 11").selectExpr("doc_id AS id", "lang AS domain")
    members = mixing.posteriors(docs, labelled, ["en", "de", "fr"])
    found = {r["id"]: r for r in members.collect()}
    assert len(found) == len({r[0] for r in awkward()}) and found[4]["n_tokens"] == 0 and found[7]["n_tokens"] == 4
    rated, _, _ = mixing.fit_rates(members, {"en": 1.0, "de": 0.0, "fr": 1.0})
    assert rated.where("rate < 0 OR rate IS NULL").count() == 0 and mixing.mix(docs, rated).where("doc_id IS NULL").count() >= 0
    empty = documents(spark, [])
    none, held, _ = mixing.fit_rates(mixing.posteriors(empty, labelled.limit(0), ["en"]), {"en": 1.0})
    assert none.count() == 0 and held == [0.0]


def toxic_rows(n=400):
    rng = np.random.default_rng(2)
    roots = ["zorgul", "fimblat", "quaxner"]
    rows, labels = [], []
    for i in range(n):
        text, toxic = prose(3000 + i, int(rng.integers(20, 120))), int(i % 4 == 0)
        words = text.split(" ")
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(len(words))), roots[int(rng.integers(3))] + ["", "en", "ish", "ta"][int(rng.integers(4))])
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def machine(spark):
    rows, labels = toxic_rows()
    learned = spark.createDataFrame([x for x in labels if x[0] % 3], "id long, label int")
    return toxicity.train(clashing(documents(spark, rows)).drop("id"), learned)


def test_toxicity_on_held_out_documents(spark, machine):
    rows, labels = toxic_rows()
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, rows), machine).collect()}
    held = [(scored[i], y) for i, y in labels if i % 3 == 0]
    assert all(0 <= s <= 1 for s, _ in held)
    assert np.mean([s >= 0.7 for s, y in held if y]) >= 0.95 and np.mean([s >= 0.7 for s, y in held if not y]) <= 0.03


def test_toxicity_bears_gaps_and_inserted_characters(machine):
    scorer = toxicity.Scorer(machine)
    forms = ["zorgul", "Zorgul!", "zor*gul", "zorxgul", "z o r g u l", "fimblatten", "quaxxner"]
    got = machine.probability(scorer.texts([f"some words {form} here" for form in forms]))
    assert (got >= 0.7).sum() >= len(forms) - 1
    assert (machine.probability(scorer.texts(["some words here", "", None])) < 0.5).all()


def test_toxicity_of_odd_rows(spark, machine):
    assert toxicity.score(clashing(documents(spark)).drop("score"), machine).count() == len(awkward())
    assert toxicity.score(documents(spark, []), machine).count() == 0
    assert toxicity.train(documents(spark), spark.createDataFrame([], "id long, label int")) is None


def test_folded_machine_equals_the_kernel_machine():
    words, marks = ["zorgul", "prose", "zxorgul", "ab", "c"], ["zorgul", "paper", "rose"]
    values = toxicity.kernel(words, marks)
    weights = np.array([1.0, -2.0, 0.5])
    assert np.allclose(toxicity.sums(words, toxicity.landmark_table(marks, weights)), values @ weights, atol=1e-5)

    def plain(a, b):
        def features(word):
            codes = [0, *toxicity.char_classes(np.array([ord(c) for c in word])).tolist(), 0]
            out, norm = {}, 0.0
            for offsets in toxicity.patterns():
                for i in range(len(codes) - offsets[-1]):
                    w = toxicity.DECAY ** (offsets[-1] + 1 - toxicity.ORDER)
                    key = tuple(codes[i + o] for o in offsets)
                    out[key] = out.get(key, 0.0) + w
                    norm += w * w
            return out, max(norm, 1.0) ** -0.5

        (x, cx), (y, cy) = features(a), features(b)
        return cx * cy * sum(v * y.get(k, 0.0) for k, v in x.items())

    assert np.allclose(values, [[plain(a, b) for b in marks] for a in words], atol=1e-6)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, prose(i % 90 if i < 120 else 5000 + i, 60 + i % 40), ("en", "de", "es", "fr")[i % 4], "s", 0) for i in range(200)]
    documents(spark, rows + [(500 + k, *r[1:]) for k, r in enumerate(awkward())] + awkward()[-5:]).withColumn("extra", F.lit("x")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_pipeline_against_its_operators(spark, folder):
    docs = queries.table(spark, folder, "documents")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, tables[-1], folder)
        out.write.parquet(f"{folder}/{name}")
        tables.append(spark.read.parquet(f"{folder}/{name}"))
        if name != "encoding":
            assert out.columns == docs.columns
    _, good, single, cut, mixed, encoded = tables
    kept = {r["doc_id"] for r in line_quality.assess(docs).where("kept").select("row.doc_id").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept
    classes = [(r["doc_id"], r["component_id"]) for r in signature_trees.join(good, n=5, percent=80).collect()]
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in classes if i is None or i == c}
    lost = {r["doc_id"] for r in chunks.passages(single).where(F.size("lost") > 0).collect()}
    before, after = ({r["doc_id"]: r["text"] for r in t.collect()} for t in (single, cut))
    assert {i for i in before if after.get(i) != before[i]} <= lost
    assert {r["doc_id"] for r in mixed.collect()} == set(after) and mixed.count() >= cut.count()
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect() if r["doc_id"] in lost)
    import hashlib

    texts = sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in mixed.collect())
    assert sorted(r["decoded_sha256"] for r in encoded.collect()) == texts
    assert corpus_pipeline.run(spark, folder).count() == encoded.count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
