import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave import session
from caseweave.operators import blocks, classify, clusters, labels, metrics, regression, tfidf


def _labelled(spark):
    topics = {"APP": "app crash error bug freeze", "SONG": "song music play track album", "PAY": "card refund money charge"}
    rows = []
    for n in range(60):
        label = ["APP", "SONG", "PAY"][n % 3]
        words = topics[label].split()
        rows.append((n, " ".join(words[(n + j) % len(words)] for j in range(3)) + " please", label))
    rows += [(100, "lonely text", "RARE"), (101, None, "APP"), (102, "text", None)]
    return spark.createDataFrame(rows, "id long, text string, intent string")


def test_model_learns_saves_and_loads(spark, tmp_path):
    data = _labelled(spark)
    model = classify.fit(data, max_iter=50)
    assert model.labels.labels == ["APP", "PAY", "SONG"]
    seen = data.where("id < 100")
    rows = classify.predict(seen.select("id", "text"), model).join(seen.withColumnRenamed("intent", "gold"), "id").collect()
    assert len(rows) == 60 and all(r["intent"] == r["gold"] for r in rows)
    assert all(0 <= r["confidence"] <= 1 and r["source"] == "ml" for r in rows)
    model.save(str(tmp_path / "model"))
    again = classify.IntentModel.load(spark, str(tmp_path / "model"))
    before = classify.predict(seen.select("id", "text"), model).orderBy("id").collect()
    assert classify.predict(seen.select("id", "text"), again).orderBy("id").collect() == before


def test_training_texts_are_dealt_to_tasks_by_their_length(spark, monkeypatch):
    data, seen, real = _labelled(spark), [], tfidf.fit
    monkeypatch.setattr(session, "TASK_CHARS", 50)
    monkeypatch.setattr(tfidf, "fit", lambda docs, params: seen.append(docs) or real(docs, params))
    classify.fit(data, max_iter=2)
    data = data.where("id < 60")  # the others are left out
    chars = data.agg(F.sum(F.length("text"))).first()[0]
    assert seen[0].rdd.getNumPartitions() == -(-chars // 50) > spark.sparkContext.defaultParallelism
    assert seen[0].count() == data.count()


def test_coefficients_of_many_terms_stay_in_blocks(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(0)
    vectors = [sorted(rng.choice(30, 6, replace=False).tolist()) for _ in range(90)]
    rows = [(float(n % 3), 1.0 + n % 2, v, [0.1 + (n + i) % 5 for i in range(6)]) for n, v in enumerate(vectors)]
    rows.append((0.0, 1.0, [], []))  # a row without terms still counts for the intercepts
    data = spark.createDataFrame(rows, "label double, weight double, indices array<int>, weights array<double>")
    monkeypatch.setattr(regression, "SLICE", 40)
    for collected in (0, 10**6):  # sums added up by slices, and on the driver
        monkeypatch.setattr(regression, "COLLECTED", collected)
        found = regression.fit(data.repartition(3), 3, 0.05, 500, 1e-9)
        dense, share = np.zeros((91, 30)), np.array([r[1] for r in rows]) / sum(r[1] for r in rows)
        for line, (_, _, at, value) in zip(dense, rows):
            line[at] = value
        own = np.zeros((30, 3))
        for r in found.coefficients.collect():
            own[r["index"]] = r["coefficients"]
        raw = dense @ own + np.array(found.intercepts)
        chance = np.exp(raw - raw.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        missed = share[:, None] * (chance - np.eye(3)[[int(r[0]) for r in rows]])
        assert found.steps < 100 and np.abs(dense.T @ missed + 0.05 * own).max() < 1e-8 and np.abs(missed.sum(axis=0)).max() < 1e-8
    keyed = spark.createDataFrame([(n, *r[2:]) for n, r in enumerate(rows)], "id long, indices array<int>, weights array<double>")
    scored = {r["id"]: r for r in found.transform(keyed, "id").collect()}
    assert [scored[n]["prediction"] for n in range(91)] == chance.argmax(axis=1).tolist()
    assert [scored[n]["probability"] for n in range(91)] == pytest.approx(chance.max(axis=1).tolist())


def test_a_large_vocabulary_gives_the_same_model(spark, monkeypatch, tmp_path):
    data = _labelled(spark)
    texts = data.select("id", F.coalesce("text", F.lit("")).alias("text"))
    before = {r["id"]: r for r in classify.predict(texts, classify.fit(data, max_iter=200)).collect()}
    monkeypatch.setattr(tfidf, "SMALL_VOCABULARY", 5)
    model = classify.fit(data, max_iter=200)
    assert isinstance(model.regression, regression.TermRegression) and model.regression.gradient <= regression.TOLERANCE
    model.save(str(tmp_path / "model"))
    for found in (model, classify.IntentModel.load(spark, str(tmp_path / "model"))):
        rows = classify.predict(texts, found).collect()
        assert len(rows) == len(before) == 63
        for r in rows:
            assert r["id"] >= 60 or r["intent"] == before[r["id"]]["intent"]  # texts without terms have no best class
            assert r["confidence"] == pytest.approx(before[r["id"]]["confidence"], abs=5e-3)
    folds = {r["id"]: r for r in classify.cross_validate(data, folds=2).collect()}
    assert sorted(folds) == [*range(60), 101] and all(folds[n]["predicted_intent"] == folds[n]["intent"] for n in range(60))


def test_hybrid_uses_the_rule_first(spark):
    model = classify.fit(_labelled(spark), max_iter=20)
    df = spark.createDataFrame([(1, "refund please"), (2, "song music track"), (3, None)], "id long, text string")
    rows = {r["id"]: r for r in classify.classify(df, model).collect()}
    assert (rows[1]["intent"], rows[1]["confidence"], rows[1]["source"]) == ("BILLING_PAYMENT", 0.99, "rule")
    assert (rows[2]["intent"], rows[2]["source"]) == ("SONG", "ml")
    assert rows[3]["source"] == "ml"


def test_out_of_fold_predictions_cover_every_usable_row_once(spark):
    data = _labelled(spark)
    predicted = classify.cross_validate(data, folds=3, max_iter=30)
    ids = [r["id"] for r in predicted.collect()]
    # Null texts count as empty here; only the class with one example and the null label are left out.
    assert sorted(ids) == [*range(60), 101]
    scores = metrics.overall_scores(metrics.confusion_counts(predicted, "intent", "predicted_intent")).first()
    assert scores["examples"] == 61 and scores["accuracy"] > 0.9


def test_folds_are_stratified(spark):
    data = spark.range(103).select("id", F.when(F.col("id") < 90, "big").otherwise("small").alias("c"))
    rows = metrics.stratified_folds(data, "c", "id", 5).groupBy("c", "fold").count().collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["c"], []).append(r["count"])
    assert sum(sizes["big"]) == 90 and sum(sizes["small"]) == 13
    assert all(len(v) == 5 and max(v) - min(v) <= 1 for v in sizes.values())


def _counts(spark, pairs):
    df = spark.createDataFrame(pairs, "label string, predicted string")
    return metrics.confusion_counts(df, "label", "predicted")


def test_scores_with_unmatched_classes(spark):
    counts = _counts(spark, [("a", "a"), ("a", "c"), ("b", "a"), ("b", "a")])
    rows = {r["class"]: r for r in metrics.class_scores(counts).collect()}
    assert rows["a"]["precision"] == pytest.approx(1 / 3) and rows["a"]["recall"] == 0.5
    assert rows["b"]["f1"] == 0.0 and rows["c"]["support"] == 0
    overall = metrics.overall_scores(counts).first()
    assert overall["accuracy"] == 0.25 and overall["macro_f1"] == pytest.approx(0.4 / 3)
    report = {r["class"]: r for r in metrics.classification_report(counts).collect()}
    assert report["macro avg"]["support"] == 4 and report["accuracy"]["f1"] == 0.25
    assert counts.agg(F.sum("n")).first()[0] == 4


def test_confusion_matrix_fills_zeros(spark):
    matrix = metrics.confusion_matrix(_counts(spark, [("a", "a"), ("a", "b"), ("c", "a")]), ["a", "b", "c"])
    assert [tuple(r) for r in matrix.collect()] == [("a", 1, 1, 0), ("b", 0, 0, 0), ("c", 1, 0, 0)]


def test_kappa(spark):
    same = spark.createDataFrame([(3, 3), (3, 3), (None, 2)], "h int, j int")
    row = metrics.agreement(same, "h", "j").first()
    assert (row["pairs"], row["exact_agreement"], row["cohen_kappa"]) == (2, 1.0, 1.0)
    mixed = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 1)], "h int, j int")
    assert metrics.agreement(mixed, "h", "j").first()["cohen_kappa"] == pytest.approx(0.0)
    apart = spark.createDataFrame([(1, 2), (1, 2)], "h int, j int")
    assert metrics.agreement(apart, "h", "j").first()["cohen_kappa"] == pytest.approx(0.0)


def test_verdict_passes_and_names_reasons(spark):
    good = spark.createDataFrame(
        [(i, "OTHER", "RESOLVED", "NO", None) for i in range(1, 4)],
        "annotation_id int, intent string, resolution_status string, requires_escalation string, annotation_notes string",
    )
    assert labels.label_verdict(good, expected=3).first()["status"] == "PASS"
    bad = good.unionByName(good.where("annotation_id = 1")).withColumn(
        "intent", F.when(F.col("annotation_id") == 2, "NOPE").when(F.col("annotation_id") == 3, None).otherwise(F.col("intent"))
    )
    row = labels.label_verdict(bad, expected=4).first()
    assert row["status"] == "REVIEW REQUIRED"
    assert row["reasons"] == [
        "Missing IDs: 1", "Duplicate IDs: 1", "Missing required labels: 1", "Invalid intent values: 1",
    ]


def test_silhouette_equals_its_definition():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(30, 4))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    own = rng.integers(0, 3, 30)
    own[0] = 9  # a cluster with one member scores 0
    scores = []
    for i in range(30):
        distances = np.linalg.norm(points - points[i], axis=1)
        others = [distances[own == c].mean() for c in set(own) if c != own[i]]
        mates = (own == own[i]) & (np.arange(30) != i)
        if not mates.any():
            scores.append(0.0)
            continue
        a, b = distances[mates].mean(), min(others)
        scores.append((b - a) / max(a, b))
    got = blocks.silhouette_of_block([np.arange(4)] * 30, list(points), own)
    assert got == pytest.approx(np.mean(scores))


def test_discovery_finds_the_topics(spark):
    data = _labelled(spark).where("id < 60")
    model, vectors = tfidf.fit_transform(data.select("id", "text"), tfidf.TfidfParams(max_df=0.9))
    found = clusters.discover(vectors, model.size, (2, 3), restarts=3)
    assert {r["k"] for r in found.scores.collect()} == {2, 3}
    assert all(-1 <= r["silhouette_score"] <= 1 for r in found.scores.collect())
    terms = clusters.cluster_terms(vectors, model, found.assigned, 4)
    assert terms.groupBy("cluster").count().agg(F.max("count")).first()[0] == 4
    picked = clusters.representatives(data.join(found.assigned, "id"), "id", 5)
    assert picked.groupBy("cluster").count().agg(F.max("count")).first()[0] <= 5
