from pyspark.sql import functions as F

from caseweave.operators import tfidf
from caseweave.plans.triage import triage
from caseweave.streaming import jobs


def _cases(spark):
    return spark.createDataFrame(
        [(1, "app crash error", "reinstall"), (2, "app crash bug", "restart"), (3, "lost playlist", "restore")],
        "support_tweet_id long, customer_text string, support_text string",
    )


def test_stream_triage_equals_batch(spark, tmp_path):
    cases = _cases(spark)
    model = tfidf.fit(tfidf.document_text(cases, "support_tweet_id", "customer_text"), tfidf.TfidfParams(max_df=1.0))
    source = str(tmp_path / "in")
    first = spark.createDataFrame([(1, "app crash"), (2, "hacked")], "query_id long, query string")
    second = spark.createDataFrame([(3, "lost playlist"), (4, "zzz")], "query_id long, query string")
    target, log = str(tmp_path / "out"), str(tmp_path / "log")
    for part in (first, second):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema("query_id long, query string").parquet(source)
        jobs.start_triage(stream, lambda b: triage(b, cases, model, top_k=2), target, log, True).awaitTermination()
    got = spark.read.parquet(target)
    assert got.select("batch").distinct().count() == 2
    batch = triage(first.union(second), cases, model, top_k=2)
    columns = [c for c in batch.columns if c != "retrieved_cases"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))


def test_stream_audit_counts_every_event_once_in_any_order(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    parts = [
        [(1, "2024-01-10", 7, "error", 1.0), (2, "2024-01-10", 7, "view", 2.0), (3, "2024-01-10", 8, "view", 4.0)],
        [(2, "2024-01-10", 7, "view", 2.0), (4, "2024-01-10", 7, "view", 8.0), (5, "2024-01-10", None, "view", 1.0)],
        [(6, "2024-01-02", 7, "view", 16.0), (7, "2023-01-02", 9, "error", 1.0), (1, "2024-01-10", 7, "error", 1.0),
         (None, "2024-01-02", 9, "view", 1.0), (None, "2024-01-02", 9, "view", 1.0), (7, "2023-01-02", 9, "error", 1.0)],
    ]
    for event_id, expected in (
        ("event_id", {7: (4, 1, 27.0), 8: (1, 0, 4.0), 9: (3, 1, 3.0)}), (None, {7: (6, 2, 30.0), 8: (1, 0, 4.0), 9: (4, 2, 4.0)}),
    ):
        own = f"{event_id}"
        for rows in parts:
            df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
            df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(source + own)
            stream = spark.readStream.schema(schema).parquet(source + own)
            jobs.start_audit(stream, target + own, log + own, event_id=event_id, available_now=True).awaitTermination()
        current = jobs.author_activity(spark, target + own)
        rows = {r["user_id"]: (r["events"], r["errors"], r["total_value"]) for r in current.collect()}
        assert rows == expected
