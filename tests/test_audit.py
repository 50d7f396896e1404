from pyspark.sql import functions as F

from caseweave import schema
from caseweave.operators import audit, relational, sampling
from caseweave.plans import preparation


def _raw(spark):
    return spark.createDataFrame([
        (1, "u", True, "Tue Nov 28 07:06:03 +0000 2017", "hi", "2", None),
        (1, "u", True, "Tue Nov 28 07:06:02 +0000 2017", "hi", None, None),
        (2, "b", False, "junk", None, None, 1),
        (3, "b", None, None, "  ", None, 77),
        (None, None, False, None, "x", None, 77),
    ], schema.MESSAGE)


def _metrics(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def test_totals_leave_null_ids_and_unknown_directions_out(spark):
    assert _metrics(audit.message_totals(_raw(spark))) == {
        "total_rows": 5, "inbound_customer_tweets": 2, "outbound_support_tweets": 2, "unique_tweet_ids": 3,
        "duplicate_tweet_ids": 1,
    }


def test_quality_metrics(spark):
    assert _metrics(audit.quality_metrics(_raw(spark))) == {
        "raw_rows": 5, "clean_rows": 4, "duplicate_tweet_id_rows": 2, "duplicate_text_rows": 2, "empty_text_rows": 2,
        "invalid_created_at_rows": 3, "customer_inbound_rows": 2, "support_outbound_rows": 3,
        "missing_parent_references": 2,
    }


def test_metrics_of_an_empty_table(spark):
    empty = _raw(spark).limit(0)
    assert set(_metrics(audit.quality_metrics(empty)).values()) == {0}
    assert {r["missing_percentage"] for r in audit.missing_values(empty).collect()} == {0.0}


def test_missing_values(spark):
    rows = {r["column"]: (r["missing_values"], r["missing_percentage"]) for r in audit.missing_values(_raw(spark)).collect()}
    assert rows["text"] == (1, 20.0) and rows["tweet_id"] == (1, 20.0)


def test_cleaning_keeps_the_earliest_copy(spark):
    clean, _ = preparation.clean_messages(_raw(spark))
    rows = {r["tweet_id"]: r for r in clean.collect()}
    assert len(rows) == 4
    assert rows[1]["created_at"] == "Tue Nov 28 07:06:02 +0000 2017"
    assert rows[2]["raw_text"] == "" and rows[2]["clean_text"] == ""


def test_author_statistics_drop_null_authors(spark):
    rows = {r["author_id"]: tuple(r)[1:] for r in audit.author_statistics(_raw(spark)).collect()}
    assert rows == {"u": (2, 2, 0, 1, 0.5), "b": (2, 0, 1, 0, 0.0)}


def test_reply_quality_weighs_copies(spark):
    df = spark.createDataFrame([("b", "dm us"), ("b", "dm us"), ("b", "sorry, fixed it now"), ("b", None)], "author_id string, text string")
    row = audit.reply_quality(df).first()
    assert row["support_tweets"] == 4 and row["unique_support_responses"] == 3
    assert row["average_response_words"] == 2.0
    assert (row["dm_request_rate"], row["apology_rate"], row["resolution_signal_rate"]) == (0.5, 0.25, 0.25)


def test_samples_are_repeatable_and_capped(spark):
    df = spark.range(100).withColumn("g", (F.col("id") % 3).cast("string"))
    first = [r["id"] for r in sampling.sample_rows(df, "id", 10).collect()]
    assert first == [r["id"] for r in sampling.sample_rows(df.repartition(7), "id", 10).collect()]
    sizes = {r["g"]: r["count"] for r in sampling.sample_per_group(df, ["g"], "id", 33).groupBy("g").count().collect()}
    assert sizes == {"0": 33, "1": 33, "2": 33}
    assert sampling.sample_per_group(df, ["g"], "id", 500).count() == 100


def test_dense_row_ids_follow_the_order(spark):
    df = spark.range(1000).select((F.lit(5000) - F.col("id")).alias("k"))
    numbered = relational.dense_row_id(df, ["k"], "n", 7).orderBy("k").collect()
    assert [r["n"] for r in numbered] == list(range(1, 1001))


def test_dense_row_ids_shuffle_the_rows_once(spark):
    df = spark.createDataFrame([(k, v) for k in (None, 3, 1, 2) for v in ("b", None, "a")], "k int, v string")
    numbered = relational.dense_row_id(df, ["k", "v"], "n", 3)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan  # a window over all rows would shuffle them again
    wanted = [(i + 1, k, v) for i, (k, v) in enumerate((k, v) for k in (None, 1, 2, 3) for v in (None, "a", "b"))]
    assert sorted(tuple(r) for r in numbered.collect()) == wanted


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert relational.project(df, ["c", "zz", "a"]).columns == ["c", "a"]
    assert relational.place_after(df, "c", "a").columns == ["a", "c", "b"]
    assert relational.add_constants(df, {"note": ""}).first()["note"] == ""


def test_requests(spark):
    df = spark.createDataFrame([("hi",), ("",), (None,)], "message string")
    accepted, rejected = relational.validate_requests(df, 3)
    assert accepted.count() == 1 and rejected.count() == 2
    for bad in (0, 11):
        try:
            relational.validate_requests(df, bad)
        except ValueError:
            continue
        raise AssertionError("top_k outside 1..10 must raise")


def test_empty_guard_and_classes(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "label string")
    kept, rare = relational.frequent_classes(df, "label")
    assert kept.count() == 2 and [r["label"] for r in rare.collect()] == ["b"]
    assert relational.majority_value(df, "label").first()["label"] == "a"
    try:
        relational.require_rows(df.limit(0), "cases")
    except RuntimeError as problem:
        assert "cases" in str(problem)
    else:
        raise AssertionError("an empty table must raise")


def test_disjoint_split(spark):
    rows = [(i, f"u{i}", True, None, f"text {i}", None, None) for i in range(60)]
    clean = preparation.with_clean_text(spark.createDataFrame(rows, schema.MESSAGE), False)
    first, golden = preparation.disjoint_split(clean, 20, 10)
    assert first.count() == 20 and golden.count() == 10
    assert first.join(golden, "tweet_id").isEmpty()
