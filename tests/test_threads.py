from pyspark.sql import functions as F

from caseweave import schema
from caseweave.operators import audit, threads
from caseweave.sources.tables import coerce_messages


def _messages(spark, rows):
    """rows: (id, author, inbound, text, children, parent)"""
    full = [(i, a, b, "Tue Nov 28 07:06:03 +0000 2017", t, c, p) for i, a, b, t, c, p in rows]
    return spark.createDataFrame(full, schema.MESSAGE)


def _thread(spark):
    return _messages(spark, [
        (1, "u1", True, "one", "2,3", None),
        (2, "b", False, "two", None, 1),
        (3, "u1", True, "three", "4", 1),
        (4, "b", False, "four", None, 3),
        (5, "b", False, "self", "5", 5),
        (6, "b", False, "six", "7", 7),
        (7, "u2", True, "seven", "6", 6),
        (8, "b", False, "orphan", None, 99),
    ])


def _chains(spark, messages, ids, **options):
    leaves = spark.createDataFrame([("b", i) for i in ids], "brand string, support_tweet_id long")
    rows = threads.reply_chains(messages, leaves, **options).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r["support_tweet_id"], r["position"])):
        found.setdefault(r["support_tweet_id"], []).append(r["tweet_id"])
        assert r["num_messages"] == sum(x["support_tweet_id"] == r["support_tweet_id"] for x in rows)
    return found


def test_chains_with_branch_self_loop_cycle_and_orphan(spark):
    assert _chains(spark, _thread(spark), [2, 4, 5, 6, 8, 1234]) == {
        2: [1, 2], 4: [1, 3, 4], 5: [5], 6: [7, 6], 8: [8],
    }


def test_chain_bound(spark):
    assert _chains(spark, _thread(spark), [4], max_hops=1) == {4: [3, 4]}


def test_long_chain_needs_few_rounds(spark):
    n = 700
    messages = _messages(spark, [(i, "b", i % 2 == 0, f"t{i}", str(i + 1), i - 1 if i else None) for i in range(n)])
    assert _chains(spark, messages, [n - 1]) == {n - 1: list(range(n))}


def test_duplicate_ids_do_not_multiply_turns(spark):
    messages = _thread(spark).unionByName(_thread(spark).where("tweet_id = 1"))
    assert _chains(spark, messages, [4]) == {4: [1, 3, 4]}


def test_ancestor_ids_include_missing_parents(spark):
    ids = threads.ancestor_ids(_thread(spark), spark.createDataFrame([(4,), (8,)], "tweet_id long"))
    assert {r[0] for r in ids.collect()} == {4, 3, 1, 8, 99}


def test_float_ids_match_their_parents(spark):
    raw = spark.createDataFrame(
        [("1", "u", "True", None, "a", "2", None), ("2", "b", "False", None, "c", None, "1.0"),
         ("3", "b", "False", None, "d", None, "99.0"), ("4", "b", "0", None, "e", None, "x")],
        schema.RAW_MESSAGE,
    )
    messages = coerce_messages(raw)
    assert [r[0] for r in messages.orderBy("tweet_id").select("in_response_to_tweet_id").collect()] == [None, 1, 99, None]
    assert audit.missing_parents(messages).first()[0] == 1


def test_neighbours(spark):
    targets = spark.createDataFrame([(3,)], "tweet_id long")
    assert {r["tweet_id"] for r in threads.neighbours(_thread(spark), targets).collect()} == {1, 3, 4}


def test_brand_slice(spark):
    messages = _messages(spark, [
        (1, "u", True, "open", "2", None), (2, "b", False, "reply", "3", 1), (3, "u", True, "thanks", None, 2),
        (4, "u", True, "other", None, 1), (5, None, True, "ghost", None, 2), (6, "c", False, "x", None, 2),
    ])
    assert {r["tweet_id"] for r in threads.brand_slice(messages, "b").collect()} == {2, 3, 5}
    assert {r["tweet_id"] for r in threads.brand_slice(messages, "b", True).collect()} == {1, 2, 3, 5}


def _contexts(spark, messages, ids, **options):
    clean = messages.withColumn("clean_text", F.col("text"))
    targets = spark.createDataFrame([(i,) for i in ids], "tweet_id long")
    return {r[0]: r[1] for r in threads.context_windows(clean, targets, **options).collect()}


def test_context_goes_back_then_forward(spark):
    got = _contexts(spark, _thread(spark), [1, 3, 4, 8, 77])
    # The first listed child of 1 is 2, which has no child.
    assert got[1] == "CUSTOMER: one\nSUPPORT: two"
    assert got[3] == "CUSTOMER: one\nCUSTOMER: three\nSUPPORT: four"
    assert got[4] == "CUSTOMER: one\nCUSTOMER: three\nSUPPORT: four"
    assert got[8] == "SUPPORT: orphan"
    assert got[77] == ""


def test_context_is_cycle_safe_and_bounded(spark):
    got = _contexts(spark, _thread(spark), [5, 6])
    assert got == {5: "SUPPORT: self", 6: "CUSTOMER: seven\nSUPPORT: six"}
    n = 30
    chain = _messages(spark, [(i, "b", i % 2 == 0, f"t{i}", str(i + 1), i - 1 if i else None) for i in range(n)])
    got = _contexts(spark, chain, [0, 4, 20])
    assert [line.split()[-1] for line in got[0].split("\n")] == [f"t{i}" for i in range(10)]
    assert [line.split()[-1] for line in got[4].split("\n")] == [f"t{i}" for i in range(10)]
    assert [line.split()[-1] for line in got[20].split("\n")] == [f"t{i}" for i in range(11, 21)]


def test_nesting_round_trip(spark):
    leaves = spark.createDataFrame([("b", 4), ("b", 2)], "brand string, support_tweet_id long")
    turns = threads.reply_chains(_thread(spark), leaves)
    nested = threads.nest_threads(turns)
    assert [f.name for f in nested.schema] == [f.name for f in schema.THREAD]
    back = threads.unnest_threads(nested)
    assert back.select(*turns.columns).exceptAll(turns).isEmpty() and back.count() == turns.count()
    said = nested.where("support_tweet_id = 4").select(threads.speech_of(F.col("conversation"), "customer")).first()[0]
    assert said == "one three"


def test_thread_summary(spark):
    leaves = spark.createDataFrame([("b", 4), ("b", 2), ("c", 8)], "brand string, support_tweet_id long")
    rows = {r["brand"]: tuple(r)[1:] for r in threads.thread_summary(threads.reply_chains(_thread(spark), leaves)).collect()}
    assert rows == {"b": (2, 2.5, 2.5, 3), "c": (1, 1.0, 1.0, 1)}


def test_reply_statistics_counts_replies_and_answered_customers(spark):
    messages = _messages(spark, [
        (1, "u", True, "q", None, None), (2, "b", False, "a", None, 1), (3, "b", False, "a again", None, 1),
        (4, "b", False, "alone", None, None), (5, "b", False, "to support", None, 2), (6, "x", None, "unknown", None, 1),
    ])
    assert [tuple(r) for r in audit.reply_statistics(messages).collect()] == [("b", 4, 1, 2)]
