import pytest
from pyspark.sql import functions as F

from caseweave.functions import decisions, lexicon
from caseweave.operators import classify


@pytest.mark.parametrize("text, intent", [
    ("Spotify keeps crashing when I open the app", "APP_TECHNICAL"),
    ("I can't log into my Spotify account", None),
    ("Why is this song unavailable?", "CONTENT_AVAILABILITY"),
    ("I was charged twice for Premium", "BILLING_PAYMENT"),
    ("My playlist disappeared from my library", "PLAYLIST_LIBRARY"),
    ("Spotify should add a feature to show lyrics automatically", "FEATURE_REQUEST"),
    ("Someone hacked my Spotify account", "ACCOUNT_SECURITY"),
    ("My music won't play on my phone", "PLAYBACK"),
    ("hacked and charged twice", "ACCOUNT_SECURITY"),
    ("upgrade to premium", None),
    ("my car's app", "DEVICE_PLATFORM"),
    ("shacked", None),
    ("\u2764\ufe0fhacked again", "ACCOUNT_SECURITY"),
    ("\u26a0\ufe0fbug here", "APP_TECHNICAL"),
    ("refund\ufe0f", "BILLING_PAYMENT"),
    ("refund\u200b", "BILLING_PAYMENT"),
    ("a\u200drefund", "BILLING_PAYMENT"),
    ("refund\u0301", "BILLING_PAYMENT"),
    ("\u00e9refund", None),
    ("refund_", None),
    ("refund\u0663", None),
    (None, None),
])
def test_rules(spark, text, intent):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(decisions.rule_intent(F.col("t"))).first()[0] == intent


def test_patterns_without_a_common_edge(spark):
    rules = (("PLAYBACK", True, ("abc", r"\bxyz\b")), ("OTHER", True, ("b",)))
    df = spark.createDataFrame([("1abc",), ("xyz1",), ("b",)], "t string")
    assert [r[0] for r in df.select(decisions.rule_intent(F.col("t"), rules)).collect()] == ["PLAYBACK", None, "OTHER"]


@pytest.mark.parametrize("intent, confidence, similarity, label, action", [
    ("ACCOUNT_SECURITY", 0.8, 0.8, None, "ESCALATE"),
    ("BILLING_PAYMENT", 0.8, 0.8, None, "ESCALATE"),
    ("APP_TECHNICAL", 0.8, 0.4, None, "ANSWER"),
    ("APP_TECHNICAL", 0.8, 0.25, None, "CLARIFY"),
    ("APP_TECHNICAL", 0.1, 0.1, None, "CLARIFY"),
    ("APP_TECHNICAL", 0.8, 0.1, None, "ESCALATE"),
    ("APP_TECHNICAL", 0.12, 0.1, None, "ESCALATE"),
    ("APP_TECHNICAL", 0.8, 0.35, "YES", "ESCALATE"),
    ("APP_TECHNICAL", 0.8, 0.35, "NO", "ANSWER"),
])
def test_escalation_gate(spark, intent, confidence, similarity, label, action):
    df = spark.createDataFrame([(intent, confidence, similarity, label)], "i string, c double, s double, l string")
    gate = decisions.escalation_gate(F.col("i"), F.col("c"), F.col("s"), F.col("l"))
    assert df.select(gate.alias("g")).first()["g"]["action"] == action


@pytest.mark.parametrize("intent, similarity, compat, combined, action, reason", [
    ("ACCOUNT_SECURITY", 0.9, 0.9, 0.9, "ESCALATE", lexicon.REASON_SECURITY),
    ("BILLING_PAYMENT", 0.0, 0.0, 0.0, "ESCALATE", lexicon.REASON_BILLING),
    ("OTHER", None, None, None, "CLARIFY", lexicon.REASON_NO_CASE),
    ("OTHER", 0.1999, 1.0, 0.4, "CLARIFY", lexicon.REASON_NO_CASE),
    ("OTHER", 0.20, 0.0, 0.2999, "CLARIFY", lexicon.REASON_MODERATE),
    ("OTHER", 0.20, 0.0, 0.30, "ANSWER", lexicon.REASON_RELEVANT),
    ("OTHER", 0.3499, 0.0999, 0.30, "ANSWER", lexicon.REASON_RELEVANT),
    ("OTHER", 0.35, 0.0999, 0.9, "CLARIFY", lexicon.REASON_INCOMPATIBLE),
    ("OTHER", 0.35, 0.10, 0.2875, "CLARIFY", lexicon.REASON_MODERATE),
    ("OTHER", 0.9, 0.10, 0.7, "ANSWER", lexicon.REASON_RELEVANT),
])
def test_route(spark, intent, similarity, compat, combined, action, reason):
    df = spark.createDataFrame([(intent, similarity, compat, combined)], "i string, s double, c double, m double")
    got = df.select(decisions.route(F.col("i"), F.col("s"), F.col("c"), F.col("m")).alias("d")).first()["d"]
    assert (got["action"], got["reason"]) == (action, reason)


@pytest.mark.parametrize("similarity, support, response, grounded", [
    (None, None, lexicon.REPLY_NO_CASES, False),
    (0.1999, "hello", lexicon.REPLY_WEAK, False),
    (0.20, "hello", lexicon.REPLY_MODERATE, True),
    (0.20, "@12 https://x", lexicon.REPLY_NO_TEXT, False),
    (0.35, "@12 hello", "hello", True),
    (0.35, None, lexicon.REPLY_NO_TEXT, False),
])
def test_grounded_reply(spark, similarity, support, response, grounded):
    df = spark.createDataFrame([(similarity, support)], "s double, t string")
    got = df.select(decisions.grounded_reply(F.col("s"), F.col("t")).alias("r")).first()["r"]
    assert (got["response"], got["grounded"], got["needs_escalation"]) == (response, grounded, not grounded)


def test_action_reply(spark):
    df = spark.createDataFrame([("ANSWER",), ("CLARIFY",), ("ESCALATE",)], "a string")
    reply = decisions.action_reply(F.col("a"), F.lit(0.5), F.lit("use the app"))
    got = [tuple(r["r"]) for r in df.select(reply.alias("r")).collect()]
    assert got == [
        ("use the app", True, False), (lexicon.REPLY_CLARIFY, False, False), (lexicon.REPLY_ESCALATE, False, True),
    ]


def test_keyword_compatibility(spark):
    df = spark.createDataFrame([("My APP crashes, an error",), (None,)], "t string")

    def score(intent):
        return [r[0] for r in df.select(decisions.keyword_compatibility(F.col("t"), intent)).collect()]

    assert score("APP_TECHNICAL") == [3 / 8, 0.0]
    assert score("OTHER") == [0.0, 0.0]
    assert score("NO_SUCH_INTENT") == [0.0, 0.0]


def test_classify_without_a_model(spark):
    df = spark.createDataFrame([(1, "refund please"), (2, "hello")], "id long, text string")
    got = {r["id"]: (r["intent"], r["confidence"], r["source"]) for r in classify.classify(df).collect()}
    assert got == {1: ("BILLING_PAYMENT", 0.99, "rule"), 2: ("OTHER", 0.0, "default")}


def test_patterns_are_tried_only_at_their_first_letters():
    assert decisions.any_pattern([r"\bque\b", r"\btion(s)?\b"]).startswith("(?=[qt])")
    for patterns in ([r"\bab|cd\b"], [r"\bx?y\b"], [r"\b(a|b)c\b"]):  # these may begin otherwise
        assert not decisions.any_pattern(patterns).startswith("(?=")
