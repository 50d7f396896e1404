import pytest
from pyspark.sql import functions as F

from caseweave.functions import judging, lexicon
from caseweave.plans import evaluation


def _retrieved(spark, by_id=True):
    rows = [(1, "q1", 2, "c b", "s b", 0.5, 0.125, 0.40625), (1, "q1", 1, "c a", None, 0.9, 0.25, 0.7375)]
    df = spark.createDataFrame(
        rows, "query_id long, query string, rank int, historical_customer string, historical_support string, "
        "similarity double, intent_compatibility double, combined_score double",
    )
    return df if by_id else df.drop("query_id")


def _agent(spark):
    return spark.createDataFrame(
        [(1, "q1", "r1"), (2, "q2", "r2")], "example_id long, query string, response string"
    )


def test_evidence_joins_by_id_or_text(spark):
    for by_id in (True, False):
        joined = evaluation.attach_evidence(_agent(spark), _retrieved(spark, by_id))
        rows = {r["example_id"]: r for r in joined.collect()}
        assert [c["customer_case"] for c in rows[1]["cases"]] == ["c a", "c b"] and rows[2]["cases"] is None
        assert tuple(evaluation.matched_rows(joined).first()) == (1, 2)


def test_missing_columns_raise(spark):
    try:
        evaluation.attach_evidence(_agent(spark), _retrieved(spark).drop("rank"))
    except ValueError as problem:
        assert "rank" in str(problem)
    else:
        raise AssertionError("a missing column must raise")


def test_prompt_holds_message_reply_and_evidence(spark):
    rows = {r["example_id"]: r["prompt"] for r in evaluation.judge_prompts(_agent(spark), _retrieved(spark), "Be fair.").collect()}
    assert "\n--- Historical Case 1 ---\n\nHistorical Customer:\nc a\n" in rows[1]
    # A tie at the third decimal goes to the even digit.
    assert "Intent compatibility:\n0.125\n" in rows[1] and "score:\n0.738\n" in rows[1] and "score:\n0.406\n" in rows[1]
    assert lexicon.NO_EVIDENCE in rows[2] and "CUSTOMER MESSAGE:\nq2" in rows[2] and "\n\nBe fair.\n\n" in rows[2]


def _parse(spark, *raw):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string")
    return judging.parse_judgments(df, "raw").orderBy("i").collect()


def test_judgments(spark):
    fenced, prose, control, none, missing, broken, null = _parse(
        spark, '```JSON\n{"overall": 4, "reason": "ok"}\n```', 'Sure: {"overall": 2,\n "tone": 3} bye',
        '{"overall": 1, "reason": "a\tb"}', "no object", "{}", '{"overall": }', None,
    )
    assert (fenced["overall"], fenced["reason"], fenced["error"]) == (4, "ok", None)
    assert (prose["overall"], prose["tone"], prose["reason"]) == (2, 3, "")
    assert control["reason"] == "a b"
    assert none["overall"] is None and none["reason"] == "Judge error: No JSON object found: no object"
    assert missing["overall"] is None and missing["error"] is None
    assert broken["overall"] is None and broken["error"] is not None
    assert null["error"] == "No reply"


def test_a_failing_scorer_keeps_the_other_rows(spark):
    def scorer(prompt):
        if "q2" in prompt:
            raise RuntimeError("offline")
        return '{"groundedness": 5, "overall": 3, "reason": "fine"}'

    judged = evaluation.judge(_agent(spark), _retrieved(spark), scorer, "Be fair.")
    rows = {r["example_id"]: r for r in judged.collect()}
    assert (rows[1]["overall"], rows[1]["reason"]) == (3, "fine")
    assert (rows[2]["overall"], rows[2]["reason"]) == (None, "Judge error: offline")
    summary = evaluation.judge_summary(judged).first()
    assert (summary["judgments"], summary["valid_judgments"], summary["mean_overall"]) == (2, 1, 3.0)


def test_annotation_table(spark):
    records = _retrieved(spark).withColumn("gold_intent", F.lit("OTHER"))
    rows = evaluation.relevance_annotation(records).orderBy("judgment_id").collect()
    assert [(r["judgment_id"], r["rank"], r["relevance"]) for r in rows] == [(1, 1, ""), (2, 2, "")]
    summary = evaluation.annotation_summary(evaluation.relevance_annotation(records)).first()
    assert tuple(summary) == (1, 2, 2, 2)


def test_golden_rows_without_label_are_dropped(spark):
    golden = spark.createDataFrame(
        [(1, "t", "OTHER", "YES"), (2, None, "OTHER", "NO"), (3, "t", None, "NO")],
        "annotation_id int, clean_text string, intent string, requires_escalation string",
    )
    rows = evaluation.golden_queries(golden).collect()
    assert [(r["query_id"], r["gold_escalation"], r["gold_resolution"]) for r in rows] == [(1, "YES", "")]


@pytest.mark.parametrize("plan", [evaluation.evaluate_agent, evaluation.evaluate_retrieval])
def test_nothing_to_evaluate_raises(spark, plan):
    golden = spark.createDataFrame([(1, "no sound", "playback")], "annotation_id long, clean_text string, intent string")
    cases = spark.createDataFrame(
        [(1, "no sound", "restart")], "case_id long, customer_case string, support_response string"
    )
    with pytest.raises(RuntimeError, match="No evaluation rows remain"):
        plan(golden.where("intent = 'other'"), cases, None)
    with pytest.raises(RuntimeError, match="No historical cases remain"):
        plan(golden, cases.where("case_id > 1"), None)
