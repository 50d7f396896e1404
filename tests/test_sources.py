import json

import pytest
from pyspark.sql import functions as F

from caseweave import schema
from caseweave.operators import threads, tfidf
from caseweave.sources import sinks, tables

HEADER = "tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n"


def test_messages_from_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        HEADER
        + '1,u1,True,Tue Nov 28 07:06:03 +0000 2017,"line one\nline ""two"", three","2,3",\n'
        + "2,b,False,,plain,,1.0\n",
        encoding="utf-8",
    )
    rows = tables.read_messages(spark, str(path)).orderBy("tweet_id").collect()
    assert rows[0]["text"] == 'line one\nline "two", three' and rows[0]["response_tweet_id"] == "2,3"
    assert rows[0]["inbound"] is True and rows[0]["in_response_to_tweet_id"] is None
    assert rows[1]["inbound"] is False and rows[1]["in_response_to_tweet_id"] == 1
    whole = tables.read_table(spark, str(path), schema.RAW_MESSAGE)
    assert whole.count() == 2


TURNS = [{"tweet_id": 1, "speaker": "customer", "author_id": "u", "created_at": None, "text": "hi \"x\"", "parent_id": None}]


def _jsonl(tmp_path, extra=()):
    lines = [
        json.dumps({"brand": "B", "support_tweet_id": 5, "num_messages": 1, "conversation": TURNS}),
        "",
        json.dumps({"brand": "B", "support_tweet_id": "6", "num_messages": 1, "conversation": json.dumps(TURNS)}),
        json.dumps({"support_tweet_id": 7, "conversation": 42}),
        json.dumps({"brand": None, "support_tweet_id": 8, "num_messages": 0, "conversation": "not json"}),
        *extra,
    ]
    path = tmp_path / "threads.jsonl"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_threads_from_both_spellings(spark, tmp_path):
    read = tables.read_threads(spark, _jsonl(tmp_path, ["{broken", "[]"]))
    rows = {r["support_tweet_id"]: r for r in read.collect() if r["support_tweet_id"] is not None}
    assert rows[5]["conversation"] == rows[6]["conversation"]
    assert rows[5]["conversation"][0]["text"] == 'hi "x"'
    assert rows[7]["conversation"] == [] and rows[8]["conversation"] == []
    assert len(rows) == 4


def test_strict_reader_fails(spark, tmp_path):
    good = tables.read_threads(spark, _jsonl(tmp_path), strict=True)
    assert good.count() == 4
    with pytest.raises(Exception):
        tables.read_threads(spark, _jsonl(tmp_path, ["{broken"]), strict=True).collect()


def test_thread_sink_round_trip(spark, tmp_path):
    nested = tables.read_threads(spark, _jsonl(tmp_path)).where("support_tweet_id < 7")
    sinks.write_threads(nested, str(tmp_path / "out"))
    again = tables.read_threads(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, nested.collect()))
    assert threads.unnest_threads(again).count() == 2


def test_csv_sink_appends(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, 'a "quoted", text\nmore', [1, 2])], "id int, t string, ids array<bigint>")
    sinks.write_csv(df, path)
    sinks.write_csv(df.withColumn("id", F.lit(2)), path, append=True)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).orderBy("id")
    assert [tuple(r) for r in back.collect()] == [
        ("1", 'a "quoted", text\nmore', "1|2"), ("2", 'a "quoted", text\nmore', "1|2"),
    ]


def test_transcript(spark, tmp_path):
    nested = tables.read_threads(spark, _jsonl(tmp_path)).where("support_tweet_id = 5")
    text = sinks.transcript(nested).first()[0]
    assert "BRAND: B\nSUPPORT TWEET: 5\nMESSAGES: 1\n" in text
    assert '[customer] hi "x"\n    tweet_id: 1\n' in text
    sinks.write_transcripts(nested, str(tmp_path / "transcripts"))
    assert spark.read.text(str(tmp_path / "transcripts")).count() > 5


def test_quality_report(spark, tmp_path):
    metrics = spark.createDataFrame([(name, 12345) for name, _ in sinks.REPORT_LINES], "metric string, value long")
    text = sinks.quality_report(metrics).first()[0]
    assert "Raw rows:\n12,345\n\nClean rows:\n12,345" in text
    sinks.write_report(metrics, str(tmp_path / "report"))


def test_vocabulary_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words here again") for i in range(4)], "id long, text string")
    model = tfidf.fit(docs, tfidf.TfidfParams(max_df=1.0, stop_words=("here",)))
    model.save(str(tmp_path / "m"))
    again = tfidf.TfidfModel.load(spark, str(tmp_path / "m"))
    assert (again.params, again.documents, again.size) == (model.params, model.documents, model.size)
    assert tfidf.transform(docs, again).orderBy("id").collect() == tfidf.transform(docs, model).orderBy("id").collect()
