import datetime

from pyspark.sql import functions as F

from caseweave import schema
from caseweave.functions import text as tx


def _apply(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_text_masks_decodes_and_squeezes(spark):
    values = [None, "", "  ", "a &amp; b https://x.y/z @me", "été  déjà", "a@b.c www.x.y!", "&lt;p&gt; &eacute;&#33;"]
    assert _apply(spark, values, tx.clean_text) == [
        "", "", "", "a & b <URL> <USER>", "été déjà", "a <USER> .c <URL>", "<p> é!",
    ]


def test_basic_entities_decode_once_without_python(spark):
    values = ["&amp;lt; &quot;x&quot; &#39;", "plain"]
    assert _apply(spark, values, lambda c: tx.unescape_html(c, full=False)) == ["&lt; \"x\" '", "plain"]
    assert _apply(spark, values, tx.unescape_html) == ["&lt; \"x\" '", "plain"]


def test_normalize_and_reply_cleaning(spark):
    assert _apply(spark, [None, " A\n\tB  c "], tx.normalize) == ["", "a b c"]
    assert _apply(spark, [None, "", "@123 hi  https://t.co/x there @you", " @77 "], tx.clean_reply) == [
        "", "", "hi there @you", "",
    ]


def test_blank_and_word_count(spark):
    assert _apply(spark, [None, "", " \n ", "x"], tx.is_blank) == [True, True, True, False]
    assert _apply(spark, [None, "", "  ", "a  b\nc", "é x"], tx.word_count) == [0, 0, 0, 3, 2]


def test_signals_match_substrings(spark):
    assert _apply(spark, ["Admin", "Direct Message", "x", None], tx.asks_for_dm) == [True, True, False, False]
    assert _apply(spark, ["So SORRY", "apologies", "x"], tx.apologises) == [True, True, False]
    assert _apply(spark, ["we Fixed it", "nothing"], tx.signals_resolution) == [True, False]


def test_words_are_unicode_and_at_least_two_long(spark):
    assert _apply(spark, ["Été à la_mer x 42!", None], tx.words) == [["été", "la_mer", "42"], []]


def test_created_at(spark):
    parsed = _apply(spark, ["Tue Nov 28 07:06:03 +0000 2017", "junk", None], tx.parse_created_at)
    assert parsed == [datetime.datetime(2017, 11, 28, 7, 6, 3), None, None]


def test_ids_and_flags(spark):
    assert _apply(spark, ["1.0", "99", " 7 ", "x", "9007199254740993.0", "1.5", None], schema.to_long_id) == [
        1, 99, 7, None, 9007199254740993, None, None,
    ]
    assert _apply(spark, ["true", "True", "1", "0", None], schema.to_flag) == [True, True, True, False, None]
    assert _apply(spark, ["TRUE", None], lambda c: schema.to_flag(c, null_as_false=True)) == [True, False]


def test_split_ids(spark):
    assert _apply(spark, ["2, 3,,x", "", None], tx.split_ids) == [[2, 3], [], []]


def test_required_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "query int")
    try:
        schema.require_columns(df, schema.AGENT_EVALUATION_COLUMNS, "agent evaluation")
    except ValueError as problem:
        assert "example_id" in str(problem) and "response" in str(problem)
    else:
        raise AssertionError("a missing column must raise")


def test_percent_ties_go_to_the_even_digit(spark):
    df = spark.createDataFrame([(0.00125,), (0.5,)], "r double")
    assert [r[0] for r in df.select(tx.as_percent(F.col("r"))).collect()] == ["0.12%", "50.00%"]
