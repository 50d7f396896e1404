"""Registered queries of sources, sinks and the request path: tables are written, read back and compared with the originals."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave.operators import audit, threads, tfidf
from caseweave.operators.relational import of_brand, require_rows
from caseweave.plans import triage as triage_plan
from caseweave.session import cut_lineage, scratch_path
from caseweave.sources import sinks, tables
from caseweave.sources.supplied import messages, support_threads, table
from catalog import dialect as sql, retrieval
from catalog.tables import KEYWORDS, RULES

QUERIES, SQL = {}, {}


def register(name, twin=None):
    def add(query):
        QUERIES[name] = query
        if twin:
            SQL[name] = twin
        return query

    return add


_MESSAGE_COLUMNS = "tweet_id, author_id, inbound, created_at, text, response_tweet_id, in_response_to_tweet_id"


@register("s1_csv_messages", f"WITH {sql.MESSAGES} SELECT {_MESSAGE_COLUMNS} FROM messages")
def _(spark, folder):
    """The raw export: ids as floating text, flags in two spellings, line breaks and quotes inside texts."""
    path = scratch_path(spark, "messages-csv")
    raw = messages(spark, folder, children=True)
    sinks.write_csv(raw.select(
        F.concat(F.col("tweet_id").cast("string"), F.lit(".0")).alias("tweet_id"), "author_id",
        F.when(F.col("tweet_id") % 2 == 0, F.initcap(F.col("inbound").cast("string")))
        .otherwise(F.col("inbound").cast("int").cast("string")).alias("inbound"),
        "created_at", "text", "response_tweet_id",
        F.concat(F.col("in_response_to_tweet_id").cast("string"), F.lit(".0")).alias("in_response_to_tweet_id"),
    ), path)
    return tables.read_messages(spark, path).select(*_MESSAGE_COLUMNS.split(", "))


@register("s2_read_table", "SELECT * FROM labels")
def _(spark, folder):
    path = scratch_path(spark, "labels-csv")
    labels = table(spark, folder, "labels")
    sinks.write_csv(labels, path)
    return tables.read_table(spark, path, labels.schema)


@register("s6_csv_append", """SELECT doc_id, source, n_chars FROM documents""")
def _(spark, folder):
    """Three increments appended to one folder of CSV files."""
    path = scratch_path(spark, "appended-csv")
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    for part in range(3):
        sinks.write_csv(docs.where(F.pmod("doc_id", F.lit(3)) == part), path, append=True)
    return tables.read_table(spark, path, docs.schema)


def _nested(spark, folder):
    turns = support_threads(spark, folder).select(
        "brand", "support_tweet_id", "num_messages", "position", "tweet_id", "speaker",
        F.lit(None).cast("string").alias("author_id"), F.lit(None).cast("string").alias("created_at"), "text",
        F.lit(None).cast("bigint").alias("parent_id"),
    )
    return threads.nest_threads(turns)


@register("s3_jsonl_threads", f"""WITH {sql.THREAD_TURNS}
SELECT brand, support_tweet_id, num_messages, position, tweet_id, speaker, text FROM thread_turns""")
def _(spark, folder):
    """Threads as JSON lines, half of them with the conversation inside a string, between bad and blank lines."""
    path = scratch_path(spark, "threads-jsonl")
    nested = _nested(spark, folder)
    even = F.col("support_tweet_id") % 2 == 0
    sinks.write_threads(nested.where(even), path)
    as_text = nested.where(~even).withColumn("conversation", F.to_json("conversation"))
    as_text.write.mode("append").json(path)
    spark.range(2).select(F.when(F.col("id") == 0, '{"brand": "cut off').otherwise("  ").alias("value")).write.mode("append").text(path)
    back = threads.unnest_threads(tables.read_threads(spark, path))
    return back.select("brand", "support_tweet_id", "num_messages", "position", "tweet_id", "speaker", "text")


_BAR = "=" * 80


@register("s8_transcripts", f"""WITH {sql.THREAD_TURNS},
blocks AS (SELECT chr(10) || '{_BAR}' || chr(10) || 'BRAND: ' || brand || chr(10) || 'SUPPORT TWEET: ' || support_tweet_id || chr(10)
  || 'MESSAGES: ' || num_messages || chr(10) || '{_BAR}' || chr(10) || chr(10)
  || string_agg('[' || coalesce(speaker, 'nan') || '] ' || coalesce(text, 'nan') || chr(10) || '    tweet_id: ' || tweet_id || chr(10),
     chr(10) ORDER BY position) AS value
  FROM thread_turns GROUP BY brand, support_tweet_id, num_messages),
lines AS (SELECT unnest(string_split(value, chr(10))) AS line FROM blocks)
SELECT line, count(*) AS n FROM lines WHERE line <> '' GROUP BY line""")
def _(spark, folder):
    path = scratch_path(spark, "transcripts")
    sinks.write_transcripts(_nested(spark, folder), path)
    lines = spark.read.option("lineSep", "\n").text(path).where("value <> ''")
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@register("s9_reloaded_vocabulary", retrieval.SQL["m1_vocabulary"])
def _(spark, folder):
    path = scratch_path(spark, "text-model")
    tfidf.fit(retrieval._customer_texts(spark, folder)).save(path)
    vocabulary = tfidf.TfidfModel.load(spark, path).vocabulary
    return vocabulary.select("term", "df", "total", F.round("idf", 6).alias("idf"))


@register("s10_quality_report", f"""WITH {sql.MESSAGES}
SELECT 'Raw rows:' AS line, count(*) AS n FROM messages UNION ALL
SELECT 'Customer / inbound rows:', count(*) FILTER (inbound) FROM messages UNION ALL
SELECT 'Support / outbound rows:', count(*) FILTER (NOT coalesce(inbound, false)) FROM messages""")
def _(spark, folder):
    """Three of the report's figures, read from its text."""
    path = scratch_path(spark, "report")
    sinks.write_report(audit.quality_metrics(cut_lineage(messages(spark, folder))), path)
    text = spark.read.text(path, wholetext=True).where("value <> ''")
    return text.select(F.explode(F.array(*[
        F.struct(F.lit(label).alias("line"), F.regexp_replace(
            F.regexp_extract("value", label + r"\s+([0-9,]+)", 1), ",", "").try_cast("bigint").alias("n"))
        for label in ("Raw rows:", "Customer / inbound rows:", "Support / outbound rows:")
    ])).alias("r")).select("r.*")


@register("a12_brand_threads", f"""WITH {sql.THREAD_TURNS}
SELECT brand, count(*) AS conversations, round(avg(num_messages), 6) AS avg_messages,
       round(median(num_messages), 6) AS median_messages, max(num_messages) AS max_messages
FROM thread_turns WHERE brand = 'brand2' AND position = num_messages GROUP BY brand""")
def _(spark, folder):
    """Thread lengths of one brand, named in another case; an empty selection would be an error."""
    turns = require_rows(of_brand(support_threads(spark, folder), "BRAND2"), "conversations")
    return threads.thread_summary(turns).withColumns({c: F.round(c, 6) for c in ("avg_messages", "median_messages")})


@register("p13_serve", f"""{retrieval._TRIAGED}
SELECT CAST(query_id AS BIGINT) AS query_id, true AS accepted, intent, action, response, historical_cases
FROM triaged JOIN case_lists USING (query_id)
UNION ALL SELECT -id - 1, false, NULL, NULL, NULL, NULL FROM texts""")
def _(spark, folder):
    """Requests of all customer turns, and as many empty or missing messages, which are rejected."""
    cases = retrieval._cases(spark, folder)
    good = retrieval._queries(spark, folder).withColumnRenamed("query", "message")
    bad = good.select((-F.col("query_id") - 1).alias("query_id"), F.when(F.col("query_id") % 2 == 0, "").alias("message"))
    responses, rejected = triage_plan.serve(
        good.unionByName(bad), cases, retrieval._case_model(cases), rules=RULES, keywords=KEYWORDS, case_texts=False
    )
    ids = F.transform("historical_cases", lambda c: c["case_id"].cast("string"))
    served = responses.select(
        "query_id", F.lit(True).alias("accepted"), "intent", "action", "response", F.array_join(ids, "|").alias("historical_cases")
    )
    return served.unionByName(rejected.select("query_id", F.lit(False).alias("accepted")), allowMissingColumns=True)
