"""Registered thread and sampling queries with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave.functions import text as tx
from caseweave.operators import sampling, threads
from caseweave.operators.cases import leakage_counters, without_ids
from caseweave.operators.relational import customers_of, drop_blank, place_after, project, support_of
from caseweave.plans import preparation
from caseweave.sources.supplied import messages, table
from catalog import dialect as sql

QUERIES, SQL = {}, {}
BRANDS = [f"brand{i}" for i in range(6)]
FIRST_PER_BRAND = 100


def register(name, twin=None):
    def add(query):
        QUERIES[name] = query
        if twin:
            SQL[name] = twin
        return query

    return add


@register("j2_brand_slice", f"""WITH {sql.MESSAGES},
own AS (SELECT * FROM messages WHERE author_id = 'brand1')
SELECT tweet_id, author_id, inbound, text FROM messages
WHERE author_id = 'brand1' OR (inbound AND in_response_to_tweet_id IN (SELECT tweet_id FROM own))""")
def _(spark, folder):
    return threads.brand_slice(messages(spark, folder), "brand1").select("tweet_id", "author_id", "inbound", "text")


@register("j2_brand_slice_openers", f"""WITH {sql.MESSAGES},
own AS (SELECT * FROM messages WHERE author_id = 'brand1')
SELECT tweet_id, author_id FROM messages
WHERE author_id = 'brand1' OR (inbound AND in_response_to_tweet_id IN (SELECT tweet_id FROM own))
   OR tweet_id IN (SELECT in_response_to_tweet_id FROM own)""")
def _(spark, folder):
    return threads.brand_slice(messages(spark, folder), "brand1", include_openers=True).select("tweet_id", "author_id")


@register("j3_without_golden", f"""SELECT doc_id, text FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND NOT {sql.blank('text')}""")
def _(spark, folder):
    docs, golden = table(spark, folder, "documents"), table(spark, folder, "labels")
    return drop_blank(without_ids(docs, golden, "doc_id"), "text").select("doc_id", "text")


@register("a25_leakage_counters", f"""WITH d AS (
  SELECT *, doc_id IN (SELECT doc_id FROM labels) AS golden FROM documents)
SELECT 'rows_before' AS metric, count(*) AS value FROM d UNION ALL
SELECT 'golden_rows_removed', count(*) FILTER (golden) FROM d UNION ALL
SELECT 'rows_after', count(*) FILTER (NOT golden) FROM d UNION ALL
SELECT 'unique_texts', count(DISTINCT text) FILTER (NOT golden AND NOT {sql.blank('text')}) FROM d""")
def _(spark, folder):
    return leakage_counters(table(spark, folder, "documents"), table(spark, folder, "labels"), "text", "doc_id")


_FIRST = f"""WITH {sql.MESSAGES},
firsts AS (
  SELECT * FROM messages WHERE NOT inbound
  QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY tweet_id) <= {FIRST_PER_BRAND})"""


def _first_support(spark, folder):
    replies = support_of(messages(spark, folder, children=True), BRANDS)
    return sampling.first_n_per_group(replies, ["author_id"], ["tweet_id"], FIRST_PER_BRAND)


@register("w1_first_n", _FIRST + """
SELECT author_id AS brand, tweet_id AS support_tweet_id, text AS support_text,
       in_response_to_tweet_id AS parent_customer_tweet_id, response_tweet_id, created_at FROM firsts""")
def _(spark, folder):
    return _first_support(spark, folder).select(
        F.col("author_id").alias("brand"), F.col("tweet_id").alias("support_tweet_id"),
        F.col("text").alias("support_text"), F.col("in_response_to_tweet_id").alias("parent_customer_tweet_id"),
        "response_tweet_id", "created_at",
    )


@register("a16_sample_sizes", _FIRST + " SELECT author_id AS brand, count(*) AS n FROM firsts GROUP BY author_id")
def _(spark, folder):
    return _first_support(spark, folder).groupBy(F.col("author_id").alias("brand")).agg(F.count(F.lit(1)).alias("n"))


@register("w1_first_lineitems", """SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey,
    l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r <= 100""")
def _(spark, folder):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    first = sampling.first_n_per_group(table(spark, folder, "lineitem"), ["l_returnflag"], order, 100)
    return first.select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")


@register("w2_sample_per_group", f"""SELECT source, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY {sql.seeded(42, 'doc_id')}, doc_id) AS r FROM documents)
WHERE r <= 200""")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("source", "doc_id")
    return sampling.sample_per_group(docs, ["source"], "doc_id", 200)


@register("w3_sample", f"""SELECT doc_id, lang, source FROM documents
ORDER BY {sql.seeded(42, 'doc_id')}, doc_id LIMIT 500""")
def _(spark, folder):
    sample = sampling.sample_rows(table(spark, folder, "documents"), "doc_id", 500)
    return project(sample, ["doc_id", "no_such_column", "lang", "source"])


@register("w4_dedup_id", """SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) = 1""")
def _(spark, folder):
    order = [F.col("ts").asc_nulls_last(), "event_id"]
    return sampling.keep_first(table(spark, folder, "events"), ["user_id"], order).select(
        "user_id", "event_id", "event_type"
    )


@register("w5_dedup_text", f"""SELECT min(doc_id) AS doc_id, text FROM documents WHERE NOT {sql.blank('text')}
GROUP BY text""")
def _(spark, folder):
    docs = drop_blank(table(spark, folder, "documents"), "text")
    return sampling.unique_texts(docs, "text", "doc_id").select("doc_id", "text")


_CLEAN = f"""clean AS (
  SELECT *, coalesce(text, '') AS raw_text, {sql.clean('text')} AS clean_text FROM messages)"""
_SAMPLE = f"""{_CLEAN},
customers AS (
  SELECT * FROM clean WHERE coalesce(inbound, false) AND NOT {sql.blank('clean_text')}
  QUALIFY row_number() OVER (PARTITION BY clean_text ORDER BY tweet_id) = 1),
discovery AS (
  SELECT tweet_id, created_at, author_id, clean_text, response_tweet_id, in_response_to_tweet_id FROM customers
  ORDER BY {sql.seeded(42, 'tweet_id')}, tweet_id LIMIT 500)"""


def _clean(spark, folder):
    return preparation.clean_messages(messages(spark, folder, children=True))[0]


@register("e16_clean_messages", f"""WITH {sql.MESSAGES}, {_CLEAN}
SELECT tweet_id, author_id, inbound, created_at, raw_text, clean_text, response_tweet_id, in_response_to_tweet_id
FROM clean""")
def _(spark, folder):
    return _clean(spark, folder).select(
        "tweet_id", "author_id", "inbound", "created_at", "raw_text", "clean_text", "response_tweet_id",
        "in_response_to_tweet_id",
    )


@register("e15_discovery_sample", f"WITH {sql.MESSAGES}, {_SAMPLE} SELECT * FROM discovery")
def _(spark, folder):
    return preparation.discovery_sample(_clean(spark, folder))


@register("e14_golden_candidates", f"""WITH {sql.MESSAGES}, {_SAMPLE}
SELECT d.*, '' AS intent, '' AS resolution_status, '' AS requires_escalation, '' AS annotation_notes
FROM discovery d ORDER BY {sql.seeded(42, 'tweet_id')}, tweet_id LIMIT 200""")
def _(spark, folder):
    sample = preparation.discovery_sample(_clean(spark, folder))
    return preparation.golden_candidates(sample).drop("intent_options", "resolution_options", "escalation_options")


_PICKED = f"""picked AS (
  SELECT author_id AS brand, tweet_id AS support_tweet_id FROM messages WHERE NOT inbound)"""


def _picked(spark, folder):
    """Every support message."""
    replies = support_of(messages(spark, folder), BRANDS)
    return replies.select(F.col("author_id").alias("brand"), F.col("tweet_id").alias("support_tweet_id"))


@register("j8_neighbours", f"""WITH {sql.MESSAGES}, {_PICKED},
chosen AS (SELECT m.* FROM messages m JOIN picked p ON m.tweet_id = p.support_tweet_id),
ids AS (
  SELECT tweet_id FROM chosen UNION SELECT in_response_to_tweet_id FROM chosen
  UNION SELECT CAST(trim(c) AS BIGINT) FROM (SELECT unnest(string_split(response_tweet_id, ',')) AS c FROM chosen))
SELECT tweet_id, author_id, inbound, text FROM messages WHERE tweet_id IN (SELECT tweet_id FROM ids)""")
def _(spark, folder):
    targets = _picked(spark, folder).select(F.col("support_tweet_id").alias("tweet_id"))
    return threads.neighbours(messages(spark, folder, children=True), targets).select("tweet_id", "author_id", "inbound", "text")


_CHAINS = f"""WITH RECURSIVE {sql.MESSAGES.strip()}, {_PICKED},
chain AS (
  SELECT p.support_tweet_id, m.tweet_id, m.in_response_to_tweet_id AS parent_id, 0 AS hops
  FROM picked p JOIN messages m ON m.tweet_id = p.support_tweet_id
  UNION ALL
  SELECT c.support_tweet_id, m.tweet_id, m.in_response_to_tweet_id, c.hops + 1
  FROM chain c JOIN messages m ON m.tweet_id = c.parent_id
),
chains AS (
  SELECT p.brand, c.support_tweet_id, count(*) OVER (PARTITION BY c.support_tweet_id) AS num_messages,
         count(*) OVER (PARTITION BY c.support_tweet_id) - c.hops AS position, c.tweet_id,
         CASE WHEN m.inbound THEN 'customer' WHEN NOT m.inbound THEN 'support' END AS speaker,
         m.author_id, m.created_at, m.text, c.parent_id
  FROM chain c JOIN picked p USING (support_tweet_id) JOIN messages m ON m.tweet_id = c.tweet_id
)"""


@register("j9_ancestor_ids", _CHAINS + " SELECT DISTINCT tweet_id FROM chains")
def _(spark, folder):
    targets = _picked(spark, folder).select(F.col("support_tweet_id").alias("tweet_id"))
    return threads.ancestor_ids(messages(spark, folder), targets)


@register("j10_reply_chains", _CHAINS + " SELECT * FROM chains")
def reply_chains(spark, folder):
    return threads.reply_chains(messages(spark, folder), _picked(spark, folder))


@register("a11_thread_summary", _CHAINS + """
SELECT brand, count(*) AS conversations, round(avg(num_messages), 6) AS avg_messages,
       round(median(num_messages), 6) AS median_messages, max(num_messages) AS max_messages
FROM chains WHERE position = num_messages GROUP BY brand""")
def _(spark, folder):
    summary = threads.thread_summary(reply_chains(spark, folder))
    return summary.withColumns({c: F.round(c, 6) for c in ("avg_messages", "median_messages")})


@register("j11_context", f"""WITH {sql.MESSAGES}, {_CLEAN},
targets AS (SELECT tweet_id FROM messages WHERE inbound),
back AS (
  SELECT t.tweet_id AS target, t.tweet_id // {sql.TURN_SPACE} AS conv_id, t.tweet_id % {sql.TURN_SPACE} AS turn,
         greatest(t.tweet_id % {sql.TURN_SPACE} - 9, 0) AS first FROM targets t),
lines AS (
  SELECT b.target, c.tweet_id, CASE WHEN coalesce(c.inbound, false) THEN 'CUSTOMER: ' ELSE 'BRAND: ' END || trim(c.clean_text)
    AS line
  FROM back b JOIN clean c ON c.tweet_id // {sql.TURN_SPACE} = b.conv_id
    AND c.tweet_id % {sql.TURN_SPACE} BETWEEN b.first AND b.first + 9
  WHERE NOT {sql.blank('c.clean_text')})
SELECT t.tweet_id, m.clean_text, coalesce(string_agg(line, chr(10) ORDER BY l.tweet_id), '') AS conversation_context
FROM targets t JOIN clean m USING (tweet_id) LEFT JOIN lines l ON l.target = t.tweet_id
GROUP BY t.tweet_id, m.clean_text""")
def _(spark, folder):
    clean = preparation.with_clean_text(messages(spark, folder, children=True))
    targets = customers_of(clean).select("tweet_id", "clean_text")
    windows = threads.context_windows(clean, targets, 10, support_label="BRAND")
    return place_after(targets.join(windows, "tweet_id"), "conversation_context", "clean_text")


@register("f11_speakers", f"""WITH {sql.MESSAGES}
SELECT tweet_id, CASE WHEN inbound THEN 'CUSTOMER' WHEN NOT inbound THEN 'SUPPORT' END AS speaker,
       CAST(response_tweet_id AS BIGINT) AS first_child FROM messages""")
def _(spark, folder):
    return messages(spark, folder, children=True).select(
        "tweet_id", tx.speaker_of(F.col("inbound"), "CUSTOMER", "SUPPORT").alias("speaker"),
        F.try_element_at(tx.split_ids(F.col("response_tweet_id")), F.lit(1)).alias("first_child"),
    )
