"""Registered audit and text queries with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave.functions import decisions, judging, lexicon, text as tx
from caseweave.operators import audit, labels, metrics
from caseweave.operators.relational import (
    drop_blank, frequent_classes, support_of, top_rows, value_counts,
)
from caseweave.operators.threads import brand_slice
from caseweave.session import cut_lineage
from caseweave.sources.supplied import messages, table
from catalog import dialect as sql
from catalog.tables import KEYWORDS

QUERIES, SQL = {}, {}
BRANDS = [f"brand{i}" for i in range(6)]


def register(name, twin=None):
    def add(query):
        QUERIES[name] = query
        if twin:
            SQL[name] = twin
        return query

    return add


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@register("a1_message_counts", f"""WITH {sql.MESSAGES}
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'total_rows' AS metric, count(*) AS value FROM messages UNION ALL
  SELECT 'inbound_customer_tweets', count(*) FILTER (inbound) FROM messages UNION ALL
  SELECT 'outbound_support_tweets', count(*) FILTER (NOT inbound) FROM messages UNION ALL
  SELECT 'unique_tweet_ids', count(DISTINCT tweet_id) FROM messages UNION ALL
  SELECT 'duplicate_tweet_ids', count(tweet_id) - count(DISTINCT tweet_id) FROM messages
)""")
def _(spark, folder):
    return audit.message_totals(messages(spark, folder))


_COLUMNS = ["tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id"]


@register("a2_missing_values", f"WITH {sql.MESSAGES}\n" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing_values,
    round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 6) AS missing_percentage FROM messages"""
    for c in _COLUMNS
))
def _(spark, folder):
    return _rounded(audit.missing_values(messages(spark, folder, children=True)), "missing_percentage")


@register("a4_text_frequency", "SELECT coalesce(text, '') AS text, count(*) AS n FROM documents GROUP BY 1")
def _(spark, folder):
    return audit.text_frequency(table(spark, folder, "documents"))


_AUTHORS = f"""WITH {sql.MESSAGES},
authors AS (
  SELECT author_id, count(*) AS tweets, count(*) FILTER (inbound) AS inbound,
         count(*) FILTER (NOT inbound) AS outbound, count(response_tweet_id) AS tweets_with_responses,
         round(count(response_tweet_id) / count(*), 6) AS response_rate
  FROM messages WHERE author_id IS NOT NULL GROUP BY author_id
)"""


@register("a5_author_stats", _AUTHORS + " SELECT * FROM authors")
def _(spark, folder):
    return _rounded(audit.author_statistics(messages(spark, folder, children=True)), "response_rate")


@register("o2_top_authors", _AUTHORS + " SELECT * FROM authors ORDER BY tweets DESC, author_id LIMIT 30")
def _(spark, folder):
    stats = _rounded(audit.author_statistics(messages(spark, folder, children=True)), "response_rate")
    return top_rows(stats, [F.desc("tweets"), "author_id"], 30)


@register("a7_duplicated_rows", """
SELECT (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM documents GROUP BY text) WHERE n > 1)
         AS duplicate_text_rows,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM labels GROUP BY quality, toxic) WHERE n > 1)
         AS duplicate_label_rows""")
def _(spark, folder):
    texts = audit.duplicated_rows(table(spark, folder, "documents"), F.col("text"), "duplicate_text_rows")
    pairs = audit.duplicated_rows(
        table(spark, folder, "labels"), F.struct("quality", "toxic"), "duplicate_label_rows"
    )
    return texts.withColumn("duplicate_label_rows", pairs.scalar())


_SLICE = f"""WITH {sql.MESSAGES},
own AS (SELECT * FROM messages WHERE author_id = 'brand0'),
slice AS (
  SELECT * FROM own UNION ALL
  SELECT * FROM messages WHERE author_id <> 'brand0' AND inbound
    AND in_response_to_tweet_id IN (SELECT tweet_id FROM own)
)"""


@register("a8_quality_metrics", f"""{_SLICE}
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'raw_rows' AS metric, count(*) AS value FROM slice UNION ALL
  SELECT 'clean_rows', count(DISTINCT tweet_id) FROM slice UNION ALL
  SELECT 'duplicate_tweet_id_rows', coalesce(sum(n) FILTER (n > 1), 0)
    FROM (SELECT count(*) AS n FROM slice GROUP BY tweet_id) UNION ALL
  SELECT 'duplicate_text_rows', coalesce(sum(n) FILTER (n > 1), 0)
    FROM (SELECT count(*) AS n FROM slice GROUP BY coalesce(text, '')) UNION ALL
  SELECT 'empty_text_rows', count(*) FILTER ({sql.blank('text')}) FROM slice UNION ALL
  SELECT 'invalid_created_at_rows',
    count(*) FILTER (try_strptime(substr(created_at, 5), '%b %d %H:%M:%S %z %Y') IS NULL) FROM slice UNION ALL
  SELECT 'customer_inbound_rows', count(*) FILTER (coalesce(inbound, false)) FROM slice UNION ALL
  SELECT 'support_outbound_rows', count(*) FILTER (NOT coalesce(inbound, false)) FROM slice UNION ALL
  SELECT 'missing_parent_references', count(*) FROM slice
    WHERE in_response_to_tweet_id NOT IN (SELECT tweet_id FROM slice)
)""")
def _(spark, folder):
    # The metrics read the slice several times, so it is written once.
    return audit.quality_metrics(cut_lineage(brand_slice(messages(spark, folder), "brand0")))


@register("a9_reply_stats", f"""WITH {sql.MESSAGES}
SELECT s.author_id AS brand, count(*) AS support_tweets,
       count(DISTINCT c.tweet_id) AS customer_messages_answered, count(c.tweet_id) AS support_replies_to_customer
FROM messages s LEFT JOIN messages c ON c.tweet_id = s.in_response_to_tweet_id AND c.inbound
WHERE NOT s.inbound GROUP BY s.author_id""")
def _(spark, folder):
    return audit.reply_statistics(messages(spark, folder))


def _kpis(source, brand):
    def share(condition):
        return f"round(count(*) FILTER ({condition}) / count(*), 6)"

    return f"""
SELECT {brand} AS brand, count(*) AS support_tweets, count(DISTINCT coalesce(text, '')) AS unique_support_responses,
       round(count(DISTINCT coalesce(text, '')) / count(*), 6) AS response_diversity,
       round(sum({sql.word_count('text')}) / count(*), 6) AS average_response_words,
       {share(sql.contains_any('text', lexicon.DM_SIGNALS))} AS dm_request_rate,
       {share(sql.contains_any('text', lexicon.APOLOGY_SIGNALS))} AS apology_rate,
       {share(sql.contains_any('text', lexicon.RESOLUTION_SIGNALS))} AS resolution_signal_rate
FROM {source} GROUP BY {brand}"""


_RATES = (
    "response_diversity", "average_response_words", "dm_request_rate", "apology_rate", "resolution_signal_rate",
)


@register("a10_source_kpis", _kpis("documents", "source"))
def source_kpis(spark, folder):
    return _rounded(audit.reply_quality(table(spark, folder, "documents"), brand="source"), *_RATES)


@register("a10_brand_kpis", f"WITH {sql.MESSAGES}" + _kpis("(SELECT * FROM messages WHERE NOT inbound)", "author_id"))
def _(spark, folder):
    return _rounded(audit.reply_quality(support_of(messages(spark, folder), BRANDS)), *_RATES)


@register("a13_value_counts", f"""WITH {sql.MESSAGES} SELECT inbound, count(*) AS n FROM messages GROUP BY inbound""")
def _(spark, folder):
    return value_counts(messages(spark, folder), "inbound")


# An annotated set made from the labels, with nulls, blanks and values outside the domains.
_GOLDEN_SQL = """WITH golden AS (
  SELECT doc_id AS annotation_id,
         CASE WHEN quality = 1 THEN 'PLAYBACK' WHEN toxic = 1 THEN 'NOT_AN_INTENT' ELSE 'OTHER' END AS intent,
         CASE WHEN toxic = 0 THEN 'RESOLVED' END AS resolution_status,
         CASE WHEN quality = toxic THEN '  ' ELSE 'NO' END AS requires_escalation,
         CASE WHEN quality = 0 THEN 'see text' END AS annotation_notes
  FROM labels
)"""
_EXPECTED = 1000


def _golden(spark, folder):
    good, bad = F.col("quality") == 1, F.col("toxic") == 1
    return table(spark, folder, "labels").select(
        F.col("doc_id").alias("annotation_id"),
        F.when(good, "PLAYBACK").when(bad, "NOT_AN_INTENT").otherwise("OTHER").alias("intent"),
        F.when(~bad, "RESOLVED").alias("resolution_status"),
        F.when(F.col("quality") == F.col("toxic"), "  ").otherwise("NO").alias("requires_escalation"),
        F.when(~good, "see text").alias("annotation_notes"),
    )


def _domain_sql(column):
    listed = ", ".join(f"'{v}'" for v in labels.LABEL_DOMAINS[column])
    return f"""SELECT 'invalid_value' AS "check", '{column}' AS subject, {column} AS value, count(*) AS n FROM golden
WHERE {column} NOT IN ({listed}) GROUP BY {column}"""


_LABEL_COLUMNS = (*labels.LABEL_DOMAINS, "annotation_notes")
_FINDINGS = f"""{_GOLDEN_SQL},
expected AS (SELECT range AS id FROM range(1, {_EXPECTED + 1})),
findings AS (
  SELECT 'missing_id' AS "check", 'annotation_id' AS subject, CAST(id AS VARCHAR) AS value, 1 AS n FROM expected
    WHERE id NOT IN (SELECT annotation_id FROM golden)
  UNION ALL SELECT 'extra_id', 'annotation_id', CAST(annotation_id AS VARCHAR), count(*) FROM golden
    WHERE annotation_id NOT IN (SELECT id FROM expected) GROUP BY annotation_id
  UNION ALL SELECT 'duplicate_id', 'annotation_id', CAST(annotation_id AS VARCHAR), count(*) FROM golden
    GROUP BY annotation_id HAVING count(*) > 1
  UNION ALL {" UNION ALL ".join(f"SELECT 'null_label', '{c}', NULL, count(*) FILTER ({c} IS NULL) FROM golden" for c in _LABEL_COLUMNS)}
  UNION ALL {" UNION ALL ".join(f"SELECT 'empty_label', '{c}', NULL, count(*) FILTER ({c} IS NOT NULL AND {sql.blank(c)}) FROM golden" for c in _LABEL_COLUMNS)}
  UNION ALL {" UNION ALL ".join(_domain_sql(c) for c in labels.LABEL_DOMAINS)}
)"""


@register("a17_label_findings", _FINDINGS + ' SELECT "check", subject, value, CAST(n AS BIGINT) AS n FROM findings')
def _(spark, folder):
    return labels.label_findings(_golden(spark, folder), expected=_EXPECTED)


def _reason_sql(condition, text, amount="count(*)"):
    return f"""(SELECT CASE WHEN {amount} > 0 THEN '{text}: ' || CAST({amount} AS BIGINT) END FROM findings WHERE {condition})"""


_REASONS = ", ".join([
    _reason_sql("\"check\" = 'missing_id'", "Missing IDs"),
    _reason_sql("\"check\" = 'extra_id'", "Extra IDs"),
    _reason_sql("\"check\" = 'duplicate_id'", "Duplicate IDs"),
    _reason_sql("\"check\" = 'null_label' AND subject <> 'annotation_notes'", "Missing required labels", "sum(n)"),
    *[_reason_sql(f"\"check\" = 'invalid_value' AND subject = '{c}'", f"Invalid {c} values") for c in labels.LABEL_DOMAINS],
])


@register("a20_label_verdict", f"""{_FINDINGS}
SELECT total_rows, CASE WHEN reasons = '' AND total_rows = {_EXPECTED} THEN 'PASS' ELSE 'REVIEW REQUIRED' END AS status,
       reasons
FROM (SELECT (SELECT count(*) FROM golden) AS total_rows, concat_ws('; ', {_REASONS}) AS reasons)""")
def _(spark, folder):
    verdict = labels.label_verdict(_golden(spark, folder), expected=_EXPECTED)
    return verdict.withColumn("reasons", F.array_join("reasons", "; "))


@register("f1_clean_pages", f"SELECT page_id, {sql.clean('html')} AS clean_text FROM pages")
def _(spark, folder):
    pages = table(spark, folder, "pages", text_work=True)
    return pages.select("page_id", tx.clean_text(F.col("html")).alias("clean_text"))


@register("f1_clean_documents", f"SELECT doc_id, {sql.clean('text')} AS clean_text FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents", text_work=True)
    return docs.select("doc_id", tx.clean_text(F.col("text")).alias("clean_text"))


@register("f5_normalize", f"SELECT doc_id, {sql.normalize('text')} AS normalized FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents", text_work=True)
    return docs.select("doc_id", tx.normalize(F.col("text")).alias("normalized"))


@register("f6_clean_reply", f"SELECT doc_id, {sql.clean_reply('text')} AS reply FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents", text_work=True)
    return docs.select("doc_id", tx.clean_reply(F.col("text")).alias("reply"))


@register("f7_parse_time", f"""WITH {sql.MESSAGES}
SELECT tweet_id, CAST(epoch(strptime(substr(created_at, 5), '%b %d %H:%M:%S %z %Y')) AS BIGINT) AS seconds,
       try_strptime(substr(text, 5), '%b %d %H:%M:%S %z %Y') IS NULL AS text_is_no_time
FROM messages""")
def _(spark, folder):
    return messages(spark, folder).select(
        "tweet_id",
        F.unix_seconds(tx.parse_created_at(F.col("created_at"))).alias("seconds"),
        tx.parse_created_at(F.col("text")).isNull().alias("text_is_no_time"),
    )


@register("f8_text_signals", f"""SELECT doc_id, {sql.word_count('text')} AS n_words,
{sql.contains_any('text', lexicon.DM_SIGNALS)} AS dm, {sql.contains_any('text', lexicon.APOLOGY_SIGNALS)} AS apology,
{sql.contains_any('text', lexicon.RESOLUTION_SIGNALS)} AS resolution FROM documents""")
def _(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents", text_work=True).select(
        "doc_id", tx.word_count(text).cast("bigint").alias("n_words"), tx.asks_for_dm(text).alias("dm"),
        tx.apologises(text).alias("apology"), tx.signals_resolution(text).alias("resolution"),
    )


# Replies of a judge made from the documents: fenced, wrapped in prose, with line breaks, without JSON.
_SCORE = {d: f"doc_id % {i + 2} + 1" for i, d in enumerate(judging.DIMENSIONS)}
_BODY = " || ', ' || ".join(f"'\"{d}\": ' || CAST({e} AS {{}})" for d, e in _SCORE.items())
_REPLY = """CASE WHEN doc_id % 7 = 0 THEN 'no verdict for ' || lang
 WHEN doc_id % 3 = 0 THEN '```json' || chr(10) || '{{' || {body} || ', "reason": "' || lang || '"}}' || chr(10) || '```'
 ELSE 'My scores:' || chr(10) || '{{' || {body} || ',' || chr(10) || ' "reason": "' || source || '"}} done' END"""


@register("f15_judge_json", "SELECT doc_id, " + ", ".join(
    f"CASE WHEN doc_id % 7 <> 0 THEN CAST({e} AS INTEGER) END AS {d}" for d, e in _SCORE.items()
) + """, CASE WHEN doc_id % 7 = 0 THEN 'Judge error: No JSON object found: no verdict for ' || lang
 WHEN doc_id % 3 = 0 THEN lang ELSE source END AS reason FROM documents""")
def _(spark, folder):
    raw = F.expr(_REPLY.format(body=_BODY.format(*["STRING"] * len(_SCORE))))
    replies = table(spark, folder, "documents").select("doc_id", raw.alias("raw"))
    return judging.parse_judgments(replies, "raw").select("doc_id", *judging.DIMENSIONS, "reason")


@register("f18_report_formats", f"""SELECT source, left(max(text), 600) AS excerpt,
printf('%.2f%%', 100.0 * count(*) FILTER ({sql.contains_any('text', ['the'])}) / count(*)) AS share
FROM documents GROUP BY source""")
def _(spark, folder):
    grouped = table(spark, folder, "documents").groupBy("source").agg(
        F.max(tx.shorten(F.col("text"))).alias("t"),
        tx.safe_ratio(F.count_if(tx.contains_any(F.col("text"), ["the"])), F.count(F.lit(1))).alias("r"),
    )
    return grouped.select("source", F.col("t").alias("excerpt"), tx.as_percent(F.col("r")).alias("share"))


@register("f19_keyword_scores", "SELECT doc_id, " + ", ".join(
    f"round({sql.compatibility_case(sql.quoted(i), 'text', KEYWORDS)}, 6) AS {i.lower()}" for i in KEYWORDS
) + " FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents", text_work=True)
    return docs.select("doc_id", *[
        F.round(decisions.keyword_compatibility(F.col("text"), i, KEYWORDS), 6).alias(i.lower()) for i in KEYWORDS
    ])


_SHIPPED = lexicon.INTENT_KEYWORDS


@register("f19_shipped_keywords", "SELECT doc_id, " + ", ".join(
    f"round({sql.compatibility_case(sql.quoted(i), 'text', _SHIPPED)}, 6) AS {i.lower()}" for i in _SHIPPED
) + " FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def _(spark, folder):
    docs = table(spark, folder, "documents", text_work=True)
    return docs.select("doc_id", *[
        F.round(decisions.keyword_compatibility(F.col("text"), i), 6).alias(i.lower()) for i in _SHIPPED
    ])


@register("p12_frequent_classes", """WITH classed AS (
  SELECT doc_id, coalesce(source, '') || '/' || lang AS class FROM documents),
sizes AS (SELECT class, count(*) AS n FROM classed GROUP BY class)
SELECT doc_id, class FROM classed JOIN sizes USING (class) WHERE n >= 10""")
def _(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.coalesce("source", F.lit("")), F.lit("/"), "lang").alias("class")
    )
    return frequent_classes(docs, "class", 10)[0].select("doc_id", "class")


_CONFUSION = """WITH counts AS (
  SELECT quality AS label, toxic AS predicted, count(*) AS n FROM labels GROUP BY quality, toxic)"""
_MAJORITY = """WITH majority AS (SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1),
counts AS (SELECT l.quality AS label, m.quality AS predicted, count(*) AS n FROM labels l, majority m GROUP BY 1, 2)"""
_SCORES = """,
sides AS (
  SELECT label AS class, n AS support, 0 AS guesses, CASE WHEN label = predicted THEN n ELSE 0 END AS hits FROM counts
  UNION ALL SELECT predicted, 0, n, 0 FROM counts),
sums AS (SELECT class, sum(support) AS support, sum(guesses) AS guesses, sum(hits) AS hits FROM sides GROUP BY class),
scores AS (
  SELECT class, support, hits, CASE WHEN guesses = 0 THEN 0 ELSE hits / guesses END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
         CASE WHEN support + guesses = 0 THEN 0 ELSE 2 * hits / (support + guesses) END AS f1 FROM sums)"""
_OVERALL = """ SELECT CAST(sum(support) AS BIGINT) AS examples, round(sum(hits) / sum(support), 6) AS accuracy,
round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM scores"""


def _counts(spark, folder):
    return metrics.confusion_counts(table(spark, folder, "labels"), "quality", "toxic")


@register("m14_majority", _MAJORITY + _SCORES + _OVERALL)
def _(spark, folder):
    guessed = metrics.predict_majority(table(spark, folder, "labels"), "quality")
    scores = metrics.overall_scores(metrics.confusion_counts(guessed, "quality", "predicted"))
    return _rounded(scores, "accuracy", "macro_f1", "weighted_f1")


@register("m16_scores", _CONFUSION + _SCORES + _OVERALL)
def _(spark, folder):
    return _rounded(metrics.overall_scores(_counts(spark, folder)), "accuracy", "macro_f1", "weighted_f1")


@register("m17_report", _CONFUSION + _SCORES + """,
rows AS (
  SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM scores
  UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support)
    FROM scores
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM scores)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM rows""")
def _(spark, folder):
    return _rounded(metrics.classification_report(_counts(spark, folder)), "precision", "recall", "f1")


@register("m18_confusion", """SELECT quality AS label, count(*) FILTER (toxic = 0) AS pred_0,
count(*) FILTER (toxic = 1) AS pred_1 FROM labels GROUP BY quality""")
def _(spark, folder):
    return metrics.confusion_matrix(_counts(spark, folder), [0, 1])


@register("a24_agreement", """WITH c AS (SELECT quality AS a, toxic AS b FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL),
t AS (SELECT count(*) AS n, avg(a) AS mean_first, avg(b) AS mean_second, avg(CAST(a = b AS INTEGER)) AS po FROM c),
e AS (SELECT sum(x.n * y.n) AS s FROM (SELECT a, count(*) AS n FROM c GROUP BY a) x
      JOIN (SELECT b, count(*) AS n FROM c GROUP BY b) y ON x.a = y.b)
SELECT n AS pairs, round(mean_first, 6) AS mean_first, round(mean_second, 6) AS mean_second,
       round(po, 6) AS exact_agreement, round((po - s / (n * n)) / (1 - s / (n * n)), 6) AS cohen_kappa FROM t, e""")
def _(spark, folder):
    result = metrics.agreement(table(spark, folder, "labels"), "quality", "toxic")
    return _rounded(result, "mean_first", "mean_second", "exact_agreement", "cohen_kappa")
