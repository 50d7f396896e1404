"""Registered TF-IDF, retrieval, triage, evaluation and stream queries with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from caseweave.functions import decisions, judging, lexicon, text as tx
from caseweave.operators import (
    cases as case_ops, classify, clusters, metrics, postings, retrieval, sampling, similarity, tfidf,
)
from caseweave.operators.relational import drop_blank
from caseweave.operators.sampling import unique_texts
from caseweave.plans import evaluation, triage as triage_plan
from caseweave.session import cut_lineage, scratch_path
from caseweave.sources.supplied import TURN_SPACE, messages, support_threads, table
from caseweave.streaming import jobs
from catalog import dialect as sql
from catalog.tables import KEYWORDS, RULES, STOP_WORDS

QUERIES, SQL = {}, {}


def register(name, twin=None):
    def add(query):
        QUERIES[name] = query
        if twin:
            SQL[name] = twin
        return query

    return add


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- vocabulary and weights -------------------------------------------------------------------------------------


def _turn_ids():
    return F.col("conv_id") * TURN_SPACE + F.col("turn")


def _customer_texts(spark, folder):
    """(id, text) of all customer turns."""
    turns = table(spark, folder, "conversations", text_work=True).where("role = 'user'")
    return turns.select(_turn_ids().alias("id"), "text")


_CUSTOMER_TEXTS = f"""texts AS (
  SELECT conv_id * {TURN_SPACE} + turn AS id, text FROM conversations WHERE role = 'user')"""


@register("f22_grams", f"""WITH {_CUSTOMER_TEXTS}, {sql.grams('g', 'texts')}
SELECT id, term, tf FROM g""")
def _(spark, folder):
    counted = tfidf.term_counts(_customer_texts(spark, folder))
    exploded = counted.select("id", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    return exploded.select("id", F.col("e.terms").alias("term"), F.col("e.counts").cast("bigint").alias("tf"))


@register("m1_vocabulary", f"""WITH {_CUSTOMER_TEXTS}, {sql.grams('g', 'texts')}, {sql.vocabulary('g', 'texts')}
SELECT term, df, total, round(idf, 6) AS idf FROM vocabulary""")
def _(spark, folder):
    vocabulary = tfidf.fit(_customer_texts(spark, folder)).vocabulary
    return vocabulary.select("term", "df", "total", F.round("idf", 6).alias("idf"))


@register("m2_weights", f"""WITH {_CUSTOMER_TEXTS}, {sql.grams('g', 'texts')}, {sql.vocabulary('g', 'texts')},
{sql.weights('w', 'g')}
SELECT id, term, round(w, 6) AS weight FROM w""")
def _(spark, folder):
    model, vectors = tfidf.fit_transform(_customer_texts(spark, folder))
    return _rounded(tfidf.postings(vectors, model), "weight")


# --- message retrieval: customer turns against documents --------------------------------------------------------

_MATCHES = f"""WITH {_CUSTOMER_TEXTS},
corpus AS (SELECT min(doc_id) AS id, text FROM documents WHERE NOT {sql.blank('text')} GROUP BY text),
{sql.grams('cg', 'corpus')}, {sql.vocabulary('cg', 'corpus')}, {sql.weights('cw', 'cg')},
{sql.grams('qg', 'texts')}, {sql.weights('qw', 'qg')}, {sql.cosine('pairs', 'qw', 'cw')},
ranked AS (
  SELECT * FROM (
    SELECT q.id AS query_id, c.id AS case_id, coalesce(p.similarity, 0.0) AS similarity,
           row_number() OVER (PARTITION BY q.id ORDER BY round(coalesce(p.similarity, 0.0), 9) DESC, c.id) AS rank
    FROM texts q CROSS JOIN (SELECT id FROM corpus) c LEFT JOIN pairs p ON p.query_id = q.id AND p.case_id = c.id
  ) WHERE rank <= 5)"""


def _match_sides(spark, folder):
    """Customer turns, documents, and the vocabulary of the documents."""
    documents = drop_blank(table(spark, folder, "documents", text_work=True).select("doc_id", "text"), "text")
    corpus = cut_lineage(unique_texts(documents, "text", "doc_id"))
    model = tfidf.fit(tfidf.document_text(corpus, "doc_id", "text"))
    queries = _customer_texts(spark, folder).select(F.col("id").alias("query_id"), F.col("text").alias("query"))
    return queries, corpus, model


def _vectors(rows, model, key, text):
    return tfidf.transform(tfidf.document_text(rows, key, text), model)


def _document_matches(spark, folder):
    queries, corpus, model = _match_sides(spark, folder)
    return retrieval.retrieve_messages(queries, corpus, model, 5, "doc_id", "text")


@register("m3_cosine_topk", f"""{_MATCHES}
SELECT query_id, rank, case_id, round(similarity, 6) AS similarity FROM ranked""")
def cosine_topk(spark, folder):
    ranked = _document_matches(spark, folder)
    return _rounded(ranked.withColumn("rank", F.col("rank").cast("bigint")), "similarity")


@register("m3_indexed_topk", SQL["m3_cosine_topk"])
def _(spark, folder):
    """The same matches from an inverted index of the documents, whatever their number."""
    queries, corpus, model = _match_sides(spark, folder)
    index = postings.build(_vectors(corpus, model, "doc_id", "text").withColumnRenamed("id", "case_id"), depth=5)
    ranked = postings.search(_vectors(queries, model, "query_id", "query").withColumnRenamed("id", "query_id"), index, 5)
    return _rounded(ranked.select("query_id", F.col("rank").cast("bigint").alias("rank"), "case_id", "similarity"), "similarity")


_THRESHOLDS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6)


@register("a21_similarity_stats", f"""{_MATCHES},
top1 AS (SELECT similarity FROM ranked WHERE rank = 1),
best AS (SELECT query_id, max(similarity) AS similarity FROM ranked GROUP BY query_id)
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'queries' AS metric, CAST(count(*) AS DOUBLE) AS value FROM top1
  UNION ALL SELECT 'mean_top1', avg(similarity) FROM top1
  UNION ALL SELECT 'median_top1', median(similarity) FROM top1
  UNION ALL SELECT 'mean_best', avg(similarity) FROM best
  UNION ALL SELECT 'median_best', median(similarity) FROM best
  {" ".join(f"UNION ALL SELECT 'best_at_least_{round(t * 100)}_percent', avg(CAST(round(similarity, 9) >= {t} AS DOUBLE)) FROM best" for t in _THRESHOLDS)}
)""")
def _(spark, folder):
    ranked = cut_lineage(_document_matches(spark, folder))
    return _rounded(similarity.similarity_statistics(ranked, _THRESHOLDS), "value")


_ALL_TEXTS = "all_texts AS (SELECT doc_id AS id, text FROM documents)"


@register("m5_keywords", f"""WITH {_ALL_TEXTS}, {sql.grams('g', 'all_texts', STOP_WORDS)},
{sql.vocabulary('g', 'all_texts', 3, 0.9, 5000)}, {sql.weights('w', 'g')}
SELECT term, round(sum(w) / (SELECT n FROM corpus_size), 6) AS tfidf_score FROM w GROUP BY term""")
def _(spark, folder):
    docs = table(spark, folder, "documents", text_work=True)
    params = tfidf.TfidfParams(**tfidf.DISCOVERY, stop_words=STOP_WORDS)
    model, vectors = tfidf.fit_transform(tfidf.document_text(docs, "doc_id", "text"), params)
    return _rounded(tfidf.keyword_scores(vectors, model), "tfidf_score")


# --- case corpus and intent-aware retrieval ---------------------------------------------------------------------

_GOLDEN = f"""golden AS (
  SELECT conv_id * {TURN_SPACE} + turn AS tweet_id FROM conversations WHERE role = 'user'
  ORDER BY {sql.seeded(42, f'(conv_id * {TURN_SPACE} + turn)')}, conv_id, turn LIMIT 30)"""


def _golden(spark, folder):
    inbound = table(spark, folder, "conversations").where("role = 'user'").select(_turn_ids().alias("tweet_id"))
    return sampling.sample_rows(inbound, "tweet_id", 30)


_CASE_COLUMNS = "support_tweet_id, array_to_string(tweet_ids, '|') AS tweet_ids, customer_text, support_text, case_text"


def _flat_cases(cases):
    return cases.withColumn("tweet_ids", F.array_join(F.col("tweet_ids").cast("array<string>"), "|"))


@register("e1_cases", f"""WITH {sql.RAW_CASES}, {_GOLDEN},
leaked AS (SELECT support_tweet_id FROM thread_turns WHERE tweet_id IN (SELECT tweet_id FROM golden)),
kept AS (SELECT * FROM all_cases WHERE support_tweet_id NOT IN (SELECT support_tweet_id FROM leaked))
SELECT {_CASE_COLUMNS} FROM kept QUALIFY row_number() OVER (PARTITION BY case_text ORDER BY support_tweet_id) = 1""")
def _(spark, folder):
    cases = case_ops.cases_from_turns(support_threads(spark, folder))
    return _flat_cases(case_ops.unique_cases(case_ops.without_overlap(cases, _golden(spark, folder))))


@register("j4_leaked_cases", f"""WITH {sql.RAW_CASES}, {_GOLDEN}
SELECT {_CASE_COLUMNS} FROM all_cases
WHERE support_tweet_id IN (SELECT support_tweet_id FROM thread_turns WHERE tweet_id IN (SELECT tweet_id FROM golden))""")
def _(spark, folder):
    cases = case_ops.cases_from_turns(support_threads(spark, folder), brand=None)
    kept = case_ops.without_overlap(cases, _golden(spark, folder)).select("support_tweet_id")
    return _flat_cases(cases.join(kept, "support_tweet_id", "left_anti"))


@register("e2_message_corpus", f"""WITH {sql.MESSAGES}, {_GOLDEN}
SELECT min(tweet_id) AS tweet_id, clean_text FROM (
  SELECT tweet_id, {sql.clean('text')} AS clean_text FROM messages
  WHERE inbound AND tweet_id NOT IN (SELECT tweet_id FROM golden)) WHERE NOT {sql.blank('clean_text')}
GROUP BY clean_text""")
def _(spark, folder):
    clean = messages(spark, folder).withColumn("clean_text", tx.clean_text(F.col("text")))
    corpus = case_ops.message_corpus(clean, _golden(spark, folder))
    return corpus.select("tweet_id", "clean_text")


@register("m12_rules", f"""WITH {_CUSTOMER_TEXTS}, named AS (SELECT id, {sql.rule_case('text', RULES)} AS intent FROM texts)
SELECT id, coalesce(intent, 'OTHER') AS intent, CAST(CASE WHEN intent IS NULL THEN 0.0 ELSE 0.99 END AS DOUBLE) AS confidence,
       CASE WHEN intent IS NULL THEN 'default' ELSE 'rule' END AS source FROM named""")
def _(spark, folder):
    return classify.classify(_customer_texts(spark, folder), None, RULES)


@register("m12_document_rules", f"""SELECT doc_id, {sql.rule_case('text', RULES)} AS intent,
{sql.rule_case('text', lexicon.INTENT_RULES)} AS default_intent FROM documents""")
def _(spark, folder):
    docs = table(spark, folder, "documents", text_work=True)
    return docs.select(
        "doc_id", decisions.rule_intent(F.col("text"), RULES).alias("intent"),
        decisions.rule_intent(F.col("text")).alias("default_intent"),
    )


_COMPAT = sql.compatibility_case("q.intent", "c.customer_text", KEYWORDS)


def _retrieval_sql(k):
    return f"""WITH {sql.UNIQUE_CASES},
case_texts AS (SELECT support_tweet_id AS id, customer_text AS text FROM cases),
{_CUSTOMER_TEXTS},
queries AS (SELECT id, {sql.normalize('text')} AS text,
  coalesce({sql.rule_case(sql.normalize('text'), RULES)}, 'OTHER') AS intent,
  CAST(CASE WHEN {sql.rule_case(sql.normalize('text'), RULES)} IS NULL THEN 0.0 ELSE 0.99 END AS DOUBLE) AS confidence,
  CASE WHEN {sql.rule_case(sql.normalize('text'), RULES)} IS NULL THEN 'default' ELSE 'rule' END AS source FROM texts),
{sql.grams('cg', 'case_texts')}, {sql.vocabulary('cg', 'case_texts')}, {sql.weights('cw', 'cg')},
{sql.grams('qg', 'queries')}, {sql.weights('qw', 'qg')}, {sql.cosine('pairs', 'qw', 'cw')},
served AS (SELECT * FROM cases WHERE customer_text <> '' AND support_text <> ''
  QUALIFY row_number() OVER (PARTITION BY customer_text ORDER BY support_tweet_id) = 1),
scored AS (
  SELECT q.id AS query_id, q.text AS query, q.intent, c.support_tweet_id AS case_id, c.customer_text AS customer_case,
         c.support_text AS support_response, coalesce(p.similarity, 0.0) AS similarity, {_COMPAT} AS compat
  FROM queries q CROSS JOIN served c LEFT JOIN pairs p ON p.query_id = q.id AND p.case_id = c.support_tweet_id),
ranked AS (
  SELECT * FROM (
    SELECT *, 0.75 * similarity + 0.25 * compat AS combined,
           row_number() OVER (PARTITION BY query_id
             ORDER BY round(0.75 * similarity + 0.25 * compat, 9) DESC, case_id) AS rank
    FROM scored) WHERE rank <= {k})"""


def _cases(spark, folder):
    return cut_lineage(case_ops.unique_cases(case_ops.cases_from_turns(support_threads(spark, folder))))


def _case_model(cases):
    return tfidf.fit(tfidf.document_text(cases, "support_tweet_id", "customer_text"))


def _queries(spark, folder):
    return _customer_texts(spark, folder).select(
        F.col("id").alias("query_id"), tx.normalize(F.col("text")).alias("query")
    )


def _classified(spark, folder):
    intent = F.coalesce(decisions.rule_intent(F.col("query"), RULES), F.lit("OTHER"))
    return _queries(spark, folder).withColumn("intent", intent)


def _retrieved(spark, folder, k):
    """(ranked cases of all customer turns, the case table)"""
    cases = _cases(spark, folder)
    return retrieval.retrieve(_classified(spark, folder), cases, _case_model(cases), k, KEYWORDS), cases


_SCORES = ("similarity", "intent_compatibility", "combined_score")
_SCORE_SQL = """round(similarity, 6) AS similarity, round(compat, 6) AS intent_compatibility,
round(combined, 6) AS combined_score"""


@register("e3_retrieve", f"""{_retrieval_sql(3)}
SELECT query_id, rank, case_id, {_SCORE_SQL} FROM ranked""")
def retrieve(spark, folder):
    ranked, _ = _retrieved(spark, folder, 3)
    return _rounded(ranked.withColumn("rank", F.col("rank").cast("bigint")), *_SCORES)


@register("e3_indexed_retrieve", SQL["e3_retrieve"])
def _(spark, folder):
    """The same cases from a case index that is kept and opened again."""
    cases, path = _cases(spark, folder), scratch_path(spark, "case-index")
    model = _case_model(cases)
    retrieval.index_cases(cases, model, path, KEYWORDS)
    ranked = retrieval.retrieve(_classified(spark, folder), cases, model, 3, KEYWORDS, index=postings.load(spark, path))
    return _rounded(ranked.withColumn("rank", F.col("rank").cast("bigint")), *_SCORES)


@register("j13_cited_cases", f"""{_retrieval_sql(3)}
SELECT case_id, count(*) AS queries, any_value(customer_case) AS customer_case,
       any_value(support_response) AS support_response FROM ranked GROUP BY case_id""")
def _(spark, folder):
    return retrieval.cited_cases(*_retrieved(spark, folder, 3))


@register("w7_best_case", f"""{_retrieval_sql(3)}
SELECT query_id, case_id, {_SCORE_SQL} FROM ranked WHERE rank = 1""")
def _(spark, folder):
    best = retrieval.best_case(_retrieved(spark, folder, 3)[0])
    return _rounded(best, *_SCORES).select("query_id", "case_id", *_SCORES)


@register("w8_ordered_cases", f"""{_retrieval_sql(3)}
SELECT query_id, string_agg(CAST(case_id AS VARCHAR), '|' ORDER BY rank) AS case_ids FROM ranked GROUP BY query_id""")
def _(spark, folder):
    listed = retrieval.cases_per_query(_retrieved(spark, folder, 3)[0])
    ids = F.transform("cases", lambda c: c["case_id"].cast("string"))
    return listed.select("query_id", F.array_join(ids, "|").alias("case_ids"))


@register("o3_first_queries", f"""{_retrieval_sql(3)}
SELECT query_id, rank, case_id, left(customer_case, 600) AS customer_case FROM ranked
WHERE query_id IN (SELECT DISTINCT query_id FROM ranked ORDER BY query_id LIMIT 5)""")
def _(spark, folder):
    ranked, cases = _retrieved(spark, folder, 3)
    first = retrieval.with_case_texts(retrieval.queries_of_first_ids(cut_lineage(ranked), 5), cases)
    return first.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "case_id",
        tx.shorten(F.col("customer_case")).alias("customer_case"),
    )


# --- decisions and replies --------------------------------------------------------------------------------------


def _q(text):
    return sql.quoted(text)


def _route_sql(similarity, compat, combined):
    s, b = _q(lexicon.SECURITY_INTENT), _q(lexicon.BILLING_INTENT)
    weak = f"{similarity} < 0.2"
    odd = f"{similarity} >= 0.35 AND {compat} < 0.1"
    action = f"""CASE WHEN intent IN ({s}, {b}) THEN 'ESCALATE' WHEN {weak} OR ({odd}) OR {combined} < 0.3 THEN 'CLARIFY'
      ELSE 'ANSWER' END"""
    reason = f"""CASE WHEN intent = {s} THEN {_q(lexicon.REASON_SECURITY)} WHEN intent = {b} THEN {_q(lexicon.REASON_BILLING)}
      WHEN {weak} THEN {_q(lexicon.REASON_NO_CASE)} WHEN {odd} THEN {_q(lexicon.REASON_INCOMPATIBLE)}
      WHEN {combined} < 0.3 THEN {_q(lexicon.REASON_MODERATE)} ELSE {_q(lexicon.REASON_RELEVANT)} END"""
    return action, reason


_ACTION, _REASON = _route_sql("similarity", "compat", "combined")
_CLEANED = sql.clean_reply("support_response")
_GROUNDED = f"""CASE WHEN similarity < 0.2 THEN {_q(lexicon.REPLY_WEAK)} WHEN {_CLEANED} = '' THEN {_q(lexicon.REPLY_NO_TEXT)}
  WHEN similarity < 0.35 THEN {_q(lexicon.REPLY_MODERATE)} ELSE {_CLEANED} END"""
_IS_GROUNDED = f"(similarity >= 0.2 AND {_CLEANED} <> '')"


@register("e4_decide", f"""{_retrieval_sql(1)}
SELECT query_id, {_ACTION} AS action, {_REASON} AS reason FROM ranked""")
def _(spark, folder):
    intents = _classified(spark, folder).select("query_id", "intent")
    found = _retrieved(spark, folder, 1)[0].join(intents, "query_id")
    decision = decisions.route(
        F.col("intent"), F.col("similarity"), F.col("intent_compatibility"), F.col("combined_score")
    )
    return found.select("query_id", decision.alias("d")).select("query_id", "d.action", "d.reason")


@register("e5_gate", f"""{_retrieval_sql(1)},
labelled AS (SELECT r.*, CASE WHEN r.query_id % 5 = 0 THEN 'YES' WHEN r.query_id % 3 = 0 THEN 'NO' END AS label,
  (r.query_id // {TURN_SPACE}) % 10 / 50.0 AS confidence FROM ranked r)
SELECT query_id, CASE WHEN label = 'YES' OR intent IN ('ACCOUNT_SECURITY', 'BILLING_PAYMENT') THEN 'ESCALATE'
  WHEN confidence < 0.12 AND similarity < 0.2 THEN 'CLARIFY' WHEN similarity >= 0.35 THEN 'ANSWER'
  WHEN similarity >= 0.2 THEN 'CLARIFY' ELSE 'ESCALATE' END AS action,
  CASE WHEN label = 'YES' THEN {_q(lexicon.REASON_LABELLED)}
  WHEN intent = 'ACCOUNT_SECURITY' THEN {_q(lexicon.REASON_SECURITY)}
  WHEN intent = 'BILLING_PAYMENT' THEN {_q(lexicon.REASON_BILLING)}
  WHEN confidence < 0.12 AND similarity < 0.2 THEN {_q(lexicon.REASON_ALL_LOW)}
  WHEN similarity >= 0.35 THEN {_q(lexicon.REASON_SIMILAR)} WHEN similarity >= 0.2 THEN {_q(lexicon.REASON_GATE_MODERATE)}
  ELSE {_q(lexicon.REASON_NO_CASE)} END AS reason FROM labelled""")
def _(spark, folder):
    intents = _classified(spark, folder).select("query_id", "intent")
    found = _retrieved(spark, folder, 1)[0].join(intents, "query_id")
    label = F.when(F.col("query_id") % 5 == 0, "YES").when(F.col("query_id") % 3 == 0, "NO")
    confidence = F.floor(F.col("query_id") / TURN_SPACE) % 10 / F.lit(50.0)
    gate = decisions.escalation_gate(F.col("intent"), confidence, F.col("similarity"), label)
    return found.select("query_id", gate.alias("d")).select("query_id", "d.action", "d.reason")


@register("e6_respond", f"""{_retrieval_sql(1)}
SELECT query_id, {_GROUNDED} AS response, {_IS_GROUNDED} AS grounded, NOT {_IS_GROUNDED} AS needs_escalation
FROM ranked""")
def _(spark, folder):
    reply = decisions.grounded_reply(F.col("similarity"), F.col("support_response"))
    found = retrieval.with_case_texts(*_retrieved(spark, folder, 1))
    return found.select("query_id", reply.alias("r")).select(
        "query_id", "r.response", "r.grounded", "r.needs_escalation"
    )


_TRIAGED = f"""{_retrieval_sql(3)},
routed AS (SELECT *, {_ACTION} AS action, {_REASON} AS decision_reason FROM ranked WHERE rank = 1),
triaged AS (
  SELECT r.query_id, r.query, r.intent, q.confidence, q.source, similarity, compat, combined, action, decision_reason,
    CASE action WHEN 'ANSWER' THEN {_GROUNDED} WHEN 'CLARIFY' THEN {_q(lexicon.REPLY_CLARIFY)}
      ELSE {_q(lexicon.REPLY_ESCALATE)} END AS response,
    action = 'ANSWER' AND {_IS_GROUNDED} AS grounded,
    action = 'ESCALATE' OR (action = 'ANSWER' AND NOT {_IS_GROUNDED}) AS needs_escalation
  FROM routed r JOIN queries q ON q.id = r.query_id),
case_lists AS (SELECT query_id, string_agg(CAST(case_id AS VARCHAR), '|' ORDER BY rank) AS historical_cases
  FROM ranked GROUP BY query_id)"""
_TRIAGE_SELECT = """
SELECT query_id, query, intent, confidence AS classifier_confidence, source AS classifier_source,
  round(similarity, 6) AS retrieval_similarity, round(compat, 6) AS intent_compatibility,
  round(combined, 6) AS combined_score, action, decision_reason, response, grounded, needs_escalation, historical_cases
FROM triaged JOIN case_lists USING (query_id)"""


def _flat_triage(results):
    served = triage_plan.service_response(results)
    ids = F.transform("historical_cases", lambda c: c["case_id"].cast("string"))
    return _rounded(
        served.withColumn("historical_cases", F.array_join(ids, "|")),
        "retrieval_similarity", "intent_compatibility", "combined_score",
    )


@register("e8_triage", _TRIAGED + _TRIAGE_SELECT)
def triage(spark, folder):
    cases = _cases(spark, folder)
    return _flat_triage(triage_plan.triage(
        _queries(spark, folder), cases, _case_model(cases), rules=RULES, keywords=KEYWORDS, case_texts=False
    ))


# --- batch evaluation -------------------------------------------------------------------------------------------

# Gold labels of every customer turn, by a rule of its id.
_GOLD = {"intent": ("PLAYBACK", "ACCOUNT_LOGIN", "APP_TECHNICAL", "OTHER", "ACCOUNT_SECURITY", "BILLING_PAYMENT")}
_GOLD_INDEX = f"(conv_id + turn) % {len(_GOLD['intent'])}"
_GOLD_SQL = "CASE " + _GOLD_INDEX + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_GOLD["intent"])) + " END"


def _golden_set(spark, folder):
    turns = table(spark, folder, "conversations", text_work=True).where("role = 'user'")
    return turns.select(
        _turn_ids().alias("annotation_id"),
        tx.normalize(F.col("text")).alias("clean_text"),
        F.expr(_GOLD_SQL).alias("intent"),
        F.when(F.col("turn") > 2, "RESOLVED").otherwise("UNCLEAR").alias("resolution_status"),
        F.when(F.col("turn") > 4, "YES").otherwise("NO").alias("requires_escalation"),
    )


_GOLD_TABLE = f"""gold AS (
  SELECT conv_id * {TURN_SPACE} + turn AS query_id, {_GOLD_SQL} AS gold_intent,
    CASE WHEN turn > 2 THEN 'RESOLVED' ELSE 'UNCLEAR' END AS gold_resolution,
    CASE WHEN turn > 4 THEN 'YES' ELSE 'NO' END AS gold_escalation
  FROM conversations WHERE role = 'user')"""
_EVALUATED = f"""{_TRIAGED}, {_GOLD_TABLE},
evaluated AS (
  SELECT g.query_id AS example_id, query, gold_intent, intent AS predicted_intent, confidence AS classifier_confidence,
    round(similarity, 6) AS retrieval_similarity, gold_resolution, gold_escalation, action AS agent_action,
    decision_reason, response, grounded, needs_escalation
  FROM triaged t JOIN gold g USING (query_id))"""


def _evaluated(spark, folder):
    cases = _cases(spark, folder)
    result = evaluation.evaluate_agent(
        _golden_set(spark, folder), cases, _case_model(cases), rules=RULES, keywords=KEYWORDS
    )
    return _rounded(result, "retrieval_similarity")


@register("e10_agent_eval", _EVALUATED + " SELECT * FROM evaluated")
def _(spark, folder):
    return _evaluated(spark, folder)


@register("e10_agent_counts", _EVALUATED + """
SELECT 'agent_action' AS measure, agent_action AS value, count(*) AS n FROM evaluated GROUP BY agent_action
UNION ALL SELECT 'grounded', CAST(grounded AS VARCHAR), count(*) FROM evaluated GROUP BY grounded
UNION ALL SELECT 'predicted_intent', predicted_intent, count(*) FROM evaluated GROUP BY predicted_intent""")
def _(spark, folder):
    return evaluation.evaluation_counts(cut_lineage(_evaluated(spark, folder)))


def _gold_retrieval_sql(k):
    """Retrieval of the golden rows with their gold intent."""
    return _retrieval_sql(k).replace(
        "queries AS (SELECT id,", f"{_GOLD_TABLE},\nqueries AS (SELECT id,"
    ).replace(
        "FROM texts),\n", "FROM texts JOIN gold ON gold.query_id = id),\n"
    ).replace(
        f"coalesce({sql.rule_case(sql.normalize('text'), RULES)}, 'OTHER') AS intent", "gold_intent AS intent"
    )


_RETRIEVAL_EVAL = """query_id, query, intent AS gold_intent, rank, case_id AS historical_support_tweet_id,
customer_case AS historical_customer, support_response AS historical_support"""


def _retrieval_records(spark, folder, k):
    cases = _cases(spark, folder)
    return evaluation.evaluate_retrieval(
        _golden_set(spark, folder), cases, _case_model(cases), k, keywords=KEYWORDS
    )


@register("e11_retrieval_eval", f"{_gold_retrieval_sql(3)} SELECT {_RETRIEVAL_EVAL}, {_SCORE_SQL} FROM ranked")
def _(spark, folder):
    records = _retrieval_records(spark, folder, 3)
    return _rounded(records.withColumn("rank", F.col("rank").cast("bigint")), *_SCORES)


@register("e13_annotation_table", f"""{_gold_retrieval_sql(5)}
SELECT row_number() OVER (ORDER BY query_id, rank) AS judgment_id, query_id AS golden_id, intent AS golden_intent,
  query AS golden_query, rank, round(similarity, 6) AS similarity, customer_case AS historical_customer,
  support_response AS historical_support, '' AS relevance, '' AS annotation_notes FROM ranked""")
def _(spark, folder):
    annotation = evaluation.relevance_annotation(_retrieval_records(spark, folder, 5))
    return _rounded(annotation.withColumn("rank", F.col("rank").cast("bigint")), "similarity")


@register("a15_annotation_summary", f"""{_gold_retrieval_sql(5)},
sizes AS (SELECT query_id, count(*) AS n FROM ranked GROUP BY query_id)
SELECT count(*) AS queries, CAST(sum(n) AS BIGINT) AS records, min(n) AS least_cases, max(n) AS most_cases FROM sizes""")
def _(spark, folder):
    return evaluation.annotation_summary(
        _retrieval_records(spark, folder, 5).withColumnRenamed("query_id", "golden_id")
    )


_RUBRIC = (
    "Answer with one JSON object: a whole number from 1 (worst) to 5 (best) for each of "
    + ", ".join(judging.DIMENSIONS) + ', and your grounds in one sentence as "reason".'
)


def _section_sql():
    return """chr(10) || '--- Historical Case ' || rank || ' ---' || chr(10) || chr(10) || 'Historical Customer:' || chr(10)
    || customer_case || chr(10) || chr(10) || 'Historical Support Response:' || chr(10) || coalesce(support_response, '')
    || chr(10) || chr(10) || 'Retrieval similarity:' || chr(10) || printf('%.3f', round(similarity, 9))
    || chr(10) || chr(10) || 'Intent compatibility:' || chr(10) || printf('%.3f', round(compat, 9))
    || chr(10) || chr(10) || 'Combined retrieval score:' || chr(10) || printf('%.3f', round(combined, 9)) || chr(10)"""


def _prompt_sql(query, response, evidence):
    mark = "\x00"
    template = f"""
You are evaluating a customer-support reply.

CUSTOMER MESSAGE:
{mark}q{mark}

REPLY:
{mark}r{mark}

AVAILABLE HISTORICAL EVIDENCE:
{mark}e{mark}

{_RUBRIC}

Use only the message, the reply and the evidence. Be strict.
"""
    values = {"q": query, "r": response, "e": evidence}
    parts = template.split(mark)
    return " || ".join(values[p] if i % 2 else _q(p) for i, p in enumerate(parts))


@register("e12_judge_prompts", f"""{_gold_retrieval_sql(3)},
evidence AS (SELECT query_id, any_value(query) AS query, string_agg({_section_sql()}, chr(10) ORDER BY rank) AS e
  FROM ranked GROUP BY query_id)
SELECT query_id AS example_id, query, {_q(lexicon.REPLY_CLARIFY)} AS response,
  {_prompt_sql('query', _q(lexicon.REPLY_CLARIFY), 'e')} AS prompt FROM evidence""")
def _(spark, folder):
    records = cut_lineage(_retrieval_records(spark, folder, 3))
    agent = evaluation.golden_queries(_golden_set(spark, folder)).select(
        F.col("query_id").alias("example_id"), "query", F.lit(lexicon.REPLY_CLARIFY).alias("response")
    )
    return evaluation.judge_prompts(agent, records, _RUBRIC, n=None)


def _stub_scorer(prompt):
    """A stand-in for the external judge: scores follow from the length of the prompt, some calls fail."""
    n = len(prompt)
    if n % 11 == 0:
        raise RuntimeError("judge is not available")
    if n % 7 == 0:
        return "no verdict"
    return (
        f'```json\n{{"groundedness": {n % 5 + 1}, "relevance": {n % 4 + 1}, "actionability": {n % 3 + 1}, '
        f'"tone": {n % 2 + 1}, "overall": {n % 5 + 1}, "reason": "length {n}"}}\n```'
    )


def _stub_score(modulus):
    return f"CAST(CASE WHEN n % 11 <> 0 AND n % 7 <> 0 THEN n % {modulus} + 1 END AS INTEGER)"


@register("e12_judge_scores", SQL["e12_judge_prompts"].replace("WITH", "WITH prompts AS (WITH", 1) + f"""),
sized AS (SELECT *, length(prompt) AS n FROM prompts)
SELECT example_id, query, response, {_stub_score(5)} AS groundedness, {_stub_score(4)} AS relevance,
  {_stub_score(3)} AS actionability, {_stub_score(2)} AS tone, {_stub_score(5)} AS overall,
  CASE WHEN n % 11 = 0 THEN 'Judge error: judge is not available'
    WHEN n % 7 = 0 THEN 'Judge error: No JSON object found: no verdict' ELSE 'length ' || n END AS reason
FROM sized""")
def _(spark, folder):
    records = cut_lineage(_retrieval_records(spark, folder, 3))
    agent = evaluation.golden_queries(_golden_set(spark, folder)).select(
        F.col("query_id").alias("example_id"), "query", F.lit(lexicon.REPLY_CLARIFY).alias("response")
    )
    return evaluation.judge(agent, records, _stub_scorer, _RUBRIC, n=None)


@register("a23_judge_summary", """WITH j AS (
  SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id % 5 + 1 END AS a, CASE WHEN doc_id % 7 <> 0 THEN doc_id % 4 + 1 END AS b
  FROM documents)
SELECT count(*) AS judgments, count(a) AS valid_judgments, round(avg(a), 6) AS mean_overall,
  round(avg(b), 6) AS mean_tone FROM j""")
def _(spark, folder):
    raw = F.when(F.col("doc_id") % 7 == 0, "none").otherwise(F.format_string(
        '{"overall": %d, "tone": %d}', F.col("doc_id") % 5 + 1, F.col("doc_id") % 4 + 1
    ))
    judged = judging.parse_judgments(table(spark, folder, "documents").select(raw.alias("raw")), "raw")
    return _rounded(metrics.score_means(judged, ["overall", "tone"]), "mean_overall", "mean_tone")


# --- models -----------------------------------------------------------------------------------------------------


def _labelled_documents(spark, folder):
    docs = table(spark, folder, "documents", text_work=True).select("doc_id", "text")
    label = F.concat(F.lit("q"), "quality", F.lit("t"), "toxic")
    return docs.join(table(spark, folder, "labels"), "doc_id").select(
        F.col("doc_id").alias("id"), "text", label.alias("intent")
    )


@register("m10_predict")
def _(spark, folder):
    """Fit on the labelled documents and classify all documents: rules first, the model for the rest."""
    model = classify.fit(_labelled_documents(spark, folder))
    docs = tfidf.document_text(table(spark, folder, "documents", text_work=True), "doc_id", "text")
    return _rounded(classify.classify(docs, model), "confidence")


@register("m15_cross_validate")
def _(spark, folder):
    return classify.cross_validate(_labelled_documents(spark, folder))


def _discovery(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sample = sampling.sample_rows(unique_texts(drop_blank(docs, "text"), "text", "doc_id"), "doc_id", 500)
    params = tfidf.TfidfParams(**tfidf.DISCOVERY, stop_words=STOP_WORDS)
    texts = cut_lineage(tfidf.document_text(sample, "doc_id", "text"))
    model, vectors = tfidf.fit_transform(texts, params)
    return texts, model, cut_lineage(vectors)


@register("m6_cluster_quality")
def _(spark, folder):
    _, model, vectors = _discovery(spark, folder)
    return clusters.discover(vectors, model.size).scores


@register("m8_cluster_terms")
def _(spark, folder):
    _, model, vectors = _discovery(spark, folder)
    found = clusters.discover(vectors, model.size)
    return clusters.cluster_terms(vectors, model, found.assigned)


@register("m9_representatives")
def _(spark, folder):
    texts, model, vectors = _discovery(spark, folder)
    found = clusters.discover(vectors, model.size)
    return clusters.representatives(texts.join(found.assigned, "id"), "id").select("cluster", "id", "text")


# The parts that follow an assignment, with the documents' sources as clusters.
_BY_SOURCE = f"""WITH all_texts AS (SELECT doc_id AS id, text, source AS cluster FROM documents WHERE source IS NOT NULL),
{sql.grams('g', 'all_texts', STOP_WORDS)}, {sql.vocabulary('g', 'all_texts', 3, 0.9, 5000)}, {sql.weights('w', 'g')}"""


def _by_source(spark, folder):
    docs = table(spark, folder, "documents", text_work=True).where("source IS NOT NULL")
    params = tfidf.TfidfParams(**tfidf.DISCOVERY, stop_words=STOP_WORDS)
    model, vectors = tfidf.fit_transform(tfidf.document_text(docs, "doc_id", "text"), params)
    return model, cut_lineage(vectors), docs.select(F.col("doc_id").alias("id"), F.col("source").alias("cluster"))


@register("m8_source_terms", f"""{_BY_SOURCE},
sizes AS (SELECT cluster, count(*) AS size FROM all_texts GROUP BY cluster),
means AS (SELECT cluster, term, sum(w) / any_value(size) AS weight FROM w JOIN all_texts USING (id) JOIN sizes USING (cluster)
  GROUP BY cluster, term)
SELECT cluster, size, rank, term, round(weight, 6) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(weight, 9) DESC, term) AS rank FROM means)
JOIN sizes USING (cluster) WHERE rank <= 10""")
def _(spark, folder):
    model, vectors, assigned = _by_source(spark, folder)
    terms = clusters.cluster_terms(vectors, model, assigned)
    return _rounded(terms.withColumn("rank", F.col("rank").cast("bigint")), "weight")


@register("m9_source_representatives", f"""SELECT source AS cluster, doc_id, text FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY {sql.seeded(42, 'doc_id')}, doc_id) <= 10""")
def _(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("source").alias("cluster"), "doc_id", "text")
    return clusters.representatives(docs, "doc_id")


@register("m7_source_silhouette", f"""{_BY_SOURCE},
picked AS (SELECT id, cluster FROM all_texts ORDER BY {sql.seeded(42, 'id')}, id LIMIT {clusters.SILHOUETTE_ROWS}),
dots AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS dot FROM w a JOIN w b USING (term)
  WHERE a.id IN (SELECT id FROM picked) AND b.id IN (SELECT id FROM picked) GROUP BY a.id, b.id),
norms AS (SELECT id, sum(w * w) AS n FROM w GROUP BY id),
apart AS (SELECT x.id AS a, x.cluster AS own, y.cluster AS other, y.id AS b,
  sqrt(greatest(coalesce(nx.n, 0) + coalesce(ny.n, 0) - 2 * coalesce(dot, 0), 0)) AS d
  FROM picked x JOIN picked y ON x.id <> y.id LEFT JOIN dots ON dots.a = x.id AND dots.b = y.id
  LEFT JOIN norms nx ON nx.id = x.id LEFT JOIN norms ny ON ny.id = y.id),
means AS (SELECT a, own, other, avg(d) AS d FROM apart GROUP BY a, own, other),
sides AS (SELECT a, max(d) FILTER (own = other) AS inner_d, min(d) FILTER (own <> other) AS outer_d FROM means GROUP BY a)
SELECT CAST(1 AS INTEGER) AS k, round(avg(CASE WHEN inner_d IS NULL THEN 0
  ELSE (outer_d - inner_d) / greatest(inner_d, outer_d) END), 6) AS silhouette_score FROM sides""")
def _(spark, folder):
    _, vectors, assigned = _by_source(spark, folder)
    picked = sampling.sample_rows(assigned, "id", clusters.SILHOUETTE_ROWS)
    number = F.dense_rank().over(Window.orderBy("cluster"))  # of at most SILHOUETTE_ROWS rows
    rows = picked.withColumn("number", number).join(vectors, "id")
    return _rounded(clusters.silhouette(rows.select(
        F.lit(1).alias("k"), "id", "indices", "weights", F.col("number").alias("cluster"))), "silhouette_score")


# --- streams ----------------------------------------------------------------------------------------------------


def _stream(spark, folder, name):
    """The files of one table as a file stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


@register("t1_stream_triage", _TRIAGED + _TRIAGE_SELECT)
def _(spark, folder):
    cases = _cases(spark, folder)
    model = _case_model(cases)
    # Indexed once; each of the batches reads the index's folders of its own terms.
    index = retrieval.index_cases(cases, model, scratch_path(spark, "case-index"), KEYWORDS)
    turns, source = spark.read.parquet(f"{folder}/conversations.parquet"), scratch_path(spark, "conversations")
    turns.repartition(2, "conv_id").write.parquet(source)
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(source).where("role = 'user'")
    arriving = stream.select(_turn_ids().alias("query_id"), tx.normalize(F.col("text")).alias("query"))

    def triage_batch(batch):
        return _flat_triage(triage_plan.triage(
            batch, cases, model, rules=RULES, keywords=KEYWORDS, case_texts=False, index=index))

    target = scratch_path(spark, "triage")
    jobs.start_triage(arriving, triage_batch, target, scratch_path(spark, "triage-log"), True).awaitTermination()
    return spark.read.parquet(target).drop("batch")


@register("t2_stream_audit", """SELECT user_id, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors,
round(sum(value), 4) AS total_value, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_rate
FROM (SELECT DISTINCT ON (event_id) * FROM events) WHERE user_id IS NOT NULL GROUP BY user_id""")
def _(spark, folder):
    # Several batches, in no order of time, each with copies of events that another batch holds.
    events = spark.read.parquet(f"{folder}/events.parquet")
    source, target = scratch_path(spark, "events"), scratch_path(spark, "audit")
    again = events.where(F.pmod(F.xxhash64("event_id"), F.lit(7)) == 0)
    events.unionByName(again).repartition(4, F.hash("event_id", F.rand(1))).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.start_audit(stream, target, scratch_path(spark, "audit-log"), event_id="event_id", available_now=True).awaitTermination()
    current = jobs.author_activity(spark, target)
    return current.withColumns({"total_value": F.round("total_value", 4), "error_rate": F.round("error_rate", 6)})
