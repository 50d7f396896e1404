"""SQL fragments for the DuckDB twins of the registered queries."""

from __future__ import annotations

SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
TURN_SPACE = 1_000_000_000


def squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{SPACE}]+', ' ', 'g'))"


def normalize(text: str) -> str:
    return squeeze(f"lower(coalesce({text}, ''))")


def blank(text: str) -> str:
    return f"(NOT regexp_matches(coalesce({text}, ''), '[^{SPACE}]'))"


def unescape(text: str) -> str:
    """The entities that occur in the supplied pages; the ampersand, with or without semicolon, goes last."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·")):
        text = f"replace({text}, '{entity}', '{char}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


def clean(text: str, entities: bool = True) -> str:
    text = f"coalesce({text}, '')"
    if entities:
        text = unescape(text)
    text = rf"regexp_replace({text}, 'https?://[^{SPACE}]+|www\.[^{SPACE}]+', ' <URL> ', 'g')"
    return squeeze(f"regexp_replace({text}, '@[{WORD}]+', ' <USER> ', 'g')")


def clean_reply(text: str) -> str:
    text = f"regexp_replace(coalesce({text}, ''), 'https?://[^{SPACE}]+', '', 'g')"
    return squeeze(rf"regexp_replace({text}, '@\p{{Nd}}+', '', 'g')")


def word_count(text: str) -> str:
    return f"len(regexp_extract_all(coalesce({text}, ''), '[^{SPACE}]+'))"


def words(text: str) -> str:
    return f"regexp_extract_all(lower(coalesce({text}, '')), '[{WORD}]{{2,}}')"


def contains_any(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({text}, '')), '{p}')" for p in phrases) + ")"


def seeded(seed: int, key: str) -> str:
    return f"md5('{seed}|' || {key})"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


MESSAGES = f"""
turns AS (
  SELECT conv_id * {TURN_SPACE} + turn AS tweet_id, * FROM conversations
),
messages AS (
  SELECT t.tweet_id,
         CASE WHEN t.role = 'user' THEN 'u' || t.conv_id ELSE 'brand' || (t.conv_id % 6) END AS author_id,
         CASE WHEN t.role = 'user' THEN true WHEN t.role = 'assistant' THEN false END AS inbound,
         strftime(TIMESTAMP '2017-11-01' + to_minutes(CAST(t.conv_id % 1000000 * 60 + t.turn % 60 AS INTEGER)),
                  '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
         t.text,
         CAST(n.tweet_id AS VARCHAR) AS response_tweet_id,
         CASE WHEN t.turn > 0 THEN t.tweet_id - 1 END AS in_response_to_tweet_id
  FROM turns t LEFT JOIN turns n ON n.tweet_id = t.tweet_id + 1 AND n.turn > 0
)"""

THREAD_TURNS = f"""
last_turn AS (
  SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id
),
thread_turns AS (
  SELECT 'brand' || (c.conv_id % 6) AS brand, c.conv_id * {TURN_SPACE} + l.last AS support_tweet_id,
         l.last + 1 AS num_messages, c.turn + 1 AS position, c.conv_id * {TURN_SPACE} + c.turn AS tweet_id,
         CASE role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'support' END AS speaker, text
  FROM conversations c JOIN last_turn l ON c.conv_id = l.conv_id AND c.turn <= l.last
)"""

RAW_CASES = f"""{THREAD_TURNS},
spoken AS (
  SELECT support_tweet_id, position, tweet_id, speaker, {normalize('text')} AS t FROM thread_turns
),
raw_cases AS (
  SELECT support_tweet_id, list(tweet_id ORDER BY position) AS tweet_ids,
         coalesce(string_agg(t, ' ' ORDER BY position) FILTER (speaker = 'customer'), '') AS customer_text,
         coalesce(string_agg(t, ' ' ORDER BY position) FILTER (speaker = 'support'), '') AS support_text
  FROM spoken WHERE t <> '' GROUP BY support_tweet_id
),
all_cases AS (
  SELECT *, {normalize("customer_text || ' ' || support_text")} AS case_text FROM raw_cases WHERE customer_text <> ''
)"""

UNIQUE_CASES = f"""{RAW_CASES},
cases AS (
  SELECT * FROM all_cases QUALIFY row_number() OVER (PARTITION BY case_text ORDER BY support_tweet_id) = 1
)"""


def grams(name: str, source: str, stop_words=()) -> str:
    """CTE ``name``(id, term, tf) of the 1- and 2-grams of ``source``(id, text)."""
    listed = ", ".join(f"'{w}'" for w in stop_words)
    kept = f"list_filter({words('text')}, lambda x: x NOT IN ({listed}))" if stop_words else words("text")
    return f"""
{name}_words AS (SELECT id, {kept} AS w FROM {source}),
{name} AS (
  SELECT id, term, count(*) AS tf FROM (
    SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
    FROM {name}_words
  ) GROUP BY id, term
)"""


def vocabulary(counts: str, source: str, min_df: int = 2, max_df: float = 0.95, limit: int | None = 50_000) -> str:
    """CTE ``vocabulary``(term, df, total, idf)."""
    cut = f"ORDER BY total DESC, term LIMIT {limit}" if limit else ""
    return f"""
corpus_size AS (SELECT count(*) AS n FROM {source}),
vocabulary AS (
  SELECT term, df, total, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM {counts} GROUP BY term
  ), corpus_size
  WHERE df >= {min_df} AND df <= {max_df} * n {cut}
)"""


def weights(name: str, counts: str) -> str:
    """CTE ``name``(id, term, w) with unit length per id."""
    return f"""
{name}_raw AS (SELECT c.id, c.term, (1.0 + ln(c.tf)) * v.idf AS w FROM {counts} c JOIN vocabulary v USING (term)),
{name} AS (
  SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {name}_raw
)"""


def cosine(name: str, query_weights: str, case_weights: str) -> str:
    """CTE ``name``(query_id, case_id, similarity) of the pairs that share a term."""
    return f"""
{name} AS (
  SELECT q.id AS query_id, c.id AS case_id, sum(q.w * c.w) AS similarity
  FROM {query_weights} q JOIN {case_weights} c USING (term) GROUP BY q.id, c.id
)"""


def rule_case(text: str, rules) -> str:
    """The first enabled rule as CASE; \\b is spelled out because it is ASCII-only here."""
    arms = []
    for intent, enabled, patterns in rules:
        if enabled:
            inner = "|".join(p.removeprefix(r"\b").removesuffix(r"\b") for p in patterns).replace("'", "''")
            edge = r"[^\p{L}\p{N}_]"
            arms.append(f"WHEN regexp_matches(lower(coalesce({text}, '')), '(^|{edge})({inner})($|{edge})') THEN '{intent}'")
    return "CASE " + " ".join(arms) + " END"


def compatibility_case(intent: str, text: str, keywords) -> str:
    arms = []
    for name, terms in keywords.items():
        if terms:
            hits = " + ".join(f"CAST(contains(lower({text}), {quoted(t)}) AS INTEGER)" for t in terms)
            arms.append(f"WHEN {intent} = '{name}' THEN ({hits}) / {len(terms)}.0")
    return "CASE " + " ".join(arms) + " ELSE 0.0 END"
