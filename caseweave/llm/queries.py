"""The registered queries of the operators of this package, and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from caseweave.llm import (
    byte_bpe, chunks, frames, hamming, licences, line_quality, mixing, negatives, runs, signature_trees, simhash, toxicity, warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


LANGUAGE_WEIGHTS = {"en": 0.55, "de": 0.15, "es": 0.15, "fr": 0.15}


def language_rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float], **limits) -> DataFrame:
    """Rates that bring the languages to ``weights``; languages are learned from the documents that ``labels`` lists."""
    labelled = docs.select("doc_id", "lang").join(labels.select("doc_id"), "doc_id", "left_semi")
    members = mixing.posteriors(docs, labelled.selectExpr("doc_id AS id", "lang AS domain"), list(weights))
    return mixing.fit_rates(members, weights, **limits)[0]


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Domain posteriors, rate and number of copies of all documents."""
    rated = language_rates(table(spark, folder, "documents"), table(spark, folder, "labels"), LANGUAGE_WEIGHTS)
    return rated.select(
        F.col("id").alias("doc_id"), "n_tokens",
        *[F.get("p", F.lit(i)).alias(f"p_{domain}") for i, domain in enumerate(LANGUAGE_WEIGHTS)],
        "rate", mixing.copies(F.col("id"), F.col("rate")).alias("n_copies"),
    )


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    """The licences recognised in all documents."""
    return licences.recognise(table(spark, folder, "documents"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


OP2 = rf"""
WITH known(code, normal) AS (VALUES {_values(licences.SENTENCES.items())}),
rule(n, licence, pattern) AS (VALUES {_values((f"{i:02d}", *r) for i, r in enumerate(licences.RULES))}),
s AS (SELECT doc_id, string_split_regex(
  regexp_replace(text, '{licences.GOES_ON}', ' ', 'g'), '{licences.SENTENCE_END}') AS s FROM documents),
e AS (SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM s),
k AS (SELECT doc_id, pos, code FROM (
  SELECT doc_id, pos, trim(regexp_replace(lower(sentence), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS normal FROM e) JOIN known USING (normal)),
g AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) > 3 THEN ' ' ELSE '' END || code AS marked FROM k),
q AS (SELECT doc_id, list(pos ORDER BY pos) AS ats, string_agg(marked, '' ORDER BY pos) AS sequence FROM g GROUP BY doc_id),
r AS (SELECT doc_id, ats, regexp_extract_all(sequence, '(?:{"|".join(p for _, p in licences.RULES)})|.') AS runs FROM q),
u AS (SELECT doc_id, ats, unnest(range(len(runs))) AS i, unnest(runs) AS run FROM r),
c AS (SELECT *, sum(CASE WHEN run = ' ' THEN 0 ELSE length(run) END) OVER (PARTITION BY doc_id ORDER BY i) - length(run) AS before FROM u),
m AS (SELECT doc_id, ats, i, run, before, min(n || licence) AS named FROM c JOIN rule ON regexp_full_match(run, pattern) GROUP BY ALL)
SELECT doc_id, named[3:] AS licence, count(*) AS n_matches, CAST(sum(length(run)) AS BIGINT) AS n_sentences,
  CAST(min(ats[CAST(before AS BIGINT) + 1]) AS BIGINT) AS first_sentence
FROM m GROUP BY doc_id, named[3:]
"""


def op3_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of all documents and the verdict of the quality rules."""
    return line_quality.assess(table(spark, folder, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_words_left",
    )


OP3 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^ 	-
]+') AS w FROM d),
p AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, w FROM w WHERE len(w) >= 5),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS g FROM p),
r AS (SELECT doc_id, unnest(range(p, p + 5)) AS p FROM (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
n AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM r GROUP BY doc_id),
l AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT *, trim(regexp_replace(lower(line), '[ 	-
]+', ' ', 'g'), ' ') AS normal FROM l),
c AS (SELECT host, normal, count(DISTINCT text) AS n FROM k WHERE normal <> '' GROUP BY ALL),
t AS (SELECT host, count(DISTINCT text) AS total FROM d GROUP BY host),
hot AS (SELECT host, normal FROM c JOIN t USING (host) WHERE n > 10 AND (n > total * CAST(0.1 AS DOUBLE) OR n > 20)),
gone AS (SELECT doc_id, sum(len(regexp_extract_all(line, '[^ 	-
]+'))) AS gone
  FROM k JOIN hot USING (host, normal) GROUP BY doc_id),
dup AS (SELECT doc_id, count(line) - count(DISTINCT line) AS n_dup_lines FROM l
  WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(w) - coalesce(gone, 0) AS BIGINT) AS n_words_left
  FROM d JOIN w USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT 100 * n_words_left < 20 * n_words AS kept FROM m
"""


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages, from the archives that they were written to."""
    manifest = warc.write(table(spark, folder, "pages"))
    return warc.read(manifest).where("record_type IN ('response', 'revisit')").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP4 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to FROM f
"""


def op5_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The passages that repeat across all documents: where they lie, who holds them first, what the others lose."""
    found = chunks.passages(table(spark, folder, "documents"))
    lost = F.aggregate("lost", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
    return found.select("doc_id", "start", "stop", "n_words", "first_doc_id", lost.alias("lost_bytes"))


def op6_hamming(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of all vectors for every twentieth."""
    return hamming.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents; a third of the ids is held out of training."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    learned = labels.where(~held_out & F.col("toxic").isNotNull()).selectExpr("doc_id AS id", "CAST(toxic AS INT) AS label")
    machine = toxicity.train(docs, learned.distinct())
    if machine is None:
        scored = docs.select("doc_id", F.lit(0.5).alias("score"))
    else:
        scored = toxicity.score(docs, machine)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


def op8_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, from the files they were written to."""
    manifest = frames.write(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return frames.read(manifest)


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of all documents and the bytes they decode to, as digests."""
    return byte_digests(table(spark, folder, "documents"))


def byte_digests(docs: DataFrame, keep_ids: bool = False, lasting: bool = True) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.with_ids(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, lasting=lasting)
    encoded = encoded.select("doc_id", "ids")
    return byte_bpe.with_bytes(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *(["ids"] if keep_ids else []),
    )


def op9_signature_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return signature_trees.join(table(spark, folder, "documents"), n=4, percent=85)


def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and the components of those within three bits of each other."""
    return simhash.join(table(spark, folder, "documents"))


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector and each of its positives, out of all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS vec
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.vec, v.vec) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of all documents."""
    return runs.find(table(spark, folder, "documents"))


QUERIES = {"op9_signature_trees": op9_signature_trees, "op6_hamming": op6_hamming, "op7_toxicity": op7_toxicity, "op5_chunks": op5_chunks, "op1_mixing": op1_mixing, "op2_licences": op2_licences, "op4_warc": op4_warc, "op3_line_quality": op3_line_quality, "op8_token_frames": op8_token_frames, "op10_byte_bpe": op10_byte_bpe,
           "op11_simhash": op11_simhash, "op12_negatives": op12_negatives, "op13_runs": op13_runs}
SQL: dict[str, str] = {"op2_licences": OP2, "op4_warc": OP4, "op3_line_quality": OP3, "op12_negatives": OP12}
