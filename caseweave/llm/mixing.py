"""Mixing to target weights with soft membership.

A multinomial word model, learned from labelled documents, gives each document a posterior over the domains. Projected
gradient descent then fits one nonnegative rate per document so that the expected tokens of each domain, the sum of
rate x tokens x posterior, meet the targets. With K domains a step needs K sums over all documents and nothing else:
a rate is the start rate after the K-vectors of the steps so far, so each job reads the posterior table once and folds
the (few) steps inside the row; after ``FOLDED`` steps the rates are stored and the next ones start from there. The driver
holds K numbers per step.

Rates have no upper bound unless ``most`` is given, so a domain of few tokens can reach its target. Steps are taken until
the targets are met, the sums stand still, or ``max_steps`` are done; targets that are missed are logged as a warning
and returned beside the sums that were reached.

The least squares are weighted by the inverse of the K x K matrix of the posteriors' second moments and the gradient
is taken per token. In that metric the largest curvature is 1, so the step length is 1 and no bound is needed.

Only column expressions, joins and aggregates are used. The word model has ``buckets`` rows whatever the corpus, so it
is broadcast. Word rows are summed per document before the shuffle, so neither a long text nor a frequent word makes a
large group.

Defined results: a null or empty text has no tokens, its posterior is the prior and its rate is fitted like any other;
rows that share an id (null included) are one document, with the tokens of all, and each gets its rate and copies;
an empty table gives an empty one; ties do not occur, posteriors are rounded to six decimals so that the order of a
floating-point sum decides nothing; only the id and text columns are read, further columns are carried by :func:`mix`.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame, functions as F

from caseweave.llm.line_quality import words
from caseweave.session import stored

BROADCAST_ROWS = 500_000
FOLDED = 30
# Sums that move by less than this part of the tolerance stand still.
STILL = 1e-3
LOG = logging.getLogger(__name__)


def sample_labelled(labelled: DataFrame, most: int) -> DataFrame:
    """At most ``most`` labelled ids, those of the smallest hashes: a bounded sample to fit the classifier on."""
    return labelled.where("id IS NOT NULL AND domain IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(most)


def buckets_of(text: Column, buckets: int) -> Column:
    """The hashed words of a text; the one entry -1 for a text without words."""
    found = F.transform(words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(-1)))


def word_model(texts: DataFrame, domains: list[str], buckets: int, smoothing: float) -> tuple[DataFrame, list[float]]:
    """``bucket``, ``l0`` .. log probabilities per domain, and the log priors. ``texts``: ``text``, ``domain``."""
    # A word counts at most once per text, so a long or repetitive text does not outweigh the others.
    words_seen = texts.select("domain", F.explode(F.array_distinct(buckets_of(F.col("text"), buckets))).alias("bucket"))
    counts = stored(
        words_seen.where("bucket >= 0").groupBy("bucket").agg(
            *[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{k}") for k, d in enumerate(domains)]
        ),
        "word-counts",
    )
    totals = counts.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in range(len(domains))]).first()
    sizes = texts.agg(*[F.count(F.when(F.col("domain") == d, 1)) for d in domains]).first()
    all_buckets = texts.sparkSession.range(-1, buckets).select(F.col("id").cast("int").alias("bucket"))
    model = all_buckets.join(counts, "bucket", "left").select(
        "bucket",
        *[
            F.when(F.col("bucket") < 0, F.lit(0.0))
            .otherwise(F.log((F.coalesce(F.col(f"n{k}"), F.lit(0)) + smoothing) / (totals[k] + smoothing * buckets)))
            .alias(f"l{k}")
            for k in range(len(domains))
        ],
    )
    return model, [math.log((n + 1) / (sum(sizes) + len(domains))) for n in sizes]


def posteriors(
    docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text",
    most_labelled: int = 20_000, buckets: int = 1 << 15, smoothing: float = 0.5, softness: float = 0.5,
) -> DataFrame:
    """``id``, ``n_tokens``, ``p`` (an array in the order of ``domains``). ``labelled``: columns ``id`` and ``domain``.

    A text's log likelihood is divided by ``n_tokens ** softness``: words of a text are not independent, and without
    it every posterior of a longer text would be 0 or 1.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = sample_labelled(labelled.where(F.col("domain").isin(domains)).select("id", "domain").distinct(), most_labelled)
    model, priors = word_model(texts.join(F.broadcast(chosen), "id").select("text", "domain"), domains, buckets, smoothing)
    tokens = texts.select("id", F.explode(buckets_of(F.col("text"), buckets)).alias("bucket"))
    k = range(len(domains))
    sums = tokens.join(F.broadcast(model), "bucket").groupBy("id").agg(
        F.count(F.when(F.col("bucket") >= 0, 1)).alias("n_tokens"), *[F.sum(f"l{i}").alias(f"l{i}") for i in k]
    )
    scale = F.pow(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"), F.lit(softness))
    scores = sums.select("id", "n_tokens", *[(F.lit(priors[i]) + F.col(f"l{i}") / scale).alias(f"s{i}") for i in k])
    top = F.greatest(*[F.col(f"s{i}") for i in k]) if len(domains) > 1 else F.col("s0")
    powers = [F.exp(F.col(f"s{i}") - top) for i in k]
    total = sum(powers[1:], powers[0])
    return stored(scores.select("id", "n_tokens", F.array(*[F.round(x / total, 6) for x in powers]).alias("p")), "posteriors")


def solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Solution of a small symmetric system, zero for a domain that no document belongs to."""
    n = len(right)
    rows = [[*matrix[i], right[i]] for i in range(n)]
    scale = max((matrix[i][i] for i in range(n)), default=0.0) or 1.0
    used = []
    for i in range(n):
        pivot = max((r for r in range(n) if r not in used), key=lambda r: abs(rows[r][i]))
        if abs(rows[pivot][i]) < 1e-9 * scale:
            continue
        used.append(pivot)
        for r in range(n):
            if r != pivot:
                factor = rows[r][i] / rows[pivot][i]
                rows[r] = [a - factor * b for a, b in zip(rows[r], rows[pivot], strict=True)]
    found = [0.0] * n
    for r in used:
        i = max(range(n), key=lambda c: abs(rows[r][c]))
        found[i] = rows[r][n] / rows[r][i]
    return found


def bounded(value: Column, least: float, most: float | None) -> Column:
    value = F.greatest(value, F.lit(float(least)))
    return value if most is None else F.least(value, F.lit(float(most)))


def rate(steps: list[list[float]], least: float, most: float | None, start: Column) -> Column:
    """The rate of a row that starts from ``start``, after ``steps``, each projected on [least, most]."""
    if not steps:
        return start
    literal = F.array(*[F.array(*[F.lit(x) for x in step]) for step in steps])

    def after(r: Column, step: Column) -> Column:
        move = sum((F.get(step, F.lit(i)) * F.get(F.col("p"), F.lit(i)) for i in range(1, len(steps[0]))),
                   F.get(step, F.lit(0)) * F.get(F.col("p"), F.lit(0)))
        return bounded(r - move, least, most)

    return F.aggregate(literal, start, after)


def fit_rates(
    members: DataFrame, weights: dict[str, float], budget: float | None = None, least: float = 0.0,
    most: float | None = None, max_steps: int = 30, tolerance: float = 1e-4,
) -> tuple[DataFrame, list[float], list[float]]:
    """``members`` with ``rate``; the expected tokens per domain, and the targets.

    ``budget`` is the number of tokens wanted; by default the smallest one at which no domain has to be cut.
    """
    domains, k = list(weights), range(len(weights))
    share = [w / sum(weights.values()) for w in weights.values()]
    token = [F.col("n_tokens") * F.get("p", F.lit(i)) for i in k]
    second = members.agg(*[
        F.coalesce(F.sum(token[i] * F.get("p", F.lit(j))), F.lit(0.0)) for i in k for j in k
    ], *[F.coalesce(F.sum(t), F.lit(0.0)) for t in token]).first()
    matrix = [[second[i * len(domains) + j] for j in k] for i in k]
    held = [second[len(domains) ** 2 + i] for i in k]
    wanted = budget if budget is not None else max((held[i] / share[i] for i in k if share[i] > 0), default=0.0)
    targets = [wanted * s for s in share]
    start, steps, done, before = bounded(F.lit(1.0), least, most), [], 0, None
    rated = members
    while True:
        now = rated.agg(*[F.coalesce(F.sum(rate(steps, least, most, start) * t), F.lit(0.0)) for t in token]).first()
        off = [now[i] - targets[i] for i in k]
        met = max(map(abs, off)) <= tolerance * max(wanted, 1.0)
        still = before is not None and max(abs(now[i] - before[i]) for i in k) < STILL * tolerance * max(wanted, 1.0)
        if met or still or done == max_steps:
            if not met:
                LOG.warning("targets missed after %d steps: %s", done, ", ".join(
                    f"{domain} {now[i]:.0f} of {targets[i]:.0f} tokens" for i, domain in enumerate(domains)
                ))
            found = F.round(rate(steps, least, most, start), 6)
            return rated.select(*members.columns, found.alias("rate")), list(now), targets
        if len(steps) == FOLDED:
            rated = stored(rated.select(*members.columns, rate(steps, least, most, start).alias("_rate")), "rates")
            start, steps = F.col("_rate"), []
        steps.append(solve(matrix, off))
        done, before = done + 1, now


def copies(id_col: Column, rate_col: Column) -> Column:
    """How often a document is taken: the whole part of its rate, and once more with the rest as probability, by its id."""
    chance = F.pmod(F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("")), F.lit("copies")), F.lit(1_000_000)) / 1_000_000
    return (F.floor(rate_col) + F.when(chance < rate_col - F.floor(rate_col), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, rated: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each row of ``docs`` as often as its document's rate says, with the columns of the input."""
    # Only documents that are not taken just once are looked up.
    other = stored(
        rated.select(F.col("id").alias("_id"), copies(F.col("id"), F.col("rate")).alias("_copies")).where("_copies <> 1"), "copies"
    )
    other = F.broadcast(other) if other.count() <= BROADCAST_ROWS else other
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_own"))
    times = F.coalesce("_copies", F.lit(1))
    return rows.join(other, F.col("_own").eqNullSafe(F.col("_id")), "left").where(times > 0).select(
        "_row", F.explode(F.sequence(F.lit(1), times)).alias("_time")
    ).select("_row.*")
