"""Quality rules: word and repetition measures of a text, and the frequency of its lines over the documents of a host.

A line (split at line feeds, lower-cased, white space squeezed) is boilerplate of a host when it occurs in more than
``least`` of the host's distinct texts and in more than ``share`` or more than ``most`` of them; exact copies count once,
so a text that was copied often does not turn its own lines into boilerplate. ``most`` holds for a host of any size, so a
line of thousands of texts does not stay because its host has many more. Boilerplate lines are removed. A document is
rejected when a base rule fails or when too few of its words are left.

Everything is a column expression or an aggregate. As long as no host has more than ``HOST_LINES`` boilerplate lines and
all have ``BROADCAST_LINES`` at most, each host's are gathered into a list and the lists are broadcast. Beyond that the
lines are looked up by a join on host and line, and only those of one text are gathered.

Defined results: a null text has no words and no lines, fails the base rules and stays null; an empty text likewise; a
null host is a host of its own; rows that repeat are each judged, ids play no part; an empty table gives an empty one;
columns of the input may have any names, they are carried in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caseweave.session import stored

WINDOW = 5
BROADCAST_LINES = 200_000
HOST_LINES = 2_000
MOST = 20  # twice what a line needs in a small host: by then it is a template's, however large the host


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Runs of anything but the six ASCII white-space characters; no element for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def line_hashes(text: Column) -> Column:
    """One entry per line of the text: the hash of the normalised line, null for a blank one."""
    def hashed(line: Column) -> Column:
        normal = F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))
        return F.when(normal != "", F.xxhash64(normal))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), hashed)


def repeated_words(found: Column) -> Column:
    """Words that lie in a window of WINDOW words which occurs twice or more in the list."""
    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
        )

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda p, i: F.least(F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda total, step: total + step,
        )

    def among(pairs: Column) -> Column:
        repeated = F.filter(
            pairs,
            lambda x, i: F.coalesce(F.get(pairs, i - 1).g == x.g, F.lit(False))
            | F.coalesce(F.get(pairs, i + 1).g == x.g, F.lit(False)),
        )
        return let(F.array_sort(F.transform(repeated, lambda x: x.p)), covered)

    def counted(grams: Column) -> Column:
        distinct = F.size(F.array_distinct(grams)) == F.size(grams)
        pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("p"))))
        return F.when(distinct, F.lit(0).cast("long")).otherwise(let(pairs, among))

    hashed = F.transform(found, lambda w: F.xxhash64(w))
    return F.when(F.size(found) < WINDOW, F.lit(0).cast("long")).otherwise(
        let(hashed, lambda h: let(windows(h), counted))
    )


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda kept: (F.size(kept) - F.size(F.array_distinct(kept))).cast("long"))


def text_lines(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """``host``, ``digest`` and the hashes of the ``lines`` of each distinct text of a host."""
    return (
        docs.select(
            F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
            F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"),
            F.array_distinct(line_hashes(F.col(text_col))).alias("lines"),
        )
        .groupBy("host", "digest").agg(F.first("lines").alias("lines"))
    )


def boilerplate(docs: DataFrame, text_col: str, host_col: str, share: float, least: int, most: int) -> DataFrame:
    """``host`` and ``line``, the hash of one of its boilerplate lines."""
    texts = text_lines(docs, text_col, host_col)
    # A null entry per text counts the host's texts beside its lines.
    entries = texts.select("host", F.explode(F.array_append(F.array_compact("lines"), F.lit(None))).alias("line"))
    counts = stored(
        entries.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("line").isNull() | (F.col("n") > least)),
        "line-counts",
    )
    totals = counts.where("line IS NULL").select("host", F.col("n").alias("total"))
    hot = counts.where("line IS NOT NULL").join(totals, "host")
    return stored(hot.where((F.col("n") > F.col("total") * share) | (F.col("n") > most)).select("host", "line"), "boilerplate")


def assess(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", share: float = 0.1, least: int = 10,
    min_words: int = 10, max_repeat_pct: int = 20, min_left_pct: int = 20, most: int = MOST,
) -> DataFrame:
    """``row`` (the input row), its measures, ``clean_text`` (without boilerplate lines), ``base_failed``, ``kept``."""
    hot = boilerplate(docs, text_col, host_col, share, least, most)
    size = hot.groupBy("host").count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("all"), F.coalesce(F.max("count"), F.lit(0)).alias("longest")
    ).first()
    rows = docs.select(
        F.struct("*").alias("row"), F.col(text_col).alias("_text"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
    )
    if size["all"] <= BROADCAST_LINES and size["longest"] <= HOST_LINES:
        rows = rows.join(F.broadcast(hot.groupBy("host").agg(F.collect_list("line").alias("lines"))), "host", "left")
    else:
        entries = text_lines(docs, text_col, host_col).select("host", "digest", F.explode(F.array_compact("lines")).alias("line"))
        own = entries.join(hot, ["host", "line"]).groupBy("host", "digest").agg(F.collect_list("line").alias("lines"))
        digest = F.sha2(F.coalesce("_text", F.lit("")), 256)
        rows = rows.withColumn("digest", digest).join(own, ["host", "digest"], "left")
    text = F.coalesce("_text", F.lit(""))
    lines = F.split(text, "\n")

    def without(hashes: Column) -> Column:
        return F.when(
            F.arrays_overlap(hashes, F.col("lines")),
            F.array_join(
                F.filter(lines, lambda _, i: ~F.coalesce(F.array_contains(F.col("lines"), F.get(hashes, i)), F.lit(False))),
                "\n",
            ),
        ).otherwise(F.col("_text"))

    def measures(w: Column, cleaned: Column) -> Column:
        n_words = F.size(w).cast("long")
        return F.struct(
            n_words.alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            repeated_lines(F.col("_text")).alias("n_dup_lines"), cleaned.alias("clean_text"),
            F.when(cleaned.eqNullSafe(F.col("_text")), n_words).otherwise(F.size(words(cleaned)).cast("long")).alias("n_words_left"),
        )

    cleaned = F.when(F.col("lines").isNull(), F.col("_text")).otherwise(let(line_hashes(F.col("_text")), without))
    # The explode of one element keeps the measures from being computed again for each use, filters included.
    measured = rows.select(
        "row", F.explode(F.array(let(words(F.col("_text")), lambda w: let(cleaned, lambda c: measures(w, c))))).alias("m")
    ).select("row", "m.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    depleted = 100 * F.col("n_words_left") < min_left_pct * F.col("n_words")
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def clean(docs: DataFrame, text_col: str = "text", **rules) -> DataFrame:
    """The documents that pass, without their boilerplate lines, with the columns of the input."""
    passed = assess(docs, text_col, **rules).where("kept")
    return passed.select(*[F.col("clean_text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
