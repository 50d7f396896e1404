"""Small tables with the awkward cases that every operator has to bear."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n_words: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    syllables = ["ba", "lo", "ti", "re", "mun", "ka", "sel", "no", "vi", "dur", "é", "ñu"]
    words = ["".join(rng.choice(syllables) for _ in range(1 + i % 4)) + str(i % 97) for i in range(vocabulary)]
    picked = [rng.choice(words) for _ in range(n_words)]
    return " ".join(w + ("." if i % 11 == 10 else "") + ("\n" if i % 40 == 39 else "") for i, w in enumerate(picked)).replace("\n ", "\n")


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, odd characters."""
    base = prose(1, 200)
    near = base.split(" ")
    near[100] = "changed"
    rows = [
        (1, base, "en", "s0"), (2, base, "en", "s0"), (3, " ".join(near), "en", "s1"), (4, None, None, None),
        (5, "", "en", "s0"), (6, " \n\t ", "en", "s0"), (7, "one two", "en", None), (7, "one two", "en", None),
        (8, "x" * 30_000, "de", "s1"), (9, "word " * 5000, "de", "s1"), (10, prose(2, 6000), "fr", "s1"),
        (None, prose(3, 80), "en", "s0"), (None, None, None, None), (11, "İstanbul ΣΑΣ 漢字 🙂́ a\x0bb\x1cc", "es", "s2"),
        (12, prose(3, 80), "es", "s2"), (13, "one two", "es", "s2"), (14, prose(5, 90) + "\n" + prose(1, 200), "en", "s0"),
    ]
    return [(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCUMENTS)


def clashing(df):
    """The same rows with further columns named like the operators' own."""
    from pyspark.sql import functions as F

    for name in ("row", "host", "lines", "_text", "id", "p", "ids", "node", "digest", "n_words", "text_", "_row", "score", "at"):
        df = df.withColumn(name, F.lit("mine"))
    return df
