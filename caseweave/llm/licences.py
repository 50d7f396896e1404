"""Licence recognition by sentences: known sentences become identifiers, ordered rules match their sequences.

A text is cut into sentences, each is normalised (lower case, runs of other than letters and digits become a space) and
numbered. A known sentence is found where it is a whole sentence, and also where its words run on over several cuts, as in
notices that are wrapped before an upper-case word or hold a colon or "v."; inside a sentence it may begin and end at a
semicolon or before an address too (``PART``). It never begins or ends elsewhere in a sentence. The identifiers of a text, in order, form a sequence with a break where more than
``max_gap`` unknown sentences lie between the last sentence of one and the first of the next. Rules are tried in the order given at each place, longer ones
first, and do not overlap: a rule that matches uses up its sentences. Everything happens inside the row: nothing is
shuffled, so neither hot sentences nor long texts make a large group.

A line break ends a sentence unless the next line goes on in lower case; comment marks at a line's start are dropped.

Defined results: null and empty texts and texts without a known rule give no row; rows that repeat give their rows
each; an empty table gives an empty one; only the id and text columns are read. Known sentences that no rule uses up
give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences, normalised, by identifier.
SENTENCES = {
    "A": "released under the mit license",
    "B": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
         "documentation files the software to deal in the software without restriction including without limitation "
         "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
         "permit persons to whom the software is furnished to do so subject to the following conditions",
    "C": "the above copyright notice and this permission notice shall be included in all copies or substantial "
         "portions of the software",
    "D": "the software is provided as is without warranty of any kind express or implied including but not limited to "
         "the warranties of merchantability fitness for a particular purpose and noninfringement",
    "E": "licensed under the apache license version 2 0",
    "F": "licensed under the apache license version 2 0 the license",
    "G": "you may not use this file except in compliance with the license",
    "H": "you may obtain a copy of the license at",
    "I": "unless required by applicable law or agreed to in writing software distributed under the license is "
         "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "J": "see the license for the specific language governing permissions and limitations under the license",
    "K": "this work is licensed under the gnu general public license version 3",
    "L": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
         "public license as published by the free software foundation either version 3 of the license or at your "
         "option any later version",
    "M": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
         "public license as published by the free software foundation either version 2 of the license or at your "
         "option any later version",
    "N": "this program is distributed in the hope that it will be useful but without any warranty without even the "
         "implied warranty of merchantability or fitness for a particular purpose",
    "O": "see the gnu general public license for more details",
    "P": "licensed under cc by nc 4 0",
    "Q": "this work is licensed under a creative commons attribution 4 0 international license",
    "R": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "S": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "T": "all rights reserved",
    "U": "redistribution and use in source and binary forms with or without modification are permitted provided that "
         "the following conditions are met",
    "V": "redistributions of source code must retain the above copyright notice this list of conditions and the "
         "following disclaimer",
    "W": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
         "following disclaimer in the documentation and or other materials provided with the distribution",
    "X": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
         "products derived from this software without specific prior written permission",
    "Y": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "Z": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "a": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
         "granted provided that the above copyright notice and this permission notice appear in all copies",
    "b": "this is free and unencumbered software released into the public domain",
}

# Licence and sequence of identifiers; "?" after one makes it optional.
RULES = (
    ("MIT", "BC?D?"),
    ("Apache-2.0", "FGH?I?J?"),
    ("GPL-3.0-or-later", "LN?O?"),
    ("GPL-2.0-or-later", "MN?O?"),
    ("BSD-3-Clause", "UVWX"),
    ("BSD-2-Clause", "UVW"),
    ("MPL-2.0", "YZ?"),
    ("MIT", "A"),
    ("Apache-2.0", "E"),
    ("Apache-2.0", "F"),
    ("GPL-3.0", "K"),
    ("CC-BY-NC-4.0", "P"),
    ("CC-BY-4.0", "Q"),
    ("CC-BY-SA-4.0", "R"),
    ("CC-BY-NC-4.0", "S"),
    ("ISC", "a"),
    ("Unlicense", "b"),
    ("All-rights-reserved", "T"),
)
BREAK = " "
GOES_ON = r"([^.!?:\x20\x09-\x0D])[ \t]*\r?\n[ \t]*(?:[*#/;]+[ \t]*)?([a-z0-9(])"
SENTENCE_END = r"[.!?:]+[\x20\x09-\x0D]+|[.!?:]*[\r\n]+"
# Where a known sentence may begin or end inside a sentence.
PART = r";+(?=[\x20\x09-\x0D]|$)|[\x20\x09-\x0D](?=[<(]?https?://)"


def triggers(sentences: dict[str, str]) -> str:
    """A pattern that every text with a known sentence matches: the longest word of each."""
    return "(?iu)" + "|".join(sorted({max(s.split(), key=len) for s in sentences.values()}))


def sentences_of(text: Column) -> Column:
    return F.split(F.regexp_replace(text, GOES_ON, "$1 $2"), SENTENCE_END)


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def marked_parts(text: Column) -> Column:
    """The normalised parts of all sentences in one string, each after a line feed, its sentence's number and a tab."""
    def numbered(sentence: Column, at: Column) -> Column:
        parts = F.filter(F.transform(F.split(sentence, PART), normalised), lambda part: part != "")
        return F.transform(parts, lambda part: F.concat(F.lit("\n"), at.cast("string"), F.lit("\t"), part))

    return F.array_join(F.flatten(F.transform(sentences_of(text), numbered)), "")


def known_run(sentences: dict[str, str]) -> str:
    """A pattern of a known sentence that begins and ends with a part, over any number of parts; longer ones first."""
    ordered = sorted({s for s in sentences.values()}, key=lambda s: (-len(s), s))
    return r"\n\d+\t(?:" + "|".join(r"(?: |\n\d+\t)".join(s.split()) for s in ordered) + r")(?=\n|$)"


def recognise(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] | None = None,
    rules: tuple[tuple[str, str], ...] = RULES, max_gap: int = 2,
) -> DataFrame:
    """A row per text and licence: id, ``licence``, ``n_matches``, ``n_sentences`` used up, ``first_sentence`` (from 0)."""
    sentences = sentences or SENTENCES
    known = F.create_map(*[F.lit(x) for identifier, s in sentences.items() for x in (s, identifier)])
    either = "|".join(pattern for _, pattern in rules)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.col("text").rlike(triggers(sentences))
    )
    found = texts.select(
        "id",
        F.transform(
            F.regexp_extract_all(marked_parts(F.col("text")), F.lit(known_run(sentences)), F.lit(0)),
            lambda run: F.struct(
                F.regexp_extract(run, r"^\n(\d+)\t", 1).cast("int").alias("at"),
                F.regexp_extract(run, r"(?s)^.*\n(\d+)\t", 1).cast("int").alias("until"),
                F.element_at(known, F.trim(F.regexp_replace(run, r"\n\d+\t", " "))).alias("code"),
            ),
        ).alias("found"),
    ).where(F.size("found") > 0)
    sequence = F.array_join(
        F.transform(
            "found",
            lambda x, i: F.concat(
                F.when(x.at - F.get("found", i - 1).until > max_gap + 1, F.lit(BREAK)).otherwise(F.lit("")), x.code
            ),
        ),
        "",
    )
    def named(run: Column) -> Column:
        return F.struct(
            F.coalesce(*[F.when(run.rlike(f"^(?:{pattern})$"), F.lit(name)) for name, pattern in rules]).alias("licence"),
            F.when(run == BREAK, 0).otherwise(F.length(run)).alias("n"),
        )

    runs = found.select(
        "id", "found", F.transform(F.regexp_extract_all(sequence, F.lit(f"(?:{either})|."), F.lit(0)), named).alias("runs")
    )
    names = F.transform("runs", lambda r: r.licence)
    each = runs.select("id", "found", "runs", names.alias("names")).select(
        "id", "found", "runs", "names", F.explode(F.array_distinct(F.array_compact("names"))).alias("licence")
    )
    own = F.filter("runs", lambda r: r.licence == F.col("licence"))
    before = F.slice("runs", F.lit(1), (F.array_position("names", F.col("licence")) - 1).cast("int"))
    return each.select(
        F.col("id").alias(id_col), "licence", F.size(own).cast("long").alias("n_matches"),
        F.aggregate(own, F.lit(0), lambda total, r: total + r.n).cast("long").alias("n_sentences"),
        F.get("found", F.aggregate(before, F.lit(0), lambda total, r: total + r.n)).at.cast("long").alias("first_sentence"),
    )
