import gzip
import io
import re
from collections import Counter, defaultdict

import pytest

from caseweave.llm import licences, line_quality, warc
from tests.llm.fixtures import awkward, clashing, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(grams)
    covered = {p for i, g in enumerate(grams) if counts[g] > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def verdicts(rows, share, least):
    def normal(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")

    texts = defaultdict(set)
    for _, text, _, source, _ in rows:
        texts[source or ""].add(text or "")
    hot = {}
    for host, own in texts.items():
        counts = Counter(n for t in own for n in {normal(x) for x in t.split("\n")} if n)
        hot[host] = {n for n, c in counts.items() if c > least and c > share * len(own)}
    out = []
    for doc_id, text, _, source, _ in rows:
        words, chars, symbols, dup, repeat = measures(text)
        left = "\n".join(x for x in (text or "").split("\n") if normal(x) not in hot[source or ""])
        n_left = len(WORD.findall(left))
        failed = words < 10 or 100 * repeat > 20 * words
        out.append((doc_id, words, chars, symbols, dup, repeat, n_left, failed, not failed and 100 * n_left >= 20 * words))
    return out


def cased_rows():
    menu = "Home | About & more\nRead  THE news"
    rows = [(100 + i, menu + "\n" + (prose(50 + i, 30) if i % 3 else "so few words are here now ok"), "en", "menu", 0) for i in range(20)]
    return awkward() + rows + [(200, menu.lower(), "en", "menu", 0), (201, "a b c d e a b c d e f a b c d e\nx\nx", "en", "s9", 0)]


@pytest.mark.parametrize(("share", "least"), [(0.1, 10), (0.5, 1), (0.0, 0)])
def test_quality_rules_against_brute_force(spark, share, least):
    rows = cased_rows()
    got = line_quality.assess(clashing(documents(spark, rows)), share=share, least=least).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words_left", "base_failed", "kept"
    )
    assert Counter(map(tuple, got.collect())) == Counter(verdicts(rows, share, least))


def test_clean_keeps_columns_and_drops_boilerplate(spark):
    df = clashing(documents(spark, cased_rows()))
    kept = line_quality.clean(df)
    assert kept.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert "Home" not in texts[101] and 100 in texts and 200 not in texts and 4 not in texts
    assert line_quality.clean(documents(spark, [])).count() == 0


def test_quality_without_broadcast(spark, monkeypatch):
    rows = cased_rows()
    monkeypatch.setattr(line_quality, "BROADCAST_LINES", -1)
    got = line_quality.assess(documents(spark, rows)).select("row.doc_id", "kept").collect()
    assert Counter(map(tuple, got)) == Counter((v[0], v[-1]) for v in verdicts(rows, 0.1, 10))


@pytest.mark.parametrize("most_lines", [line_quality.HOST_LINES, 0])
def test_boilerplate_of_a_hot_host(spark, monkeypatch, most_lines):
    monkeypatch.setattr(line_quality, "HOST_LINES", most_lines)
    menu = "Home | About | Contact us about all that you want to know"
    rows = [(i, prose(9000 + i, 12).replace("\n", " ") + ("\n" + menu if i < 30 else ""), "en", "hot", 0) for i in range(600)]
    rows += [(600 + i, menu + f"\nw{i}", "en", "hot", 0) for i in range(3)]  # depleted: one word is left
    rows += [(700 + i, prose(9700 + i, 12).replace("\n", " ") + ("\nrare line here" if i < 20 else ""), "en", "cool", 0) for i in range(300)]
    got = {r["doc_id"]: r for r in line_quality.assess(documents(spark, rows)).select("row.doc_id", "n_words_left", "kept").collect()}
    assert len(got) == len(rows)
    assert all(got[i]["n_words_left"] == 12 and got[i]["kept"] for i in range(600))
    assert all(got[600 + i]["n_words_left"] == 1 and not got[600 + i]["kept"] for i in range(3))
    assert all(got[700 + i]["n_words_left"] == (15 if i < 20 else 12) for i in range(300))


MIT = """ * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all
 * copies or substantial portions of the Software."""


def test_licences(spark):
    rows = [
        (1, "A start.\nLicensed under the Apache License, Version 2.0. All rights reserved.", None, None, 0),
        (2, MIT, None, None, 0),
        (3, "Released under the MIT License.\n" * 3 + "x.\n" * 9 + "RELEASED UNDER the MIT license!", None, None, 0),
        (4, "The licensed software is reserved. Not a rule.", None, None, 0),
        (5, "Some heading\nThis work is licensed under the GNU General Public License, version 3.", None, None, 0),
        (6, "Licensed under the Apache License, Version 2.0 (the \"License\");\nYou may not use this file except in compliance with the License. "
            "Foo bar. Unless required by applicable law or agreed to in writing, software distributed under the License is "
            "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", None, None, 0),
    ]
    got = licences.recognise(clashing(documents(spark, rows + awkward())))
    found = {(r["doc_id"], r["licence"]): (r["n_matches"], r["n_sentences"], r["first_sentence"]) for r in got.collect()}
    assert found[1, "Apache-2.0"] == (1, 1, 1) and found[1, "All-rights-reserved"] == (1, 1, 2)
    assert found[2, "MIT"][:2] == (1, 2)
    assert found[3, "MIT"][0] == 4 and found[5, "GPL-3.0"] == (1, 1, 1)
    assert not [k for k in found if k[0] == 4] and {k[0] for k in found} <= {1, 2, 3, 5, 6}
    assert licences.recognise(documents(spark, [])).count() == 0


AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3 = BSD2 + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
CC = "This work is licensed under a\nCreative Commons {} 4.0\nInternational License."
NOTICES = (
    ("MIT", MIT + "\n *\n * " + AS_IS.replace("\n", "\n * "), 3), ("MIT", MIT.replace(" * ", "").replace(" *\n", "\n") + "\n\n" + AS_IS, 3),
    ("MIT", "Released under the\nMIT License.", 1), ("Apache-2.0", APACHE, 5),
    ("GPL-3.0-or-later", GPL.format(":", ",", 3), 3), ("GPL-2.0-or-later", GPL.format(";", ";", 2), 3),
    ("GPL-3.0", "This work is licensed under the GNU\nGeneral Public License, version 3.", 1),
    ("MPL-2.0", MPL, 2), ("MPL-2.0", MPL.replace("at https", "at\nhttp"), 2), ("BSD-2-Clause", BSD2, 3), ("BSD-3-Clause", BSD3, 4),
    ("ISC", ISC, 1), ("CC-BY-4.0", CC.format("Attribution"), 1), ("CC-BY-SA-4.0", CC.format("Attribution-ShareAlike"), 1),
    ("CC-BY-NC-4.0", CC.format("Attribution-NonCommercial"), 1), ("CC-BY-NC-4.0", "Licensed under\nCC BY-NC 4.0.", 1),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", 1),
    ("Apache-2.0", "Licensed under the\nApache License, Version 2.0.", 1), ("All-rights-reserved", "All Rights\nReserved.", 1),
)


def test_wrapped_notices_are_recognised(spark):
    marks = ("", "# ", "// ", " * ")
    rows = [
        (10 * i + k, "Some Heading\n\n" + "\n".join(mark + line for line in text.split("\n")) + "\n\nThe code follows", None, None, 0)
        for i, (_, text, _) in enumerate(NOTICES) for k, mark in enumerate(marks)
    ]
    got = Counter((r["doc_id"], r["licence"], r["n_matches"], r["n_sentences"]) for r in licences.recognise(documents(spark, rows)).collect())
    assert got == Counter((10 * i + k, name, 1, n) for i, (name, _, n) in enumerate(NOTICES) for k in range(len(marks)))


def test_known_sentences_inside_others_are_none(spark):
    texts = ["It is not released under the MIT License.", "Released under the MIT License or another.", "We say all rights reserved; or not."]
    assert licences.recognise(documents(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)])).count() == 0


def test_licence_rules_need_their_order_and_nearness(spark):
    known = {"A": "first known", "B": "second known"}
    rules = (("both", "AB"), ("second", "B"))
    texts = ["First known. Second known.", "Second known. First known.", "First known. x. y. z. Second known.", "First known. x. Second known."]
    got = licences.recognise(documents(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]), sentences=known, rules=rules)
    assert {(r["doc_id"], r["licence"]) for r in got.collect()} == {(0, "both"), (1, "second"), (2, "second"), (3, "both")}


PAGES = "page_id long, url string, html string"


def page_rows():
    big = "<p>" + "é" * 200
    return [
        (5, "http://a/5", big), (3, "http://a b/\r\nX: 1", big), (9, None, big), (1, "u", None), (2, "u", ""), (4, "u", "small"),
        (6, "u", "small"), (7, "u", "x" * 99), (8, "u", "x" * 99), (10, "u", "WARC/1.1\r\n\r\n" + "y" * 5000), (None, "u", big),
        (3, "http://again", big), (11, "u", "\x1f\x8b" + "z" * 300_000),
    ]


def test_archives_round_trip(spark):
    rows = page_rows()
    manifest = warc.write(clashing(spark.createDataFrame(rows, PAGES)))
    got = warc.read(manifest).collect()
    import hashlib

    expected = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        first = min(same) if len(data) >= 100 and same else None
        revisit = first is not None and page_id is not None and page_id > first
        expected[page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected
    assert {r["url"] for r in got} >= {"http://a%20b/%0D%0AX:%201", None}
    assert warc.read(warc.write(spark.createDataFrame([], PAGES))).count() == 0


def archive(n=6, packed=True):
    import hashlib

    members = []
    for i in range(n):
        payload = f"payload {i} ".encode() * 50
        data = warc.record(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), None)
        members.append(gzip.compress(data, mtime=0) if packed else data)
    return members


def salvaged(data):
    found = list(warc.Salvage(io.BytesIO(data)))
    assert all(a.end <= b.start for a, b in zip(found, found[1:], strict=False))
    return [warc.row_of("f", f) for f in found]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("block", [1 << 18, 7])
def test_salvage_of_damaged_archives(packed, block, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", block)
    members = archive(packed=packed)
    whole = b"".join(members)
    assert [r["page_id"] for r in salvaged(whole)] == list(range(6))
    starts = [len(b"".join(members[:i])) for i in range(7)]
    broken = bytearray(whole)
    broken[starts[2] + len(members[2]) // 2] ^= 0xFF  # a flipped byte in the third record
    rows = salvaged(bytes(broken))
    assert [r.get("page_id") for r in rows if not r["reason"]] == [0, 1, 3, 4, 5]
    assert [(r["offset"], r["gap_end"]) for r in rows if r["reason"]] == [(starts[2], starts[3])]
    junk = b"\x00junk WARC/1. \x1f\x8b\x08 more" * 3
    rows = salvaged(junk + whole[: starts[3]] + junk + whole[starts[3] : -5])
    assert [r["page_id"] for r in rows if not r["reason"]] == [0, 1, 2, 3, 4]
    gaps = [(r["offset"], r["gap_end"]) for r in rows if r["reason"]]
    shift = len(junk)
    assert gaps == [(0, shift), (shift + starts[3], 2 * shift + starts[3]), (2 * shift + starts[5], 2 * shift + len(whole) - 5)]
    assert salvaged(b"") == [] and [r["reason"] is not None for r in salvaged(b"nothing here")] == [True]


def test_salvage_of_both_kinds_in_one_file():
    mixed = archive(2)[0] + archive(2, packed=False)[1] + archive(3)[2]
    assert [r["page_id"] for r in salvaged(mixed)] == [0, 1, 2]


def test_gaps_are_logged(spark, tmp_path):
    path = tmp_path / "damaged.warc.gz"
    members = archive(3)
    path.write_bytes(members[0] + b"garbage" + members[1][:-3] + members[2])
    records = warc.read(spark.createDataFrame([(str(path),)], "path string"))
    assert sorted(r["page_id"] for r in records.where("reason IS NULL").collect()) == [0, 2]
    gaps = warc.log_gaps(records).collect()
    assert [(g["offset"], g["gap_end"]) for g in gaps] == [(len(members[0]), len(members[0]) + 7 + len(members[1]) - 3)]
