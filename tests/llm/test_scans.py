from __future__ import annotations

import random

from pyspark.sql import functions as F

from adlake.llm import decontamination, licenses
from adlake.llm.decontamination import distance_within, match_items, normal


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for at, char in enumerate(pattern, 1):
        new = [at]
        for to, other in enumerate(text, 1):
            new.append(min(row[to] + 1, new[-1] + 1, row[to - 1] + (char != other)))
        row = new
    return min(row)


def test_distance_against_the_table():
    draw = random.Random(3)
    for _ in range(600):
        pattern = "".join(draw.choices("abc ", k=draw.randrange(1, 80)))
        text = "".join(draw.choices("abc ", k=draw.randrange(0, 90)))
        if draw.random() < 0.6:
            at = draw.randrange(len(pattern))
            text += pattern[:at] + "z" + pattern[at + 1 :] + text[:9]
        masks = {}
        for at, char in enumerate(pattern):
            masks[char] = masks.get(char, 0) | 1 << at
        budget = draw.randrange(0, 7)
        assert distance_within(pattern, masks, text, budget) == (distance(pattern, text) <= budget)


def test_items_in_documents(spark, make, odd, empty, monkeypatch):
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefghij", k=draw.randrange(2, 8)))
    items = [(n, " ".join(word() for _ in range(draw.randrange(12, 40))) + ".") for n in range(30)]
    rows = []
    for n in range(60):
        text = " ".join(word() for _ in range(80))
        if n % 2:
            item = list(items[n % 30][1])
            for _ in range(n % 9):
                item[draw.randrange(len(item))] = draw.choice("xyz")
            text = text[:200] + " " + "".join(item).upper().replace(" ", " \n", n % 4) + " " + text[200:]
        rows.append((n, text))
    rows.append((99, " ".join(text for _, text in items)))
    expected = {}
    for n, text in rows:
        own = normal(text)
        expected[n] = [number for number, item in items if distance(normal(item), own) <= int(len(normal(item)) / 16)]
    assert sum(map(bool, expected.values())) > 15
    table = spark.createDataFrame([*items, (50, None), (None, "a b"), (51, "tiny"), (52, "")], "item_id long, text string")
    for chars in (16_000_000, 4000):
        monkeypatch.setattr(decontamination, "GROUP_CHARS", chars)
        found = match_items(make(rows).withColumn("matched_items", F.lit("clash")), table)
        assert {row["doc_id"]: row["matched_items"] for row in found.collect()} == expected
    assert [row["matched_items"] for row in match_items(odd, table).collect()] == [[]] * odd.count()
    assert match_items(odd, table.where("false")).count() == odd.count() and match_items(empty, table).count() == 0


def test_short_items_are_found_word_for_word(spark, make):
    question = "水的沸点是多少摄氏度呢请回答"
    items = [(1, question), (2, "what is 7 plus 5?"), (3, "yes"), (4, "是的"), (5, None), (None, "null id but long enough")]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, f"前面的话。{question}？后面"), (2, f"前面{question}"), (3, "so, What is 7 plus 5? 12"), (4, "what is 7 plus 55"),
        (5, "what is 8 plus 5"), (6, "yes 是的"), (7, question), (8, "somewhat is 7 plus 5"),
    ]
    found = {row["doc_id"]: row["matched_items"] for row in match_items(make(rows), table).collect()}
    assert found == {1: [1], 2: [], 3: [2], 4: [], 5: [], 6: [], 7: [1], 8: []}
    told = {(row["item_id"], row["text"]) for row in decontamination.unsearched(table).collect()}
    assert told == {items[2], items[3], items[4], items[5]}


def test_columns_of_any_name_pass_through_the_search(spark, make, monkeypatch):
    monkeypatch.setattr(decontamination, "GROUP_CHARS", 30)
    item = "a benchmark question of some length, asked in english"
    table = spark.createDataFrame([(n, item + " " * n) for n in range(4)], "item_id long, text string")
    names = {name: F.lit(name) for name in ("_matched_0", "_matched", "_matched_1", "group", "a.b")}
    [row] = match_items(make([(1, f"So: {item}")]).withColumns(names), table).collect()
    assert row["matched_items"] == [0, 1, 2, 3] and all(row[name] == name for name in names)


def test_a_very_long_text_is_searched_whole(spark, make):
    item = "a benchmark question of some length, asked in english"
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, "filler words here " * 280_000 + item), (2, "filler words here " * 280_000)]
    assert {row["doc_id"]: row["matched_items"] for row in match_items(make(rows), table).collect()} == {1: [1], 2: []}


def test_sentence_rules(make, odd, empty):
    bsd = [licenses.SENTENCES[name] for name in ("BSD-grant", "BSD-source", "BSD-binary", "BSD-endorse")]
    apache = """
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance
 * with the License."""
    rows = [
        (1, "text\nReleased under the MIT License.\ntext"), (2, "No stop before\nLicensed under CC BY-NC 4.0."), (3, apache),
        (4, bsd[0] + ":\n1. " + bsd[1] + ".\n2. " + bsd[2] + ".\n3. " + bsd[3] + "."), (5, bsd[2] + ". " + bsd[1] + "."),
        (6, "Licensed under the Apache License, Version 2.0.\nMore.\nReleased under the MIT License."), (7, "the license of nothing"),
    ]
    found = {row["doc_id"]: row["licences"] for row in licenses.scan_licences(make(rows)).collect()}
    assert found == {1: ["MIT"], 2: ["CC-BY-NC-4.0"], 3: ["Apache-2.0"], 4: ["BSD-3-Clause"], 5: [], 6: ["Apache-2.0", "MIT"], 7: []}
    assert all(row["licences"] == [] for row in licenses.scan_licences(odd).collect())
    assert licenses.scan_licences(empty).count() == 0


def test_every_sentence_is_recognised():
    recogniser = licenses.Recogniser()
    for name, sentence in licenses.SENTENCES.items():
        assert recogniser.identifiers(f"Before. {sentence}.\nAfter.") == [name]


def test_wordings_of_real_files():
    recogniser = licenses.Recogniser()
    of = lambda text: recogniser.licences(recogniser.identifiers(text))
    head = "{BSD-grant}:\n\n1. {BSD-source}.\n2. {BSD-binary}.\n".replace("{", "%(").replace("}", ")s") % licenses.SENTENCES
    disclaimer = "\n" + licenses.SENTENCES["BSD-as-is"] + "."
    named = "3. Neither the name of Google Inc. nor the names of its\ncontributors may be used to endorse or promote products derived from\nthis software without specific prior written permission.\n"
    regents = disclaimer.replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE REGENTS AND CONTRIBUTORS")
    assert of(head + named + disclaimer) == of(head + named) == of(head + named + regents) == ["BSD-3-Clause"]
    assert of(head + disclaimer) == of(head + regents) == of(head) == of(head + "\nOther words.") == ["BSD-2-Clause"]
    assert of(head + "3. You must send a postcard.\n" + disclaimer) == of(head + "3. You must send a postcard.") == ["LicenseRef-BSD-family"]
    advertising = "3. " + licenses.SENTENCES["BSD-advertising"] + ": This product includes software developed by X.\n"
    assert of(head + advertising + named.replace("3.", "4.") + regents) == ["BSD-4-Clause"]
    assert of("# The ASF licenses this file\n# to You under the Apache License, Version 2.0\n# (the \"License\"); you may not use this file") == ["Apache-2.0"]
    assert of("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nint x;") == ["Apache-2.0", "GPL-2.0-only", "MIT"]
    assert of("To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to This Work.") == ["CC0-1.0"]
    for name, licence in (("Unlicense", "Unlicense"), ("AGPL-free", "AGPL-3.0-or-later"), ("LGPL-free-2.1", "LGPL-2.1-or-later"), ("GPL-3-body", "GPL-3.0"), ("Apache-body-grant", "Apache-2.0")):
        assert of(licenses.SENTENCES[name] + ".") == [licence]


def test_reserved_rights_in_a_licence_and_short_mentions(make):
    bsd = "\n".join(licenses.SENTENCES[name] + "." for name in ("BSD-grant", "BSD-source", "BSD-binary", "BSD-endorse", "BSD-as-is"))
    texts = {
        1: ("Copyright 2020 Jo. All rights reserved.\n" + bsd, ["BSD-3-Clause"]),
        2: ("Copyright 2020 Jo. All rights reserved.", ["LicenseRef-all-rights-reserved"]),
        3: ("The MIT License (MIT)\n\nCopyright 2020", ["MIT"]),
        4: ("name: tool\nLicense: MIT\n", ["MIT"]),
        5: (licenses.SENTENCES["GPL-free-2-only"] + ".", ["GPL-2.0-only"]),
        6: ("A permit for the license of MIT people.", []),
    }
    found = {row["doc_id"]: row["licences"] for row in licenses.scan_licences(make([(n, text) for n, (text, _) in texts.items()])).collect()}
    assert found == {n: wanted for n, (_, wanted) in texts.items()}
