"""Recognises licences by their sentences and the order these stand in."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from adlake.llm.shared import add_columns

# Wording of public licences, one sentence for each identifier.
# GAP stands for the name of a holder.
GAP = "..."
SPDX_MARK = "SPDX:"  # before the identifiers of SPDX lines
GAP_WORDS = 20
GAP_PARTS = 6  # that a name with stops ("Inc.") may break its sentence into
SENTENCES = {
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "MIT-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "MIT-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "MIT-name": "Released under the MIT License",
    "MIT-name-2": "Licensed under the MIT License",
    "MIT-name-3": "This project is licensed under the MIT License",
    "MIT-title": "The MIT License (MIT)",
    "MIT-title-2": "MIT License",
    "MIT-field": "License: MIT",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BSD-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSD-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "BSD-endorse-named": "Neither the name of ... nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD-endorse-named-2": "Neither the name of ... nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD-endorse-named-3": "Neither the names of ... nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD-endorse-author": "The name of ... may not be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "BSD-as-is-named": "THIS SOFTWARE IS PROVIDED BY ... \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "ISC-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "Apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "Apache-comply": "you may not use this file except in compliance with the License",
    "Apache-obtain": "You may obtain a copy of the License at",
    "Apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "Apache-limits": "See the License for the specific language governing permissions and limitations under the License",
    "Apache-name": "Licensed under the Apache License, Version 2.0",
    "Apache-asf": "The ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\")",
    "Apache-body": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "Apache-body-grant": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form",
    "GPL-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "GPL-free-2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "GPL-free-2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "GPL-free-2-only-version": "This program is free software; you can redistribute it and/or modify it under the terms of version 2 of the GNU General Public License as published by the Free Software Foundation",
    "GPL-free-3-only": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
    "GPL-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "GPL-details": "See the GNU General Public License for more details",
    "GPL-3-body": "The GNU General Public License is a free, copyleft license for software and other kinds of works",
    "GPL-2-body": "This License applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this General Public License",
    "LGPL-free-3": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "LGPL-free-3-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "LGPL-free-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "AGPL-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "AGPL-body": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software",
    "CC0-waiver": "To the extent possible under law, ... has waived all copyright and related or neighboring rights to ...",
    "CC0-name": "Licensed under CC0 1.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "EPL-2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at ...",
    "EPL-1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at ...",
    "GPL-name": "This work is licensed under the GNU General Public License, version 3",
    "GPL-name-2": "Licensed under the GNU General Public License, version 3",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0",
    "CC-BY": "Licensed under CC BY 4.0",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0",
    "CC-BY-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MPL-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "proprietary": "All rights reserved",
}
BSD = ("BSD-grant", "BSD-source", "BSD-binary")
BSD_ENDORSE = ("BSD-endorse", "BSD-endorse-named", "BSD-endorse-named-2", "BSD-endorse-named-3", "BSD-endorse-author")
BSD_AS_IS = (("BSD-as-is",), ("BSD-as-is-named",), ())
# Conditions of a BSD licence with a clause that is not in the list.
BSD_FAMILY = "LicenseRef-BSD-family"
# A sentence that many licences hold: it counts where no licence claims the file.
RESERVED = "LicenseRef-all-rights-reserved"
# Identifiers in order and the licence they make. Of the rules
# that begin at a place the longest counts; its sentences serve no other rule.
RULES = [
    (("MIT-grant", "MIT-notice", "MIT-as-is", "MIT-liability"), "MIT"),
    (("MIT-grant", "MIT-notice"), "MIT"),
    *(((title, "MIT-grant", "MIT-notice", "MIT-as-is", "MIT-liability"), "MIT") for title in ("MIT-title", "MIT-title-2")),
    (("MIT-title",), "MIT"),
    (("MIT-title-2",), "MIT"),
    (("MIT-field",), "MIT"),
    (("MIT-name",), "MIT"),
    (("MIT-name-2",), "MIT"),
    (("MIT-name-3",), "MIT"),
    *(((*BSD, "BSD-advertising", endorse, *as_is), "BSD-4-Clause") for endorse in BSD_ENDORSE for as_is in BSD_AS_IS),
    *(((*BSD, "BSD-other", *as_is), BSD_FAMILY) for as_is in BSD_AS_IS),
    *(((*BSD, "BSD-advertising", *as_is), BSD_FAMILY) for as_is in BSD_AS_IS),
    *(((*BSD, endorse, *as_is), "BSD-3-Clause") for endorse in BSD_ENDORSE for as_is in BSD_AS_IS),
    *(((*BSD, *as_is), "BSD-2-Clause") for as_is in BSD_AS_IS if as_is),
    (("BSD-grant", "BSD-source", "BSD-binary"), "BSD-2-Clause"),
    (("ISC-grant", "ISC-as-is"), "ISC"),
    (("ISC-grant",), "ISC"),
    (("Apache-header", "Apache-comply", "Apache-obtain", "Apache-as-is", "Apache-limits"), "Apache-2.0"),
    (("Apache-header", "Apache-comply"), "Apache-2.0"),
    (("Apache-name",), "Apache-2.0"),
    (("Apache-asf",), "Apache-2.0"),
    (("Apache-body", "Apache-body-grant"), "Apache-2.0"),
    (("Apache-body-grant",), "Apache-2.0"),
    (("GPL-3-body",), "GPL-3.0"),
    (("GPL-2-body",), "GPL-2.0"),
    (("LGPL-free-3",), "LGPL-3.0-or-later"),
    (("LGPL-free-3-program",), "LGPL-3.0-or-later"),
    (("LGPL-free-2.1",), "LGPL-2.1-or-later"),
    (("AGPL-free",), "AGPL-3.0-or-later"),
    (("AGPL-body",), "AGPL-3.0"),
    (("CC0-waiver",), "CC0-1.0"),
    (("CC0-name",), "CC0-1.0"),
    (("Unlicense",), "Unlicense"),
    (("EPL-2",), "EPL-2.0"),
    (("EPL-1",), "EPL-1.0"),
    (("GPL-free", "GPL-hope", "GPL-details"), "GPL-3.0-or-later"),
    (("GPL-free",), "GPL-3.0-or-later"),
    (("GPL-free-2", "GPL-hope", "GPL-details"), "GPL-2.0-or-later"),
    (("GPL-free-2",), "GPL-2.0-or-later"),
    (("GPL-free-2-only",), "GPL-2.0-only"),
    (("GPL-free-2-only-version",), "GPL-2.0-only"),
    (("GPL-free-3-only",), "GPL-3.0-only"),
    (("GPL-name",), "GPL-3.0"),
    (("GPL-name-2",), "GPL-3.0"),
    (("CC-BY-NC",), "CC-BY-NC-4.0"),
    (("CC-BY",), "CC-BY-4.0"),
    (("CC-BY-SA",), "CC-BY-SA-4.0"),
    (("CC-BY-long",), "CC-BY-4.0"),
    (("MPL-header",), "MPL-2.0"),
    (("proprietary",), RESERVED),
]
WORD = re.compile(r"[^\W_]+")
# A stop followed by white space, a list mark, or an empty line ends a sentence.
SENTENCE_END = re.compile(r"[.;:!?]+(?=\s|$)|\n\s*\n|(?:^|\n)\s*(?:\d+\.|[*-])\s")
LINE_END = re.compile(r"[.;:!?]+(?=\s|$)|\n")
LIST_MARK = re.compile(r"\(?(?:\d+|[a-z])[.)]\s|[*-]\s")
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
SPDX_ID = re.compile(r"[A-Za-z0-9.+-]+(?::[A-Za-z0-9.+-]+)?")
COMMENT_MARK = re.compile(r"\n[ \t]*(?://+|#+|\*+|;+)[ \t]?")


def normal(sentence: str) -> str:
    return " ".join(WORD.findall(sentence.lower()))


class Recogniser:
    """Known sentences by their normal words, and rules over their identifiers.

    A sentence of the list that itself holds several (those with a semicolon)
    is looked up part by part, in order.
    """

    def __init__(self, sentences: dict[str, str] = SENTENCES, rules: list = RULES):
        self.first: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
        self.gapped: list[tuple[str, str, re.Pattern]] = []
        for name, sentence in sentences.items():
            if GAP in sentence:
                pieces = [normal(piece) for piece in sentence.split(GAP)]
                gap = rf"(?: \S+){{0,{GAP_WORDS}}}"
                pattern = gap.join(re.escape(" " * (at > 0 and piece != "") + piece) for at, piece in enumerate(pieces))
                self.gapped.append((name, pieces[0], re.compile(pattern)))
                continue
            parts = tuple(normal(part) for part in SENTENCE_END.split(sentence) if part and normal(part))
            self.first.setdefault(parts[0], []).append((name, parts))
        for known in self.first.values():
            known.sort(key=lambda item: -len(item[1]))
        self.rules = sorted(rules, key=lambda rule: -len(rule[0]))
        words = [set(WORD.findall(sentence.lower())) for sentence in sentences.values()] + [{"identifier"}]
        self.marks = self._marks(words)

    @staticmethod
    def _marks(sentences: list[set[str]]) -> list[str]:
        """Few words of which every known sentence has one: others need no look."""
        left, marks = list(sentences), []
        while left:
            counts: dict[str, int] = {}
            for words in left:
                for word in words:
                    if len(word) > 4:
                        counts[word] = counts.get(word, 0) + 1
            if not counts:
                return [""]
            marks.append(max(sorted(counts), key=counts.__getitem__))
            left = [words for words in left if marks[-1] not in words]
        return marks

    def identifiers(self, text: str) -> list[str]:
        """Identifiers of the known sentences of a text, in order.

        Sentences are read over line ends, since licences are wrapped, and also
        line by line, since a line before may lack its stop.
        """
        low = text.lower()
        if not any(mark in low for mark in self.marks):
            return []
        found: dict[int, str] = {}
        plain = COMMENT_MARK.sub(lambda match: "\n" + " " * (len(match[0]) - 1), text)
        for ends in (SENTENCE_END, LINE_END):
            spans, start = [], 0
            for end in ends.finditer(plain):
                spans.append((start, end.start()))
                start = end.end()
            spans.append((start, len(plain)))
            parts = [(end, words) for begin, end in spans if (words := normal(plain[begin:end]))]
            for at, (_, words) in enumerate(parts):
                for name, wanted in self.first.get(words, ()):
                    if tuple(part for _, part in parts[at : at + len(wanted)]) == wanted:
                        found.setdefault(parts[at + len(wanted) - 1][0], name)
                        break
                for name, begins, pattern in self.gapped:
                    if not words.startswith(begins):
                        continue
                    for upto in range(at, min(len(parts), at + GAP_PARTS)):
                        if pattern.fullmatch(" ".join(part for _, part in parts[at : upto + 1])):
                            found.setdefault(parts[upto][0], name)
                            break
        for end in [end for end, name in found.items() if name == "BSD-binary"]:
            self._other_clause(plain, end, found)
        for line in SPDX.finditer(plain):
            for at in SPDX_ID.finditer(line[1]):
                if at[0].upper() not in ("AND", "OR", "WITH") and not line[1][: at.start()].upper().rstrip(" (").endswith(" WITH"):
                    found[line.start(1) + at.start()] = SPDX_MARK + at[0]
        return [name for _, name in sorted(found.items())]

    @staticmethod
    def _other_clause(plain: str, end: int, found: dict[int, str]) -> None:
        """Adds ``BSD-other`` where a clause that is not known follows the binary one.

        A clause is what has a list mark, or stands before the disclaimer.
        """
        following = min((at for at in found if at > end), default=len(plain))
        stop = re.compile(r"[.;:!?]*\s*(?:and\b|or\b)?\s*").match(plain, end).end()
        known = found.get(following, "")
        if known.startswith("BSD-as-is"):
            start = plain.lower().rfind("this software is provided by", stop, following)
            other = bool(normal(plain[stop:start])) if start >= 0 else False
        else:
            other = bool(LIST_MARK.match(plain, stop)) and known not in (*BSD_ENDORSE, "BSD-advertising")
        if other:
            found.setdefault(stop, "BSD-other")

    def licences(self, identifiers: list[str]) -> list[str]:
        """Licences by the rules; sentences between those of a rule are no bar."""
        found, used = [], set()
        for at in range(len(identifiers)):
            if at in used:
                continue
            if identifiers[at].startswith(SPDX_MARK):
                found.append(identifiers[at].removeprefix(SPDX_MARK))
                continue
            for rule, licence in self.rules:
                places = self._places(identifiers, at, rule, used)
                if places:
                    found.append(licence)
                    used.update(places)
                    break
        others = set(found) - {RESERVED}
        return sorted(others or found[:1])

    @staticmethod
    def _places(identifiers: list[str], start: int, rule: tuple[str, ...], used: set[int]) -> list[int] | None:
        if identifiers[start] != rule[0]:
            return None
        places = [start]
        for wanted in rule[1:]:
            following = (at for at in range(places[-1] + 1, len(identifiers)) if at not in used and identifiers[at] == wanted)
            at = next(following, None)
            if at is None:
                return None
            places.append(at)
        return places


def scan_licences(docs: DataFrame) -> DataFrame:
    """Adds ``sentence_ids`` (known licence sentences in order) and ``licences``.

    SPDX lines give ``SPDX:`` and each identifier (exceptions after WITH are
    left out). Reads each whole text. A null or empty text has neither; sentences of no
    rule make no licence. Equal texts get equal results; repeated rows, null
    ids and other columns pass through.
    """

    def start():
        recogniser = Recogniser()

        def run(texts: list[str | None]) -> list:
            found = [recogniser.identifiers(text) if text else [] for text in texts]
            return [found, [recogniser.licences(ids) for ids in found]]

        return run

    return add_columns(docs, "text", {"sentence_ids": "array<string>", "licences": "array<string>"}, start)
